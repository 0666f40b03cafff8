from pyspark.sql import functions as F

from tablewatch.functions import names, rules, text


def one(spark, value, expr, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expr.alias("y")).first().y


def test_names(spark):
    df = spark.createDataFrame([(" DB", "Tab ", "7", "shared_event"), ("a", None, "", "event")], "d string, t string, event_id string, source_kind string")
    out = df.select(names.qualified_name("d", "t").alias("name"), "event_id", "source_kind")
    assert [r.name for r in out.collect()] == ["db.tab", None]
    assert [r.s for r in out.select(names.series_name().alias("s")).collect()] == ["db.tab+7", None]


def test_deny_list_excludes(spark):
    df = spark.createDataFrame([("test.t",), ("prod.t",), ("prod.表",), ("prod.demo_x",)], "name string")
    kept = df.where(names.keep_name("name", ["test"], "demo")).collect()
    assert [r.name for r in kept] == ["prod.t"]


def test_paths(spark):
    p = "hdfs://nn:8020/w/db/t1/day=2024-01-02/hour=05/event_id=9/f.orc"
    assert one(spark, p, names.partition_value("x", "day")) == "2024-01-02"
    assert one(spark, p, names.partition_value("x", "event_id")) == "9"
    assert one(spark, p, names.partition_value("x", "month")) is None
    assert one(spark, p, names.table_segment("x")) == "t1"
    assert one(spark, "/w/db/t2/f.orc", names.table_segment("x")) == "t2"
    assert one(spark, p, names.strip_scheme("x")).startswith("/w/db")
    assert one(spark, "file:/w/f", names.strip_scheme("x")) == "/w/f"
    assert one(spark, "/w/.inprogress.3", names.in_progress("x"))


def test_repair_location(spark):
    fix = lambda p: one(spark, p, names.repair_location("x", F.lit("t")))
    assert fix("hdfs://c/w/build_tmp1") == "/w/t"
    assert fix("hdfs://c/w/tmp") == "/w/t"
    assert fix("hdfs://c/w/t") == "/w/t"
    assert fix("hdfs://c/w/other") == "/w/other"
    assert fix(None) == ""


def test_importance_tiers(spark):
    data = [
        ("raw_log", 0, 10**12), ("raw_log", 1, 0), ("event", 0, 10 * 1024**3), ("event", 0, 10 * 1024**3 - 1),
        ("event", 3, 100 * 1024**2), ("event", 3, 1), ("event", 4, 0), ("shared_event", 0, 0),
    ]
    df = spark.createDataFrame(data, "source_kind string, queries long, table_bytes long")
    got = [r.i for r in df.select(rules.is_important().alias("i")).collect()]
    assert got == [False, True, True, False, True, False, True, True]


def test_retention_days(spark):
    def days(metric):
        return one(spark, metric, rules.retention_days("x"))

    assert days("re7_rate_poly3") == 7
    assert days("users_re30_sum_poly1") == 30
    assert days("ad2_re7") == 7
    assert days("17re_num") == 17
    assert days("amount_sum_poly1") == 0


def test_gate_and_unnamed(spark):
    df = spark.createDataFrame(
        [("a_sum_poly1", 1.0, 3.01), ("a_sum_poly1", 1.0, 3.0), ("a_rate_poly3", 4.99, 50.0), ("a_num_poly3", 1000.0, 50.0)],
        "m string, v double, s double",
    )
    assert [r.g for r in df.select(rules.passes_gate("m", "v", "s").alias("g")).collect()] == [True, False, False, True]
    assert one(spark, "os:Other", rules.is_unnamed("x"))
    assert not one(spark, "os:ios", rules.is_unnamed("x"))


def test_catalog_status(spark):
    df = spark.createDataFrame(
        [("g", 1, "2024-01-30"), ("g", 1, "2024-01-29"), ("g", 1, "2023-10-22"), ("g", 1, "2023-10-21"), ("g", 0, "2024-01-30"), ("", 1, "2024-01-30"), (None, None, None)],
        "guid string, b long, d string",
    )
    got = df.select(rules.catalog_status("guid", "b", F.col("d").cast("date"), "2024-01-30").alias("s")).collect()
    assert [r.s for r in got] == [
        "normal", "normal", "TaskStop100Days", "TaskStop100+Days", "EmptyTable", "NotFound", "NotFound",
    ]


def test_measured(spark):
    df = spark.createDataFrame([("normal",), ("TaskStop99Days",), ("TaskStop100+Days",), ("EmptyTable",)], "status string")
    assert [r.m for r in df.select(rules.is_measured().alias("m")).collect()] == [True, True, False, False]


def test_texts(spark):
    assert one(spark, 3 * 1024**4, text.fmt_bytes("x"), "long") == "3.00Tb"
    assert one(spark, 1536, text.fmt_bytes("x"), "long") == "1.50Kb"
    assert one(spark, 1536, text.fmt_file_bytes("x"), "long") == "1.5kb"
    assert one(spark, 5 * 1024**4, text.fmt_file_bytes("x"), "long") == "5120.0Gb"
    assert one(spark, 1.5e8, text.fmt_number("x"), "double") == "1.50亿"
    assert one(spark, 12345.0, text.fmt_number("x"), "double") == "1.23万"
    assert one(spark, 12.0, text.fmt_number("x"), "double") == "12"
    assert one(spark, 0.9, text.fmt_lower("x", "x"), "double") == "0"
    assert one(spark, "price_sum_poly1", text.metric_label("x")) == "price (sum)"
    assert one(spark, "row_num", text.metric_label("x")) == "row_num (rows)"
    assert one(spark, "odd", text.metric_label("x")) == "unknown"
    assert one(spark, 3.0, text.ratio_text("x", F.lit(0.0)), "double") == "history is all zero"
    assert one(spark, 3.0, text.ratio_text("x", F.lit(2.0)), "double") == "1.5 times the expected value"
    assert one(spark, "zoe,adam,mia,bob", text.first_users("x")) == "adam,bob,mia"
    assert one(spark, "", text.first_users("x")) == ""


def test_sql_tokens(spark):
    got = one(spark, "SELECT * FROM Db.T1 -- db.t2 \n join\tdb.t3", text.sql_tokens("x"))
    assert "db.t1" in got and "db.t3" in got and "db.t2" not in got
