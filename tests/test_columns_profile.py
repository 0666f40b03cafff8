import datetime as dt

from pyspark.sql import functions as F

from tablewatch.operators import columns, profile


CASES = [
    ("shop", "day", "string", "not_monitor"), ("shop", "time", "bigint", "not_monitor"),
    ("shop", "create_time", "bigint", "not_monitor"), ("shop", "tags", "array<string>", "not_monitor"),
    ("shop", "os", "string", "main_dimension"), ("dw", "os", "string", "attributes"), ("shop", "os", "int", "attributes"),
    ("shop", "watch_uid", "bigint", "uid"), ("shop", "user_id", "string", "uid"), ("shop", "guid", "string", "string_id"),
    ("shop", "room_id", "bigint", "num_id"), ("shop", "pay_amount", "decimal(10,2)", "attributes"),
    ("shop", "pay_amount", "bigint", "values"), ("shop", "consumer_name", "int", "values"), ("shop", "core1", "int", "values"),
    ("shop", "open_times", "int", "values"), ("shop", "title", "string", "attributes"),
]


def test_classes_agree_in_both_forms(spark):
    df = spark.createDataFrame([c[:3] for c in CASES], "app_name string, column_name string, column_type string")
    got = [r.k for r in df.select(columns.column_class().alias("k")).collect()]
    assert got == [c[3] for c in CASES]
    for app, name, kind, want in CASES:
        schema = spark.createDataFrame([], f"`{name}` {kind}").schema
        assert columns.classify_schema(schema, app) == {name: want}


def test_profile_rules(spark):
    df = spark.createDataFrame(
        [("abc", "", None, None, 0), ("0", "Unknown", 0, 0, 0), ("7", None, 5, 5, 0), (None, "x", -1, 7, 0)],
        "uid string, word_id string, room_id int, score int, zero_cnt bigint",
    )
    classes = {"uid": "uid", "word_id": "string_id", "room_id": "num_id", "score": "attributes", "zero_cnt": "values"}
    r = profile.profile(df, classes).first()
    assert (r.row_num, r.uid_num_poly2, r.uid_rate_poly2) == (4, 1, 25.0)
    assert (r.word_id_num_poly3, r.word_id_rate_poly3) == (3, 75.0)
    assert (r.room_id_num_poly3, r.room_id_rate_poly3) == (3, 75.0)
    assert r.score_rate_poly3 == 25.0  # nulls are not counted
    assert (r.zero_cnt_sum_poly1, r.zero_cnt_avg_poly1) == (0, 0.0)


def test_values_mean_ignores_zeros(spark):
    df = spark.createDataFrame([(3.0,), (0.0,), (4.0,), (None,)], "cost double")
    r = profile.profile(df, {"cost": "values"}).first()
    assert (r.cost_sum_poly1, r.cost_avg_poly1) == (7.0, 3.5)


def test_every_type_can_be_an_attribute(spark):
    df = spark.sql(
        "select true a, date'1970-01-01' b, timestamp_ntz'2020-01-01 00:00:00' c, timestamp'1969-01-01 00:00:00' d, "
        "cast(-1 as decimal(9,2)) e, cast('x' as binary) f, cast(0 as smallint) g"
    )
    r = profile.profile(df, {c: "attributes" for c in df.columns}).first()
    assert [r[f"{c}_rate_poly3"] for c in "abcdefg"] == [0.0, 100.0, 0.0, 100.0, 100.0, 0.0, 100.0]


def test_dimension_key_spells_nulls(spark):
    df = spark.createDataFrame([(None, "x")], "os string, area string")
    assert df.select(profile.dimension_key(["os", "area"]).alias("d")).first().d == "area:x,os:null"
    assert df.select(profile.dimension_key([]).alias("d")).first().d == ""


def test_chunks_give_the_same_rows(spark, rows):
    df = spark.range(50).select(F.col("id").alias("a_cnt"), (F.col("id") % 3).alias("b_id"), F.lit("x").alias("c"), F.lit("i").alias("os"))
    plan = columns.table_profile(df.schema)
    whole = rows(profile.profile_long(df, plan.classes, plan.dims))
    assert rows(profile.profile_long(df, plan.classes, plan.dims, chunk=1)) == whole
    assert len(whole) == 1 + 2 + 2 + 1


def test_empty_partition_still_counts(spark):
    day = dt.date(2024, 5, 20)
    schema = "pay_cnt bigint, os string, day date"
    df = spark.createDataFrame([(1, "a", dt.date(2024, 5, 1))], schema)
    plan = columns.table_profile(df.schema, skip=("day",))
    got = profile.profile_table(df, plan, day).collect()
    assert [(r.dimension, r.metric, r.value) for r in got] == [("", "row_num", 0.0)]
    whole = columns.TableProfile({"pay_cnt": "values", "os": "string_id"})
    got = {r.metric: r.value for r in profile.profile_table(df, whole, day).collect()}
    assert got == {"row_num": 0.0, "pay_cnt_sum_poly1": 0.0, "pay_cnt_avg_poly1": 0.0, "os_num_poly3": 0.0, "os_rate_poly3": None}
    # a slower table is read one day earlier
    got = profile.profile_table(df, plan, day, read_day="2024-05-01").collect()
    assert {r.dimension for r in got} == {"os:a"}


def test_downstream(spark):
    ms = int(dt.datetime(2024, 5, 19, tzinfo=dt.timezone.utc).timestamp() * 1000)
    old = ms - 3 * 86_400_000
    edges = spark.createDataFrame(
        [("t", "a", "Bob", 1, ms), ("t", "a", "bob", 1, ms), ("t", "b", "Amy", 1, ms), ("t", "c", "Far", 2, ms), ("t", "d", "Old", 1, old), ("t", "e", "", 1, ms), ("t", "f", "Nil", 1, None)],
        "name string, target_name string, owner string, depth int, updated_ms long",
    )
    assert columns.downstream_owners(edges, "2024-05-20").first().downstream == "amy,bob"
    assert columns.downstream_count(edges, "2024-05-20").first().downstream_tables == 3


def test_avg_day_bytes_falls_back(spark):
    tables = spark.createDataFrame([("a", 9, "day"), ("b", 9, "day"), ("c", 9, ""), ("d", 9, "day")], "name string, table_bytes long, partition_keys string")
    trend = spark.createDataFrame([("a", dt.date(2024, 5, 20), 10), ("a", dt.date(2024, 5, 13), 5), ("a", dt.date(2024, 5, 12), 999)], "name string, day date, bytes long")
    sizes = spark.createDataFrame([("b", dt.date(2024, 5, 19), 4), ("b", dt.date(2024, 5, 19), 3)], "name string, day date, bytes long")
    got = {r.name: r.day_bytes for r in columns.avg_day_bytes(tables, trend, sizes, "2024-05-20").collect()}
    assert got == {"a": 7, "b": 7, "c": 9, "d": 0}


def test_effective_day(spark):
    tables = spark.createDataFrame([("now", "day"), ("late", "day"), ("none", "day"), ("hourly", "day,hour")], "name string, partition_keys string")
    days = spark.createDataFrame([("now", dt.date(2024, 5, 19)), ("late", dt.date(2024, 5, 18)), ("hourly", dt.date(2024, 5, 1))], "name string, day date")
    got = {r.name: r.read_day.day for r in columns.effective_day(tables, days, "2024-05-20").collect()}
    assert got == {"now": 20, "late": 19, "none": 20, "hourly": 20}


def test_profile_config_orders_and_splits(spark):
    rows = [("shop", n, "ann", k, 1, c, 2, b, "x", "pay_cnt", "bigint") for n, k, c, b in (("big", "day", "08:00:00", 9), ("small", "day", "06:59:59", 1), ("mid", "day,hour", "23:00:00", 5))]
    cat = spark.createDataFrame(rows, "app_name string, name string, owner string, partition_keys string, table_bytes long, update_clock string, queries long, day_bytes long, downstream string, column_name string, column_type string")
    assert [(r.name, r.run_flag, r["values"]) for r in columns.profile_config(cat).collect()] == [
        ("small", "early", ["pay_cnt"]), ("mid", "early", ["pay_cnt"]), ("big", "else", ["pay_cnt"]),
    ]
    assert [r.name for r in columns.profile_config(cat, "else").collect()] == ["big"]


def test_hour_is_profiled_unless_it_is_a_partition(spark):
    df = spark.createDataFrame([(1, 3, dt.date(2024, 5, 20))], "pay_cnt bigint, hour int, day date")
    attributes = "name string, app_name string, owner string, partition_keys string, table_bytes long, queries long, day_bytes long, downstream string"
    config = spark.createDataFrame([("t", "a", "o", "day", 1, 1, 1, "")], attributes)
    names = lambda **x: {r.metric for r in profile.profile_all({"t": df}, config, dt.date(2024, 5, 20), "early", **x).collect()}
    assert any(m.startswith("hour") for m in names()) and not any(m.startswith("hour") for m in names(partitions={"t": ("hour",)}))
