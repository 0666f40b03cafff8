import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from tablewatch.operators.sizes import daily_sizes
from tablewatch.plans import flows
from tablewatch.session import shared_dir
from tablewatch.sources.files import expected_partitions, list_files, partition_gaps, partition_registry, stored_files
from tablewatch.sources.tables import overwrite_table, read_days, read_list, write_partitions

DAY = dt.date(2024, 5, 20)


def ago(n):
    return DAY - dt.timedelta(n)


def test_list_files(spark, tmp_path):
    for path, n in (("t1/day=2024-05-20/hour=03/a.orc", 7), ("t1/day=2024-05-20/hour=03/.inprogress.b", 9), ("t1/day=x/c", 2), ("t2/f", 3), ("t1/day=2024-05-20/hour=04/x.inprogress.d", 4)):
        os.makedirs(os.path.dirname(tmp_path / path), exist_ok=True)
        (tmp_path / path).write_bytes(b"x" * n)
    df = list_files(spark, str(tmp_path))
    got = sorted((r.name, str(r.day), r.hour, r.length) for r in df.collect())
    assert got == [("t1", "2024-05-20", 3, 7), ("t1", "None", None, 2), ("t2", "None", None, 3)]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan


def test_read_list(spark, tmp_path):
    (tmp_path / "list.txt").write_text("a,x\\,y,3\nb,plain\n,z\\\\w,7\n")
    schema = StructType().add("name", "string").add("what", "string").add("n", IntegerType())
    got = [tuple(r) for r in read_list(spark, str(tmp_path / "list.txt"), schema).collect()]
    assert got == [("a", "x,y", 3), ("b", "plain", None), ("", "z\\w", 7)]


def test_partition_overwrite_is_idempotent(spark, tmp_path, rows):
    path = str(tmp_path / "h")
    rows_of = lambda v, flag: spark.createDataFrame([(v, DAY, flag)], "value int, day date, run_flag string")
    write_partitions(rows_of(1, "early"), path, ["day", "run_flag"])
    write_partitions(rows_of(2, "else"), path, ["day", "run_flag"])
    write_partitions(rows_of(3, "early"), path, ["day", "run_flag"])
    write_partitions(rows_of(3, "early"), path, ["day", "run_flag"])
    df = read_days(spark, path, DAY, DAY)
    assert rows(df, "value", "run_flag") == [(2, "else"), (3, "early")]
    plan = read_days(spark, path, ago(1), ago(1))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_empty_rerun_leaves_nothing_behind(spark, tmp_path, rows):
    path = str(tmp_path / "e")
    df = spark.createDataFrame([(1, DAY, "early"), (2, DAY, "else")], "value int, day date, run_flag string")
    write_partitions(df, path, ["day", "run_flag"])
    own = {"day": DAY, "run_flag": "early"}
    write_partitions(df.where("false"), path, ["day", "run_flag"], own=own)
    assert rows(read_days(spark, path, DAY, DAY), "value", "run_flag") == [(2, "else")]
    write_partitions(df.where("run_flag = 'early'"), path, ["day", "run_flag"], own=own)
    assert rows(read_days(spark, path, DAY, DAY), "value", "run_flag") == [(1, "early"), (2, "else")]


def test_failed_rerun_keeps_the_former_rows(spark, tmp_path, rows):
    path, own = str(tmp_path / "f"), {"day": DAY, "run_flag": "early"}
    df = spark.createDataFrame([(1, DAY, "early"), (2, DAY, "else")], "value int, day date, run_flag string")
    write_partitions(df, path, ["day", "run_flag"])
    broken = df.where("run_flag = 'early'").withColumn("value", F.raise_error(F.lit("lost")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        write_partitions(broken, path, ["day", "run_flag"], own=own)
    with pytest.raises(Exception, match="a row is not of run_flag=early"):
        write_partitions(df, path, ["day", "run_flag"], own=own)
    with pytest.raises(ValueError, match="leading columns"):
        write_partitions(df, path, ["day", "run_flag"], own={"run_flag": "early"})
    assert rows(read_days(spark, path, DAY, DAY), "value", "run_flag") == [(1, "early"), (2, "else")]
    # a rerun may read what it replaces
    mine = read_days(spark, path, DAY, DAY).where("run_flag = 'early'").withColumn("value", F.col("value") + 10)
    write_partitions(mine, path, ["day", "run_flag"], own=own)
    assert rows(read_days(spark, path, DAY, DAY), "value", "run_flag") == [(11, "early"), (2, "else")]
    # a whole day, its runs included
    write_partitions(df.where("run_flag = 'else'"), path, ["day", "run_flag"], own={"day": DAY})
    assert rows(read_days(spark, path, DAY, DAY), "value", "run_flag") == [(2, "else")]
    assert [f for f in os.listdir(path) if "staged" in f and f.endswith("before")] == []


def test_catalog_partition_is_switched(spark, tmp_path, rows):
    spark.sql("drop table if exists tw_switch")
    spark.sql(f"create table tw_switch (value int, day string, hour string) using parquet partitioned by (day, hour) location 'file:{tmp_path}/t'")
    try:
        df = spark.createDataFrame([("d", "03", 1), ("d", "04", 2)], "day string, hour string, value int")
        overwrite_table(df, "tw_switch")
        own = {"day": "d", "hour": "04"}
        broken = df.where("hour = '04'").withColumn("value", F.raise_error(F.lit("lost")).cast("int"))
        with pytest.raises(Exception, match="lost"):
            overwrite_table(broken, "tw_switch", own)
        assert rows(spark.table("tw_switch"), "hour", "value") == [("03", 1), ("04", 2)]
        overwrite_table(spark.table("tw_switch").where("hour = '04'").withColumn("value", F.lit(9)), "tw_switch", own)
        assert rows(spark.table("tw_switch"), "hour", "value") == [("03", 1), ("04", 9)]
        overwrite_table(df.where("false"), "tw_switch", own)
        assert rows(spark.table("tw_switch"), "hour", "value") == [("03", 1)]
        assert spark.sql("show partitions tw_switch").count() == 2
    finally:
        spark.sql("drop table tw_switch")


def test_text_days(spark, tmp_path, rows):
    path = str(tmp_path / "s")
    df = spark.createDataFrame([(1, "2024-05-19"), (2, "2024-05-20"), (3, "tmp"), (4, "2024-05-20x"), (5, ""), (6, "2024-05-21")], "value int, day string")
    write_partitions(df, path, ["day"])
    found = read_days(spark, path, ago(1), DAY, schema=df.schema)
    assert rows(found, "value") == [(1,), (2,)]
    assert rows(read_days(spark, path, F.date_sub(F.lit(DAY), 1), F.lit(DAY), schema=df.schema), "value") == [(1,), (2,)]


def test_stored_files_and_gaps(spark, tmp_path, rows):
    path = str(tmp_path / "logs" / "clicks")
    df = spark.createDataFrame([(i, ago(i % 3)) for i in range(9)], "value int, day date")
    write_partitions(df, path, ["day"])
    files = stored_files(read_days(spark, path, ago(1), DAY))
    got = files.groupBy("name", "day").agg(F.sum("rows").alias("n"), F.min(F.col("length") > 0).alias("ok"))
    assert rows(got, "name", "day", "n", "ok") == [("clicks", ago(1), 3, True), ("clicks", DAY, 3, True)]
    assert stored_files(read_days(spark, path, ago(9), ago(8))).count() == 0
    tables = spark.createDataFrame([("clicks",), ("views",)], "name string")
    known = files.unionByName(files.withColumn("day", F.date_sub("day", 2)).withColumn("length", F.lit(0).cast("long")))
    gaps = partition_gaps(known, tables, ago(4), DAY)
    wanted = [("clicks", ago(2), "empty"), ("clicks", ago(3), "empty"), ("clicks", ago(4), "absent")]
    assert rows(gaps, "name", "day", "gap") == sorted(wanted + [("views", ago(n), "absent") for n in range(5)], key=repr)
    assert expected_partitions(tables, ago(1), DAY, hourly=True).count() == 2 * 2 * 24


def test_catalog_table_and_registry(spark, tmp_path, rows):
    spark.sql("drop table if exists tw_part")
    spark.sql(f"create table tw_part (value int, day string, hour string) using parquet partitioned by (day, hour) location 'file:{tmp_path}/t'")
    try:
        df = spark.createDataFrame([("2024-05-20", "03", 1), ("2024-05-20", "04", 2)], "day string, hour string, value int")
        overwrite_table(df, "tw_part")
        overwrite_table(df.where("hour = '04'").withColumn("value", F.lit(9)), "tw_part")
        spark.sql("alter table tw_part add partition (day='2024-05-21', hour='00')")
        assert rows(spark.table("tw_part"), "hour", "value") == [("03", 1), ("04", 9)]
        got = rows(partition_registry(spark, "tw_part"), "name", "day", "hour")
        assert got == [("tw_part", dt.date(2024, 5, 20), 3), ("tw_part", dt.date(2024, 5, 20), 4), ("tw_part", dt.date(2024, 5, 21), 0)]
    finally:
        spark.sql("drop table tw_part")


def test_shared_dir_is_taken_from_the_session(spark):
    class Conf:
        def get(self, key, default=None):
            return {"spark.checkpoint.dir": "hdfs://nn/shared/"}.get(key, default)

    class Session:
        conf = Conf()

    assert shared_dir(Session()) == "hdfs://nn/shared"
    assert os.path.isdir(shared_dir(spark)) and shared_dir(spark) == shared_dir(spark)


def test_volume_flow(spark, tmp_path):
    store = str(tmp_path)
    inventory = spark.createDataFrame(
        [("a", "", "event", "/w/a", "normal", 2048, 9, "day"), ("b", "", "event", "/w/b", "normal", 2048, 9, "day")],
        "name string, event_id string, source_kind string, path string, status string, table_bytes long, queries long, partition_keys string",
    )
    all_files = [("a", "", ago(n), 1, "p", 900 if n == 0 else 100 + n, dt.datetime(2024, 5, 1)) for n in range(0, 8)]
    all_files += [("b", "", ago(n), 1, "p", 50, dt.datetime(2024, 5, 1)) for n in range(2, 8)]
    files = spark.createDataFrame(all_files, "name string, event_id string, day date, hour int, path string, length long, modificationTime timestamp_ntz")
    for n in range(7, 0, -1):
        flows.watch_volumes(store, files, inventory, ago(n), min_bytes=10)
    for _ in range(2):
        lines = flows.watch_volumes(store, files, inventory, DAY, min_bytes=10).collect()
    got = sorted((r.name, r.detail) for r in lines)
    assert got == [("a", "0.88kb"), ("b", "TaskStop2Days"), ("b", "TaskStop3Days")]
    assert read_days(spark, f"{store}/daily_sizes", DAY, DAY).count() == 2
    assert flows.watch_hour(store, files, inventory, DAY, 0, min_bytes=1).count() == 0


def test_day_measured_from_the_state_before(spark, tmp_path, rows):
    inventory = spark.createDataFrame(
        [(n, "", "event", f"/w/{n}", "normal", 2048, 9, "day") for n in "abc"],
        "name string, event_id string, source_kind string, path string, status string, table_bytes long, queries long, partition_keys string",
    )
    data = [("a", "", ago(n), 1, "p", 10 + n, dt.datetime(2024, 5, 1)) for n in range(6)]
    data += [("b", "", ago(n), 1, "p", 5, dt.datetime(2024, 5, 1)) for n in range(3, 6)]
    data += [("c", "", ago(n), 1, "p", 0 if n < 2 else 4, dt.datetime(2024, 5, 1)) for n in range(6)]
    data += [("a", "", None, 1, "p", 3, dt.datetime(2024, 5, 1))]
    files = spark.createDataFrame(data, "name string, event_id string, day date, hour int, path string, length long, modificationTime timestamp_ntz")
    for n in (5, 4, 3, 2, 1, 0, 0):
        of_day = files.where((F.col("day") == F.lit(ago(n))) | F.col("day").isNull())
        got = flows.measure_day(str(tmp_path), of_day, inventory, ago(n))
    columns = ["name", "file_bytes", "status", "path"]
    wanted = [("a", 3, "InvalidDay1Files", "/w/a"), ("a", 10, "normal", "/w/a/day=2024-05-20"), ("b", 0, "TaskStop4Days", "/w/b"), ("c", 0, "CutOff2Days", "/w/c/day=2024-05-19")]
    assert rows(got, *columns) == sorted(wanted, key=repr)
    assert rows(daily_sizes(files, inventory, DAY), *columns) == sorted(wanted, key=repr)


INVENTORY = "name string, event_id string, source_kind string, path string, status string, table_bytes long, queries long, partition_keys string"


def test_day_report_flow(spark, tmp_path, rows):
    store = str(tmp_path)
    inventory = spark.createDataFrame([(n, "", "event", f"/w/{n}", "normal", 100 * q, q, "day") for n, q in zip("abcd", (5, 9, 9, 7))], INVENTORY)
    cut = [("a", ago(0), "CutOff1Days"), ("b", ago(0), "TaskStop3Days"), ("b", ago(1), "TaskStop2Days"), ("c", ago(1), "CutOff4Days")]
    cutoffs = spark.createDataFrame([(n, "event", s, 100, 9, "day", d) for n, d, s in cut], flows.CUTOFFS)
    at = int(dt.datetime(DAY.year, DAY.month, DAY.day, tzinfo=dt.timezone.utc).timestamp())
    moved = spark.createDataFrame([("d", "event", "changed", 70, at, 700, 7, DAY)], flows.EVIDENCE)
    gates = {"idle_bytes": 0, "few_bytes": 0}
    changes, tally = flows.report_day(store, inventory, DAY, **gates)
    assert changes.count() == 0 and rows(tally.select("tables")) in ([], [(0,)])
    write_partitions(cutoffs, f"{store}/cutoffs", ["day"])
    write_partitions(moved, f"{store}/volume_anomalies", ["day"])
    for _ in range(2):
        changes, tally = flows.report_day(store, inventory, DAY, **gates)
    assert rows(changes, "rank", "name", "change") == [(1, "c", "recovered"), (2, "d", "fluctuating"), (3, "a", "new")]
    assert rows(tally, "kind", "tables") == [("CutOff", 1), ("TaskStop", 1), ("Total", 2)]
    assert os.listdir(f"{store}/_ranks") == []


def test_hour_report_flow(spark, tmp_path, rows):
    store = str(tmp_path)
    inventory = spark.createDataFrame([(n, "", "event", f"/w/{n}", "normal", 100, 9, "day,hour") for n in "abc"], INVENTORY)
    at = int(dt.datetime(DAY.year, DAY.month, DAY.day, tzinfo=dt.timezone.utc).timestamp())
    flags = [("a", h, 10 + h) for h in (5, 6, 7)] + [("b", h, 10) for h in (4, 6, 7)] + [("c", h, 10) for h in (5, 6, 7)]
    flagged = [(n, "event", "changed", size, at + h * 3600, 100, 9, DAY, h) for n, h, size in flags]
    assert flows.report_hour(store, inventory, DAY, 7, idle_bytes=0, few_bytes=0).count() == 0
    write_partitions(spark.createDataFrame(flagged, f"{flows.EVIDENCE}, hour int"), f"{store}/hourly_anomalies", ["day", "hour"])
    cutoffs = spark.createDataFrame([("c", "event", "CutOff1Days", 100, 9, "day", ago(1))], flows.CUTOFFS)
    write_partitions(cutoffs, f"{store}/cutoffs", ["day"])
    for _ in range(2):
        found = flows.report_hour(store, inventory, DAY, 7, idle_bytes=0, few_bytes=0)
    assert rows(found, "name", "file_bytes", "hour", "path") == [("a", 17, 7, "/w/a")]
    # an hour judged again without the flag leaves no report
    write_partitions(spark.createDataFrame([], f"{flows.EVIDENCE}, hour int"), f"{store}/hourly_anomalies", ["day", "hour"], own={"day": DAY, "hour": 6})
    assert flows.report_hour(store, inventory, DAY, 7, idle_bytes=0, few_bytes=0).count() == 0


def test_metric_flow(spark, tmp_path):
    store = str(tmp_path)
    data = [(d, "ios" if i % 2 else "web", 10 if d else 1000) for d in range(0, 9) for i in range(40)]
    sales = spark.createDataFrame([(ago(d), o, v) for d, o, v in data], "day date, os string, pay_amount bigint")
    config = spark.createDataFrame(
        [("shop", "shop.sales", "ann", "day", 5000, 3, 100, "bob")],
        "app_name string, name string, owner string, partition_keys string, table_bytes long, queries long, day_bytes long, downstream string",
    )
    quiet = sales.withColumn("pay_amount", F.lit(5).cast("bigint"))
    config = config.unionByName(config.withColumn("name", F.lit("shop.quiet")))
    for n in range(8, -1, -1):
        tables = {"shop.sales": sales, "shop.quiet": quiet}
        history = flows.profile_run(store, tables, config, ago(n), "early", group=1)
    assert history.where(F.col("day") == DAY).groupBy("name").count().count() == 2
    for _ in range(2):
        lines, summary = flows.watch_metrics(store, history, DAY, "early", days=30)
    assert {(r.dimension, r.metric) for r in lines.collect()} == {
        (d, m) for d in ("os:ios", "os:web") for m in ("pay_amount_sum_poly1", "pay_amount_avg_poly1")
    }
    assert summary.count() == 0
    stored = read_days(spark, f"{store}/metric_anomalies", DAY, DAY)
    assert stored.count() == 4 * 9 and {r.run_flag for r in stored.select("run_flag").collect()} == {"early"}


def test_profile_run_obeys_its_configuration(spark, tmp_path, rows):
    sales = spark.createDataFrame(
        [(DAY, "ios", 2**62, 1), (DAY, "web", 2**62, 2), (DAY, "web", 2**62, 2), (ago(1), "ios", 7, 3)],
        "day date, os string, pay_amount bigint, note_num bigint",
    )
    base = "app_name string, name string, owner string, partition_keys string, table_bytes long, queries long, day_bytes long, downstream string"
    lists = "main_dimension array<string>, `values` array<string>, run_flag string, read_day date"
    rest = ("ann", "day", 1, 1, 1, "")
    config = spark.createDataFrame(
        [
            ("shop", "shop.now", *rest, ["os"], ["pay_amount"], "early", DAY),
            ("dw", "dw.now", *rest, [], ["pay_amount", "gone"], "early", DAY),
            ("shop", "shop.behind", *rest, ["os"], ["pay_amount"], "early", ago(1)),
            ("shop", "shop.none", *rest, ["os"], ["pay_amount"], "early", ago(9)),
            ("shop", "shop.later", *rest, ["os"], ["pay_amount"], "else", DAY),
            ("shop", "shop.unknown", *rest, ["os"], ["pay_amount"], "early", DAY),
        ],
        f"{base}, {lists}",
    )
    tables = {n: sales for n in ("shop.now", "dw.now", "shop.behind", "shop.none", "shop.later", "shop.not_listed")}
    history = flows.profile_run(str(tmp_path), tables, config, DAY, "early", group=3)
    got = rows(history.where("metric in ('row_num', 'pay_amount_sum_poly1')"), "name", "dimension", "metric", "value")
    sums = lambda n, d, rows_, total: [(n, d, "pay_amount_sum_poly1", total), (n, d, "row_num", rows_)]
    assert got == sorted(
        sums("shop.now", "os:ios", 1.0, 2.0**62) + sums("shop.now", "os:web", 2.0, 2.0**63) + sums("dw.now", "", 3.0, 3 * 2.0**62)
        + sums("shop.behind", "os:ios", 1.0, 7.0) + [("shop.none", "", "row_num", 0.0)], key=repr,
    )
    assert rows(history.select("day", "run_flag").distinct()) == [(DAY, "early")]
    assert not any("note" in r.metric for r in history.collect())
    # a run without tables leaves an empty partition, also where there was one
    again = flows.profile_run(str(tmp_path), tables, config.where("run_flag = 'else'"), DAY, "early")
    assert again.count() == 0
    late = flows.profile_run(str(tmp_path), tables, config, DAY, "else")
    assert rows(late.select("name", "run_flag").distinct()) == [("shop.later", "else")]


def test_inventory_and_column_flows(spark, tmp_path):
    e = lambda schema: spark.createDataFrame([], schema)
    shared = spark.createDataFrame([("app.sh", "shared_event", "1")], "name string, source_kind string, event_id string")
    ms = int(dt.datetime(2024, 5, 19, 5, tzinfo=dt.timezone.utc).timestamp() * 1000)
    catalog = spark.createDataFrame(
        [("app.sh", "g", 5, 2, ms, "hdfs://c/w/sh", "day", "ann", "")],
        "name string, guid string, bytes long, queries long, updated_ms long, location string, partition_keys string, owner string, real_owner string",
    )
    raw = spark.createDataFrame([("r", "", "raw_log", "/logs/r", "normal", 1, 0, "day")], "name string, event_id string, source_kind string, path string, status string, table_bytes long, queries long, partition_keys string")
    found = flows.watch_inventory(e("name string"), e("name string"), shared, catalog, raw, DAY)
    assert {(r.name, r.status) for r in found.collect()} == {("app.sh", "normal"), ("r", "normal")}
    tables = spark.createDataFrame([("app", "app.sh", "list")], "app_name string, name string, table_source string")
    columns = spark.createDataFrame([("app.sh", "pay_cnt", "bigint", None), ("app.sh", "user_id", "bigint", "who")], "name string, column_name string, column_type string, column_comment string")
    edges = e("name string, target_name string, owner string, depth int, updated_ms long")
    trend = spark.createDataFrame([("app.sh", ago(1), 40)], "name string, day date, bytes long")
    config = flows.describe_columns(str(tmp_path), tables, catalog, columns, edges, trend, trend, DAY).collect()
    assert [(r.name, r.owner, r.day_bytes, r.run_flag, r.uid, r["values"]) for r in config] == [("app.sh", "ann", 40, "early", ["user_id"], ["pay_cnt"])]
