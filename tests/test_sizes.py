import datetime as dt

import pytest
from pyspark.sql import functions as F

from tablewatch.operators import sizes

D = dt.date(2024, 5, 20)


def ago(n):
    return D - dt.timedelta(n)


def gap(spark, days):
    df = spark.createDataFrame([("t", "", d, b) for d, b in days], "name string, event_id string, day date, bytes long")
    r = sizes.gap_status(df, D).collect()
    return r[0].status


@pytest.mark.parametrize(
    "days, status",
    [
        ([(ago(2), 5), (ago(1), 0), (D, 0)], "CutOff2Days"),
        ([(ago(2), 0), (ago(1), 5)], "TaskStop2Days"),
        ([(ago(i), 0) for i in range(120)], "CutOff100+Days"),
        ([(ago(9), 0), (D, 5)], "normal"),
        ([(ago(120), 5)], "TaskStop100+Days"),
        ([(ago(4), 0), (ago(3), 5), (ago(2), 0)], "CutOff3Days"),
        ([(ago(1), 5), (D + dt.timedelta(1), 5)], "TaskStop2Days"),
    ],
)
def test_gap_status(spark, days, status):
    assert gap(spark, days) == status


def test_folding_days_equals_reading_all(spark, rows):
    import random

    rng = random.Random(5)
    data = [(f"t{t}", "", ago(d), rng.choice([0, 0, 0, 7])) for t in range(40) for d in range(12) if rng.random() < 0.7]
    data += [("late", "", ago(0), 0), ("gone", "", ago(11), 0), ("full", "", ago(11), 5)]
    df = spark.createDataFrame(data, "name string, event_id string, day date, bytes long").cache()
    state = sizes.size_state(df.where(F.col("day") <= F.lit(ago(9))))
    for end in (6, 5, 0):
        seen = spark.createDataFrame(state.collect(), state.schema)
        before = {6: 9, 5: 6, 0: 5}[end]
        state = sizes.fold_state(seen, df.where((F.col("day") > F.lit(ago(before))) & (F.col("day") <= F.lit(ago(end)))))
    columns = ["name", "file_bytes", "total_bytes", "last_day", "full_day", "empty_since", "status"]
    assert rows(sizes.state_status(state, df, D), *columns) == rows(sizes.gap_status(df, D), *columns)
    # days without rows change nothing
    assert rows(sizes.fold_state(state, df.where("false")), "name", *sizes.STATE) == rows(state, "name", *sizes.STATE)


@pytest.mark.parametrize(
    "written, status",
    [
        (dt.datetime(2024, 5, 20, 8, 59), "CutOff1Days"),
        (dt.datetime(2024, 5, 20, 9, 0), "CutOff1Days"),
        (dt.datetime(2024, 5, 20, 9, 1), "normal"),
        (dt.datetime(2024, 5, 21, 1, 0), "normal"),
        (dt.datetime(2024, 2, 10, 1, 0), "CutOff100+Days"),
    ],
)
def test_freshness(spark, written, status):
    rows = [("t", "", 4, dt.datetime(2024, 1, 1)), ("t", "", 6, written)]
    df = spark.createDataFrame(rows, "name string, event_id string, length long, modificationTime timestamp_ntz")
    r = sizes.full_table_freshness(df, D).first()
    assert (r.status, r.file_bytes) == (status, 10)


FILES = "name string, event_id string, day date, hour int, path string, length long, modificationTime timestamp_ntz"
INVENTORY = "name string, event_id string, source_kind string, path string, status string, table_bytes long, queries long, partition_keys string"


def f(name, day, hour, length, event_id="", at=None):
    return (name, event_id, day, hour, "p", length, at or dt.datetime(day.year, day.month, day.day, hour))


@pytest.fixture
def world(spark):
    files = spark.createDataFrame(
        [
            f("ev", D, 3, 7), f("ev", ago(1), 4, 9),
            f("sh", D, 1, 5, "11"), f("sh", D, 2, 7, "11"), f("sh", ago(1), 2, 100, "11"), f("sh", ago(1), 2, 1, "12"),
            f("raw", ago(1), 5, 8), f("whole", D, 10, 50),
        ],
        FILES,
    )
    inventory = spark.createDataFrame(
        [
            ("ev", "", "event", "/w/ev", "TaskStop3Days", 1000, 2, "day"),
            ("sh", "11", "shared_event", "/w/sh", "normal", 1, 2, "day,hour,event_id"),
            ("sh", "12", "shared_event", "/w/sh", "normal", 1, 2, "day,hour,event_id"),
            ("raw", "", "raw_log", "/w/raw", "normal", 8, 2, "day"),
            ("whole", "", "db_export", "/w/whole", "normal", 50, 2, ""),
            ("mon", "", "db_export", "/w/mon", "normal", 50, 2, "month"),
            ("gone", "", "event", "/w/gone", "normal", 50, 2, "day"),
            ("empty", "", "event", "/w/empty", "EmptyTable", 0, 2, "day"),
        ],
        INVENTORY,
    )
    return files, inventory


def test_daily_sizes(spark, world):
    files, inventory = world
    registry = spark.createDataFrame([("sh", "12", D)], "name string, event_id string, day date")
    got = {(r.name, r.event_id): r for r in sizes.daily_sizes(files, inventory, D, registry).collect()}
    assert len(got) == 8
    ev = got["ev", ""]
    assert (ev.file_bytes, ev.status, ev.path, ev.table_bytes) == (7, "normal", "/w/ev/day=2024-05-20", 1000)
    # two hours of one event count as one day
    assert (got["sh", "11"].file_bytes, got["sh", "11"].table_bytes) == (12, 112)
    # registered but empty
    assert (got["sh", "12"].status, got["sh", "12"].path) == ("CutOff1Days", "/w/sh/day=2024-05-20")
    assert (got["raw", ""].file_bytes, got["raw", ""].status) == (0, "TaskStop2Days")
    assert (got["whole", ""].file_bytes, got["whole", ""].status, got["whole", ""].path) == (50, "normal", "/w/whole")
    assert (got["mon", ""].file_bytes, got["mon", ""].status) == (0, "MonthPartition")
    assert got["gone", ""].status == "PartitionNotExists"
    assert (got["empty", ""].status, got["empty", ""].path) == ("EmptyTable", "/w/empty")
    cut = {r.name: r.status for r in sizes.cutoff_table(sizes.daily_sizes(files, inventory, D, registry)).collect()}
    assert set(cut) == {"sh+12", "raw", "mon", "gone", "empty"}


def test_hourly_sizes(spark, world):
    files, inventory = world
    got = {(r.name, r.event_id): r for r in sizes.hourly_sizes(files, inventory, D, 3).collect()}
    assert ("whole", "") not in got and ("mon", "") not in got
    # no hour partition: by the time the file was written; data clears the stop
    assert (got["ev", ""].file_bytes, got["ev", ""].status, got["ev", ""].path) == (7, "normal", "/w/ev/day=2024-05-20")
    assert got["sh", "11"].path == "/w/sh/day=2024-05-20/hour=03/event_id=11"
    assert got["sh", "11"].file_bytes == 0 and got["sh", "11"].status == "normal"
    assert got["raw", ""].status == "TaskStop2Days"
    assert sizes.hourly_sizes(files, inventory, D, 2).where("event_id = '11'").first().file_bytes == 7
    other = {r.name: r for r in sizes.hourly_sizes(files, inventory, D, 4).collect()}
    assert (other["ev"].file_bytes, other["ev"].status) == (0, "TaskStop3Days")


def test_recent_partitions(spark):
    df = spark.createDataFrame([("t", "", ago(i), 1) for i in range(9)], "name string, event_id string, day date, bytes long")
    got = {r.day for r in sizes.recent_partitions(df, 3).collect()}
    assert got == {D, ago(1), ago(2)}


def test_hour_bytes(spark, world):
    files, _ = world
    late = files.withColumn("modificationTime", F.lit("2024-05-20 23:10:00").cast("timestamp_ntz"))
    by_part = {(r.name, r.hour): r.bytes for r in sizes.hour_bytes(late).where("name = 'ev'").collect()}
    assert by_part == {("ev", 3): 7, ("ev", 4): 9}
    by_age = {r.hour for r in sizes.hour_bytes(late, F.col("name") == "ev").where("name = 'ev'").collect()}
    assert by_age == {23}


def test_files_without_a_valid_day(spark):
    at = dt.datetime(2024, 5, 20, 3)
    files = [f("part", D, 3, 5)] + [(n, "", None, None, "p", b, at) for n, b in (("part", 7), ("part", 4), ("whole", 9), ("log", 2))]
    files = spark.createDataFrame(files, FILES)
    rows = [("part", "", "event", "/p", "normal", 1, 1, "day"), ("whole", "", "db_export", "/w", "normal", 1, 1, "")]
    rows += [("log", "", "raw_log", "/l", "normal", 1, 1, "day"), ("fine", "", "event", "/f", "normal", 1, 1, "day")]
    inventory = spark.createDataFrame(rows, INVENTORY)
    lost = {("part", 11, "InvalidDay2Files"), ("log", 2, "InvalidDay1Files")}
    for found in (sizes.daily_sizes(files, inventory, D), sizes.hourly_sizes(files, inventory, D, 3)):
        got = [(r.name, r.file_bytes, r.status) for r in found.collect()]
        assert lost == {r for r in got if r[2].startswith("InvalidDay")} and ("part", 5, "normal") in got
        assert len(got) == len(lost) + found.where("status not like 'InvalidDay%'").select("name").distinct().count()


def test_files_without_a_valid_day_hide_no_other_state(spark):
    from tablewatch.operators import volume

    rows = [("t", "event", "CutOff1Days", ago(1)), ("t", "event", "InvalidDay2Files", D), ("u", "event", "CutOff1Days", D), ("u", "event", "InvalidDay1Files", D)]
    flag = F.when(F.col("detail").startswith("InvalidDay"), "undated").otherwise("cutoff")
    report = spark.createDataFrame(rows, "name string, source_kind string, detail string, day date").withColumns(
        {"flag": flag, "table_bytes": F.lit(1), "queries": F.lit(1)}
    )
    got = {(r.name, r.change, r.detail) for r in volume.report_diff(report, D).collect()}
    assert got == {("t", "recovered", "CutOff1Days"), ("t", "undated", "InvalidDay2Files"), ("u", "new", "CutOff1Days"), ("u", "undated", "InvalidDay1Files")}


def test_unlisted_files(spark, rows):
    files = spark.createDataFrame(
        [("a", "", dt.date(2024, 5, 20), 3), ("b", "", None, 5), ("b", "", dt.date(2024, 5, 20), 6), ("a", "1", None, 7)],
        "name string, event_id string, day date, length long",
    )
    inventory = spark.createDataFrame([("a", ""), ("a", ""), ("c", ""), (None, "")], "name string, event_id string")
    assert rows(sizes.unlisted_files(files, inventory)) == [("a", "1", 1, 7), ("b", "", 2, 11)]
    assert rows(sizes.unlisted_files(files.where("false"), inventory)) == []
