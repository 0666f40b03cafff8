import datetime as dt


from tablewatch.operators import inventory, usage

DAY = dt.date(2024, 5, 20)


def ago(n):
    return DAY - dt.timedelta(n)


def test_build_inventory(spark, rows):
    tasks = spark.createDataFrame(
        [("DB", " T1", "x y", 3, 1, 3, "north"), ("tmp", "t2", "", 3, 1, 3, "north"), ("db", "t3", "", 3, 1, 2, "north"), ("db", "t1", "z", 3, 1, 3, "north"), ("test", "t", "", 3, 1, 3, "north")],
        "hive_db string, hive_table string, topic_name string, task_type int, dest_cluster_id int, status int, area string",
    )
    configs = spark.createDataFrame([("App.Ev ", "top ic", 0), ("", "q", 0), ("app.common", "q", 1)], "hive_table string, final_topic string, is_common int")
    shared = spark.createDataFrame([("app.sh", "shared_event", "7", "/p"), ("app.sh", "shared_event", "7", "/q")], "name string, source_kind string, event_id string, path string")
    got = inventory.build_inventory(inventory.export_tables(tasks, task_type=3, cluster=1, status=3, area="north"), inventory.event_tables(configs), shared, ["test"])
    # the blank inside the concatenated name is kept, only its ends are trimmed
    assert rows(got) == [("app.ev", "event", ""), ("app.sh", "shared_event", "7"), ("db. t1", "db_export", ""), ("db.t1", "db_export", "")]


def test_attach_status_keeps_unknown_tables(spark):
    inv = spark.createDataFrame([("db.t", "event", ""), ("db.x", "event", "")], "name string, source_kind string, event_id string")
    ms = int(dt.datetime(2024, 5, 15, tzinfo=dt.timezone.utc).timestamp() * 1000)
    cat = spark.createDataFrame([("db.t", "g", 5, 2, ms, "hdfs://c/w/db/old_tmp", "day")], "name string, guid string, bytes long, queries long, updated_ms long, location string, partition_keys string")
    got = {r.name: r for r in inventory.attach_status(inv, cat, DAY).collect()}
    assert (got["db.t"].status, got["db.t"].path, got["db.t"].table_bytes) == ("TaskStop5Days", "/w/db/t", 5)
    assert (got["db.x"].status, got["db.x"].path, got["db.x"].partition_keys) == ("NotFound", "", "")


def test_raw_log_admission(spark, rows):
    files = spark.createDataFrame([("a", 6), ("a", 6), ("b", 5), ("c", 3)], "name string, length long")
    used = spark.createDataFrame([("c", 4)], "name string, queries long")
    got = inventory.raw_log_inventory(files, used, "/logs/", 10)
    assert rows(got, "name", "path", "table_bytes", "queries") == [("a", "/logs/a", 12, 0), ("c", "/logs/c", 3, 4)]


def test_merge_usage_keeps_todays_number(spark, rows):
    now = spark.createDataFrame([("a", 3)], "name string, queries long")
    recent = spark.createDataFrame([("a",), ("b",)], "name string")
    assert rows(inventory.merge_usage(now, recent)) == [("a", 3), ("b", 0)]


def test_admit_catalog(spark, rows):
    ms = lambda n: int(dt.datetime(2024, 5, 20, tzinfo=dt.timezone.utc).timestamp() * 1000) - n * 86_400_000
    cat = spark.createDataFrame(
        [("dwd.ok", 1, 1, ms(2)), ("dwd.stale", 1, 1, ms(3)), ("dwd.tmp_x", 1, 1, ms(0)), ("ods.x", 1, 1, ms(0)), ("dwd.idle", 1, 0, ms(0)), ("dwd.nil", 1, 1, None)],
        "name string, bytes long, queries long, updated_ms long",
    )
    assert rows(inventory.admit_catalog(cat, DAY, "dws|app|dim|dwd"), "name") == [("dwd.ok",)]


def test_usage_by_table(spark, rows):
    schema = "src string, proto string, day date"
    read = lambda t, app, n: (f"/data/logs/{t}/day=1/f", f"x_application_17_{app}_y", ago(n))
    hot = spark.createDataFrame([read("a", 1, 1), read("a", 1, 1), read("a", 2, 1), read("a", 9, 0), ("/other/a/day=1", "application_17_5", ago(1)), ("/data/logs/a/day=1", "user", ago(1))], schema)
    cold = spark.createDataFrame([read("a", 3, 0), read("b", 4, 1), read("b", 6, 2)], schema)
    out = spark.createDataFrame([("application_17_2", ago(1)), (None, ago(1)), ("application_17_3", ago(5))], "app_id string, day date")
    got = usage.usage_by_table(hot, cold, [out], DAY, "/data/logs/")
    assert rows(got) == [("a", 2), ("b", 1)]


def test_usage_windows(spark, rows):
    read = lambda name, app, n: (f"/root/{name}/day=2024-05-01/x", f"rpc_application_{app}_y", ago(n))
    log = [read("a", "17_0001", 1), read("a", "17_0001", 0), read("a", "17_0002", 0), read("a", "18_0001", 0), read("a", "17_40000", 1)]
    log += [read("b", "17_0001", 2), read("b", "17_1", 2), ("/else/a/day=1/x", "application_1_1", ago(0)), ("/root/a/day=1/x", "none", ago(0))]
    audit = spark.createDataFrame(log, "src string, proto string, day date")
    bitmaps = usage.usage_bitmaps(audit, "/root/")
    got = rows(usage.usage_windows(bitmaps, DAY, (1, 2)), "name", "day", "days", "queries")
    wanted = [("a", ago(1), 1, 2), ("a", ago(1), 2, 2), ("a", DAY, 1, 3), ("a", DAY, 2, 4)]
    wanted += [("b", ago(2), 1, 1), ("b", ago(2), 2, 1), ("b", ago(1), 2, 1)]
    assert got == sorted(wanted, key=repr)
    assert usage.usage_windows(usage.usage_bitmaps(audit.where("false"), "/root/"), DAY).count() == 0


def test_excluded_applications_of_users(spark, rows):
    log = [(f"/root/a/day=2024-05-01/{i}", f"application_17_000{i}", ago(1)) for i in range(3)]
    audit = spark.createDataFrame(log, "src string, proto string, day date")
    apps = spark.createDataFrame([("application_17_0000", "robot", ago(1)), ("application_17_0001", "ann", ago(1))], "app_id string, user string, day date")
    use = lambda **kw: rows(usage.usage_by_table(audit, audit, [apps], DAY, "/root/", **kw))
    assert use() == [("a", 1)] and use(users=["robot"]) == [("a", 2)] and use(users=["nobody"]) == [("a", 3)]


def test_recent_active(spark, rows):
    df = spark.createDataFrame([("a", "raw_log", 2, ago(11)), ("b", "raw_log", 1, ago(1)), ("c", "event", 9, ago(1)), ("d", "raw_log", 9, ago(12)), ("e", "raw_log", 9, ago(0))], "name string, source_kind string, queries long, day date")
    assert rows(usage.recent_active(df, DAY)) == [("a",)]


def test_mentions_and_preference(spark, rows):
    st = spark.createDataFrame(
        [("ann", "select * from DWD.a -- dwd.b\n join dwd.c", "FINISHED", ago(1)), ("bot", "select 1 from dwd.d", "FINISHED", ago(1)), ("ann", "from dwd.e", "FAILED", ago(1)), ("ann", "from dwd.f", "FINISHED", ago(2))],
        "user_name string, query string, job_state string, day date",
    )
    cand = spark.createDataFrame([(f"dwd.{c}",) for c in "abcdef"], "name string")
    found = usage.mentioned_tables(st, cand, DAY, ["bot"])
    assert rows(found) == [("dwd.a",), ("dwd.c",)]
    business = spark.createDataFrame([("live", "dwd.a", "list"), ("live", "dwd.z", "list")], "app_name string, name string, table_source string")
    white = spark.createDataFrame([("dwd.z",)], "name string")
    assert rows(usage.monitored_tables(found, business, white)) == [("dw", "dwd.c", "dw"), ("live", "dwd.a", "list")]
