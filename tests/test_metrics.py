import datetime as dt

from pyspark.sql import functions as F

from tablewatch.operators import metrics
from tablewatch.operators.report import metric_lines

D = dt.date(2024, 5, 20)
HISTORY = (
    "app_name string, name string, owner string, partition_keys string, table_bytes long, queries long, day_bytes long, "
    "downstream string, dimension string, metric string, metric_class string, value double, day date, run_flag string"
)


def ago(n):
    return D - dt.timedelta(n)


def m(metric, n, value, dimension="", name="t", run="early", day_bytes=10):
    return ("app", name, "ann", "day", 3 * 1024**3, 4, day_bytes, "zoe,bob", dimension, metric, "values", value, ago(n), run)


def series(metric, today, level=100.0, days=10, dimension="", name="t"):
    past = [m(metric, n, level + n % 3, dimension, name) for n in range(1, days + 1)]
    return past + ([] if today is None else [m(metric, 0, today, dimension, name)])


def rows_num(today=5000.0, **kw):
    return series("row_num", today, 5000.0, **kw)


def judged(spark, rows, gate_share="now", whitelist=None, run="early", **kw):
    df = spark.createDataFrame(rows, HISTORY)
    h = metrics.metric_history(df, D, run, whitelist, **kw)
    return df, h, metrics.flag_series(metrics.score_series(h, D, gate_share=gate_share))


def flags(flagged):
    return {(r.dimension, r.metric): r.flag for r in flagged.collect()}


def test_out_of_band(spark):
    _, _, f = judged(spark, rows_num() + series("a_sum_poly1", 900.0) + series("b_sum_poly1", 101.0))
    assert flags(f) == {("", "a_sum_poly1"): "out_of_band"}


def test_small_share_is_gated(spark):
    rows = rows_num() + series("a_sum_poly1", 900.0, dimension="os:x") + series("a_sum_poly1", 10.0**6, 10.0**6, dimension="os:y")
    rows += series("row_num", 10.0, 10.0, dimension="os:x") + series("row_num", 10.0, 10.0, dimension="os:y")
    assert ("os:x", "a_sum_poly1") not in flags(judged(spark, rows)[2])


def test_new_series_and_zero_days(spark):
    df, _, f = judged(spark, rows_num() + [m("n_sum_poly1", 0, 7.0)])
    assert flags(f) == {("", "n_sum_poly1"): "new"}
    e = metrics.with_evidence(f, D).collect()
    assert len(e) == 31 and sum(r.value for r in e) == 7.0
    assert {r.at_day for r in e} == {ago(n) for n in range(31)}
    summary = {(r.kind, r.item_type, r.item) for r in metrics.missing_new_summary(f).collect()}
    assert summary == {("new_dimension", "metric", "n"), ("new_dimension", "dimension", "")}


def test_missing_series(spark):
    rows = rows_num() + series("a_sum_poly1", None) + series("re7_rate_poly3", None)
    rows += series("row_num", 5.0, dimension="os:x") + series("a_sum_poly1", None, dimension="os:x")
    rows += series("row_num", 5.0, dimension="os:other") + series("a_sum_poly1", None, dimension="os:other")
    df, h, f = judged(spark, rows)
    gone = {k for k, v in flags(f).items() if v == "missing"}
    assert gone == {("", "a_sum_poly1"), ("os:x", "a_sum_poly1"), ("os:other", "a_sum_poly1")}
    summary = {(r.kind, r.item_type, r.item) for r in metrics.missing_new_summary(f).collect()}
    assert summary == {
        ("missing_metrics", "metric", "a"), ("missing_dimension", "metric", "a"), ("missing_dimension", "dimension", "os:x"),
    }
    e = metrics.with_evidence(f, D).where("dimension = ''").collect()
    assert len(e) == 11 and [r.value for r in e if r.at_day == D] == [0.0]


def test_empty_partition_reports_its_series(spark):
    rows = rows_num(0.0) + series("a_sum_poly1", 0.0) + [m("b_rate_poly3", n, 40.0) for n in range(1, 8)] + [m("b_rate_poly3", 0, None)]
    assert flags(judged(spark, rows)[2]) == {("", k): "missing" for k in ("row_num", "a_sum_poly1", "b_rate_poly3")}


def test_drop_to_zero_needs_the_other_gate(spark):
    rows = rows_num() + series("a_sum_poly1", 0.0)
    assert flags(judged(spark, rows)[2]) == {}
    assert flags(judged(spark, rows, gate_share="max")[2]) == {("", "a_sum_poly1"): "out_of_band"}


def test_retention_is_judged_on_its_own_day(spark):
    rows = rows_num()
    rows += [m("re7_rate_poly2", n, 50.0) for n in range(8, 20)] + [m("re7_rate_poly2", 7, 5.0)]
    rows += [m("re7_rate_poly2", n, 90.0) for n in range(0, 7)]
    _, _, f = judged(spark, rows)
    r = f.collect()
    assert [(x.metric, x.flag, x.series_day, x.n) for x in r] == [("re7_rate_poly2", "out_of_band", ago(7), 12)]


def test_short_and_thin_groups_are_left_out(spark):
    rows = rows_num() + [m("row_num", n, 10.0, "os:new") for n in range(4)]
    rows += [m("row_num", n, 500.0, "os:thin", day_bytes=500 * 100 * 1024 + 500) for n in range(9)]
    rows += [m("row_num", n, 500.0, "os:ok", day_bytes=500 * 100 * 1024) for n in range(9)]
    _, h, _ = judged(spark, rows)
    assert {r.dimension for r in h.collect()} == {"", "os:ok"}
    _, h, _ = judged(spark, rows, min_days=0)
    assert {r.dimension for r in h.collect()} == {"", "os:ok", "os:new"}


def test_other_runs_and_tables_without_today_are_silent(spark):
    rows = rows_num() + rows_num(None, name="late") + [m("row_num", 0, 1.0, name="else_table", run="else")]
    _, h, _ = judged(spark, rows, min_days=0)
    assert {r.name for r in h.collect()} == {"t"}


def test_whitelist_excludes_columns_everywhere(spark):
    white = spark.createDataFrame([("other_table", "a"), ("gone_table", None)], "name string, column_name string")
    rows = rows_num() + series("a_sum_poly1", 900.0) + rows_num(name="gone_table")
    _, h, _ = judged(spark, rows, whitelist=white)
    assert {(r.name, r.metric) for r in h.collect()} == {("t", "row_num")}


def test_shares_and_medians(spark):
    rows = series("row_num", 30.0, 30.0, dimension="os:x") + series("row_num", 70.0, 70.0, dimension="os:y")
    df = spark.createDataFrame(rows, HISTORY)
    now = {r.dimension: r for r in metrics.add_totals(df).where(F.col("day") == D).collect()}
    assert (now["os:x"].value_share, now["os:x"].row_share, now["os:x"].total_rows) == (30.0, 30.0, 100.0)
    zero = spark.createDataFrame([m("a_sum_poly1", 0, 0.0), m("a_sum_poly1", 1, -5.0)], HISTORY)
    assert {r.value: r.value_share for r in metrics.add_totals(zero).collect()} == {0.0: 0.0, -5.0: 100.0}


def test_stored_rows_and_lines(spark):
    df, _, f = judged(spark, rows_num() + series("a_sum_poly1", 90000.0))
    stored = metrics.anomaly_rows(metrics.with_evidence(f, D), df, D, "early")
    got = stored.collect()
    assert len(got) == 11 and {r.row_num for r in got} == {5000} and {r.owner for r in got} == {"ann"}
    lines = metric_lines(f.join(metrics.table_attributes(df, D), "name")).collect()
    assert [(r.label, r.table_size, r.users) for r in lines] == [("a (sum)", "3.00Gb", "bob,zoe")]
    assert lines[0].interval == "9.00万 not in [0.00万,0.02万]"


def test_a_hot_table_spreads_over_tasks(spark):
    """One table with most of the rows: totals stay exact and the join back uses several salts."""
    hot = [m("row_num", 0, 1.0, f"os:{i}", "hot") for i in range(500)] + [m("row_num", 0, 2.0, "os:a", "cold")]
    df = spark.createDataFrame(hot, HISTORY)
    got = metrics.add_totals(df).groupBy("name").agg(F.count("*").alias("n"), F.max("total_value").alias("t")).collect()
    assert {(r.name, r.n, r.t) for r in got} == {("hot", 500, 500.0), ("cold", 1, 2.0)}
