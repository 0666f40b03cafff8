"""Every registered query against its reference SQL, and the shape of the plans."""

import datetime as dt
import decimal
import math

import duckdb
import pytest

import __spark_entry__ as entry_points
from tablewatch.plans import feeds
from tablewatch.plans.oracle import ORACLE
from tablewatch.plans.queries import REGISTRY as QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
#: Queries that write tables: what they return is a scan.
WRITERS = {"partition_rerun", "partition_switch", "catalog_rerun", "csv_list", "inventory_files", "string_days", "profile_by_config", "folded_sizes"}


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, (int, float, decimal.Decimal)):
        return None if math.isnan(v) else round(float(v), 6) + 0.0
    if isinstance(v, (dt.date, dt.datetime)):
        return str(v).removesuffix(" 00:00:00")
    return v


def table(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(cols), sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_reference_sql(spark, sf, duck, name):
    df = QUERIES[name](spark, sf)
    found = table([tuple(r) for r in df.collect()], df.columns)
    cursor = duck.execute(ORACLE[name])
    wanted = table(cursor.fetchall(), [d[0] for d in cursor.description])
    assert found == wanted


def test_every_query_is_checked_and_registered():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_points.queries()) and set(ORACLE) <= set(entry_points.oracle_sql())


def test_days_prune_directories(spark, sf):
    plan = plan_of(QUERIES["inventory_files"](spark, sf))
    assert "PartitionFilters: [isnotnull(day" in plan and "ReadSchema: struct<>" in plan
    plan = plan_of(QUERIES["string_days"](spark, sf))
    assert "PartitionFilters: [isnotnull(day" in plan and "(day#" in plan and "cast(day" not in plan


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["day", "dimension", "metric", "value", "n", "band_lo", "band_hi"]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITERS))
def test_plans_stay_in_the_engine(spark, sf, name):
    plan = plan_of(QUERIES[name](spark, sf))
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
    assert "Python" not in plan and "InPandas" not in plan
    # one row per task is all that a total over everything gathers
    if name not in ("profile_customer_ids", "profile_tables"):
        assert "SinglePartition" not in plan


def test_rolling_bands_need_one_exchange_after_the_profile(spark, sf):
    plan = plan_of(QUERIES["rolling_metrics"](spark, sf))
    assert plan.count("Exchange hashpartitioning") == 2


def test_scan_reads_only_what_is_asked(spark, sf):
    plan = plan_of(QUERIES["rolling_quantity"](spark, sf))
    assert "ReadSchema: struct<l_quantity:double,l_returnflag:string,l_linestatus:string,l_shipdate:timestamp_ntz>" in plan


def test_as_of_day_reaches_the_scan(spark, sf):
    days = feeds.measured_days(spark, sf)
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan_of(days.where("day >= date'2024-01-20'"))


@pytest.mark.parametrize("name", ["metric_evidence", "volume_evidence", "table_mentions", "daily_report"])
def test_results_do_not_need_broadcasts(spark, sf, duck, name):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        df = QUERIES[name](spark, sf)
        assert "BroadcastHashJoin" not in plan_of(df)
        found = table([tuple(r) for r in df.collect()], df.columns)
    finally:
        for k in settings:
            spark.conf.unset(k)
    cursor = duck.execute(ORACLE[name])
    assert found == table(cursor.fetchall(), [d[0] for d in cursor.description])
