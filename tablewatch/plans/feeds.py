"""The supplied tables seen as the frames the operators take.

Each function derives one input frame from whole tables, so the work of a query grows with them.
Money is kept in whole cents, which makes sums independent of row order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.profile import HISTORY_COLUMNS, profile_long
from ..operators.columns import table_profile


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cents(c: str) -> Column:
    return F.round(F.col(c) * 100).cast("bigint")


# --- fact tables under warehouse-style column names, which the classification rules can read


def items(spark, sf) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_uid"),
        F.col("l_partkey").alias("part_id"),
        F.col("l_suppkey").alias("owner_id"),
        F.col("l_linenumber").alias("line_cnt"),
        F.col("l_quantity").alias("quantity_num"),
        cents("l_extendedprice").alias("price"),
        F.col("l_discount").alias("off_pct"),
        cents("l_tax").alias("tax_rate"),
        F.col("l_returnflag").alias("region"),
        F.col("l_linestatus").alias("os"),
        F.to_date("l_shipdate").alias("day"),
    )


def sales(spark, sf) -> DataFrame:
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        cents("o_totalprice").alias("total_amount"),
        F.col("o_orderstatus").alias("os"),
        F.col("o_orderpriority").alias("area"),
        F.to_date("o_orderdate").alias("day"),
    )


def actions(spark, sf) -> DataFrame:
    return table(spark, sf, "events").select(
        F.col("event_id").alias("action_id"),
        F.col("user_id"),
        F.col("event_type").alias("app"),
        cents("value").alias("pay_cnt"),
        F.col("props"),
        F.to_date("ts").alias("day"),
    )


def daily_metrics(df: DataFrame) -> DataFrame:
    """Long profile of every day of a fact table at once."""
    plan = table_profile(df.schema, skip=("day",))
    return profile_long(df, plan.classes, plan.dims, ("day",))


# Day on which the partitions of the metric stores are unusually large.
FAT_DAY = "1999-12-31"


def sales_metrics(spark, sf) -> DataFrame:
    """A metric history of the sales, one table per order status, with its attribute columns."""
    fat = F.when(F.col("day") == FAT_DAY, 1 << 30).otherwise(400 * 1024).cast("long")
    attributes = {
        "app_name": F.lit("shop"), "owner": F.concat(F.lit("owner_of_"), F.col("name")),
        "partition_keys": F.lit("day"), "table_bytes": F.lit(3 * 1024**3).cast("long"),
        "queries": F.lit(12).cast("long"), "day_bytes": fat, "downstream": F.lit("zoe,adam,mia,bob"),
        "run_flag": F.lit("early"),
    }
    status = F.lower(F.substring_index("dimension", "os:", -1))
    rows = daily_metrics(sales(spark, sf)).withColumn("name", F.concat(F.lit("shop.sales_"), status))
    return rows.withColumns(attributes).select(*HISTORY_COLUMNS)


LAUNCH_DAY = "2001-07-26"


def sales_metrics_with_launch(spark, sf) -> DataFrame:
    """The sales history plus a metric that starts on the judged day."""
    starts = (F.col("metric") == "row_num") & (F.col("day") == F.lit(LAUNCH_DAY).cast("date"))
    own = F.struct("metric", "metric_class")
    launch = F.struct(F.lit("launch_sum_poly1").alias("metric"), F.lit("values").alias("metric_class"))
    both = F.explode(F.when(starts, F.array(own, launch)).otherwise(F.array(own)))
    base = sales_metrics(spark, sf).withColumn("_m", both)
    return base.withColumns({"metric": F.col("_m.metric"), "metric_class": F.col("_m.metric_class")}).drop("_m")


def return_metrics(spark, sf) -> DataFrame:
    """Users of a day who are back 1, 3 and 7 days later, as retention metrics per day."""
    seen = table(spark, sf, "events").select("user_id", F.to_date("ts").alias("day")).distinct()
    lag = F.explode(F.array(*[F.lit(n) for n in (1, 3, 7)]))
    back = seen.withColumn("lag", lag).select(
        "user_id", F.date_sub("day", F.col("lag")).alias("day"), "lag"
    )
    counted = back.join(seen, ["user_id", "day"]).groupBy("day", "lag").agg(F.count("*").alias("users"))
    rows = seen.groupBy("day").agg(F.count("*").alias("users")).withColumn("lag", F.lit(0))
    lag_name = F.concat(F.lit("users_re"), F.col("lag").cast("string"), F.lit("_sum_poly1"))
    return counted.unionByName(rows.select("day", "lag", "users")).select(
        F.lit("app").alias("app_name"), F.concat(F.lit("app.returns_"), F.year("day").cast("string")).alias("name"), F.lit("ann").alias("owner"),
        F.lit("day").alias("partition_keys"), F.lit(1024).cast("long").alias("table_bytes"),
        F.lit(3).cast("long").alias("queries"), F.lit(1024).cast("long").alias("day_bytes"),
        F.lit("").alias("downstream"), F.lit("").alias("dimension"),
        F.when(F.col("lag") == 0, "row_num").otherwise(lag_name).alias("metric"),
        F.when(F.col("lag") == 0, "rows").otherwise("values").alias("metric_class"),
        F.col("users").cast("double").alias("value"), "day", F.lit("early").alias("run_flag"),
    )


# --- events as partition files


def _event_files(spark, sf) -> DataFrame:
    """One file per event: clicks share one table, told apart by user; other types have one per user.

    Files of low value are still in progress.
    """
    shared = F.col("event_type") == "click"
    bucket = F.col("user_id").cast("string")
    return table(spark, sf, "events").select(
        F.when(shared, "click").otherwise(F.concat("event_type", F.lit("_"), bucket)).alias("name"),
        F.when(shared, bucket).otherwise("").alias("event_id"),
        F.to_date("ts").alias("day"),
        F.hour("ts").alias("hour"),
        (F.octet_length("props") + cents("value")).alias("length"),
        F.col("ts").alias("modificationTime"),
        F.coalesce(F.col("value") < 0.5, F.lit(False)).alias("open"),
        F.col("event_id").alias("part"),
    )


def files(spark, sf) -> DataFrame:
    """Finished files as a described listing gives them, without their paths."""
    return _event_files(spark, sf).where(~F.col("open")).drop("open", "part")


def registry(spark, sf) -> DataFrame:
    """All partitions that were opened, those whose files are still in progress too."""
    return _event_files(spark, sf).select("name", "event_id", "day", "hour").distinct()


def listing(spark, sf) -> DataFrame:
    """The same files as a plain listing: path, length and time."""
    state = F.when(F.col("open"), ".inprogress.").otherwise(".")
    path = F.concat(
        F.lit("hdfs://warehouse:8020/logs/"), F.col("name"),
        F.lit("/day="), F.col("day").cast("string"),
        F.lit("/hour="), F.lpad(F.col("hour").cast("string"), 2, "0"),
        F.when(F.col("event_id") != "", F.concat(F.lit("/event_id="), F.col("event_id"))).otherwise(""),
        F.lit("/part-"), F.col("part").cast("string"), state, F.lit("orc"),
    )
    return _event_files(spark, sf).select(path.alias("path"), "length", "modificationTime")


def kind_of(name: str = "name") -> Column:
    """Source kind of an event table, by its type."""
    c = F.col(name)
    return (
        F.when(c == "click", "shared_event")
        .when(c.startswith("purchase"), "raw_log")
        .when(c.startswith("signup"), "db_export")
        .otherwise("event")
    )


def watched(spark, sf) -> DataFrame:
    """Inventory of the event tables, with sizes and usage from the files themselves."""
    tables = files(spark, sf).groupBy("name", "event_id").agg(
        F.sum("length").alias("table_bytes"), (F.count("*") % 9).alias("queries")
    )
    last = F.substring(F.col("name"), -1, 1)
    export = F.col("name").startswith("signup")
    keys = (
        F.when(export & last.isin("0", "1"), "")
        .when(export & last.isin("2", "3"), "month")
        .when(F.col("name") == "click", "day,hour,event_id")
        .when(last.isin("0", "1", "2", "3", "4"), "day,hour")
        .otherwise("day")
    )
    status = (
        F.when(last == "9", "EmptyTable").when(last == "8", "TaskStop4Days")
        .when(last == "7", "TaskStop100+Days").otherwise("normal")
    )
    return tables.select(
        "name", "event_id", kind_of().alias("source_kind"),
        F.concat(F.lit("/logs/"), F.col("name")).alias("path"),
        F.when(F.col("name") == "click", "normal").otherwise(status).alias("status"),
        "table_bytes", "queries", keys.alias("partition_keys"),
    )


LOW_BYTES = 300


def measured_days(spark, sf) -> DataFrame:
    """Daily sizes of all event tables. Files under 500 bytes are taken as empty; days that are not
    raw logs and hold very little count as cut off."""
    size = F.when(F.col("length") < 500, 0).otherwise(F.col("length"))
    days = files(spark, sf).groupBy("name", "event_id", "day").agg(
        F.sum(size).alias("file_bytes"), F.count("*").alias("queries")
    )
    low = (F.col("file_bytes") < LOW_BYTES) & ~F.col("name").startswith("purchase")
    folder = F.when(F.dayofmonth("day") < 4, "/old/").otherwise("/new/")
    return days.select(
        "name", "event_id", kind_of().alias("source_kind"),
        F.concat(folder, F.col("name")).alias("path"), "file_bytes",
        F.when(low, "CutOff1Days").otherwise("normal").alias("status"),
        (F.col("file_bytes") * 30).alias("table_bytes"), "queries",
        F.lit("day").alias("partition_keys"), "day",
    )


def hour_flags(spark, sf) -> DataFrame:
    """Event types in hours with more bytes than their average hour."""
    hours = (
        files(spark, sf)
        .groupBy(F.element_at(F.split("name", "_"), 1).alias("name"), "day", "hour")
        .agg(F.sum("length").alias("file_bytes"))
    )
    usual = hours.groupBy("name").agg((F.sum("file_bytes") / F.count("*")).alias("usual"))
    at = F.unix_date("day").cast("long") * 86400 + F.col("hour") * 3600
    return hours.join(usual, "name").where(F.col("file_bytes") > F.col("usual")).select(
        F.lit("event").alias("source_kind"), "name", "file_bytes", "day", "hour", at.alias("update_time")
    )


# --- orders as tables that run dry


def order_days(spark, sf) -> DataFrame:
    """Bytes per nation and priority and day; days with small orders only are empty."""
    o = table(spark, sf, "orders")
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    big = F.when(F.col("o_totalprice") >= 250000, cents("o_totalprice")).otherwise(0)
    return (
        o.join(c, "o_custkey")
        .groupBy(
            F.concat(F.lit("nation_"), F.col("c_nationkey").cast("string")).alias("name"),
            F.col("o_orderpriority").alias("event_id"),
            F.to_date("o_orderdate").alias("day"),
        )
        .agg(F.sum(big).alias("bytes"))
    )


# --- parts as catalog records


def catalog(spark, sf) -> DataFrame:
    """One catalog table per part."""
    brand = F.lower(F.replace(F.col("p_brand"), F.lit("#"), F.lit("_")))
    kind = F.lower(F.col("p_type"))
    bare = F.concat(F.when(F.col("p_size") % 10 == 0, "tmp_").otherwise("t_"), kind, F.lit("_"), F.col("p_partkey").cast("string"))
    folder = F.when(F.col("p_size") % 5 == 0, "build_tmp1").otherwise(bare)
    keys = (
        F.when(F.col("p_size") % 4 == 0, "").when(F.col("p_size") % 4 == 1, "day")
        .when(F.col("p_size") % 4 == 2, "Day,Hour").otherwise("month")
    )
    age_hours = (F.col("p_partkey") * 7) % 3000
    base_ms = F.lit(1_000_000_000_000)
    return table(spark, sf, "part").select(
        F.col("p_partkey"),
        F.concat(brand, F.lit("."), bare).alias("name"),
        F.when(F.col("p_size") == 50, "").otherwise(F.concat(F.lit("g"), F.col("p_partkey").cast("string"))).alias("guid"),
        F.when(F.col("p_size") == 49, F.lit(0).cast("long")).otherwise(cents("p_retailprice") * F.pow(F.lit(8), F.col("p_size") % 7).cast("long")).alias("bytes"),
        (F.col("p_partkey") % 6).alias("queries"),
        (base_ms - age_hours * 3_600_000).alias("updated_ms"),
        F.col("p_brand").alias("owner"),
        F.when(F.col("p_size") % 3 == 0, "").otherwise(F.col("p_name")).alias("real_owner"),
        F.concat(F.lit("hdfs://cluster/warehouse/"), brand, F.lit("/"), folder).alias("location"),
        keys.alias("partition_keys"),
    )


CATALOG_DAY = "2001-09-09"


def part_names(spark, sf) -> DataFrame:
    return catalog(spark, sf).select(F.col("p_partkey").alias("l_partkey"), "name")


def edges(spark, sf) -> DataFrame:
    """Lineage edges from parts to the suppliers selling them, owned by the suppliers' nations."""
    li = table(spark, sf, "lineitem")
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    ms = F.unix_date(F.to_date("l_shipdate")).cast("long") * 86_400_000
    return (
        li.join(s, "l_suppkey")
        .join(part_names(spark, sf), "l_partkey")
        .select(
            "name",
            F.concat(F.lit("app.s"), F.col("l_suppkey").cast("string")).alias("target_name"),
            F.when(F.col("s_nationkey") == 0, "").otherwise(F.concat(F.lit("Team"), F.col("s_nationkey").cast("string"))).alias("owner"),
            F.when(F.col("l_linenumber") > 5, 2).otherwise(1).alias("depth"),
            ms.alias("updated_ms"),
        )
    )


def trend(spark, sf) -> DataFrame:
    """Partition sizes per part and ship day."""
    return (
        table(spark, sf, "lineitem")
        .join(part_names(spark, sf), "l_partkey")
        .groupBy("name", F.to_date("l_shipdate").alias("day"))
        .agg(F.sum(cents("l_extendedprice")).alias("bytes"))
    )


def catalog_columns(spark, sf) -> DataFrame:
    """Columns of a part's table: one per return flag and line status it was sold with."""
    li = table(spark, sf, "lineitem").join(part_names(spark, sf), "l_partkey")
    text = F.col("l_linestatus") == "O"
    suffix = (
        F.when(F.col("l_linenumber") == 1, "_uid").when(F.col("l_linenumber") == 2, "_id")
        .when(F.col("l_linenumber") == 3, "_cnt").when(F.col("l_linenumber") == 4, "_day")
        .otherwise("_name")
    )
    return li.select(
        "name",
        F.concat(F.lower("l_returnflag"), suffix).alias("column_name"),
        F.when(text, "string").otherwise("bigint").alias("column_type"),
        F.lit(None).cast("string").alias("column_comment"),
    ).distinct()


# --- configuration tables


#: Which of the tasks are exports to watch.
EXPORTS = {"task_type": 3, "cluster": 1, "status": 3, "area": "north"}


def export_tasks(spark, sf) -> DataFrame:
    return table(spark, sf, "orders").select(
        F.concat(F.lit("DB"), F.col("o_orderstatus")).alias("hive_db"),
        F.concat(F.lit(" Cust_"), F.col("o_custkey").cast("string"), F.lit(" ")).alias("hive_table"),
        F.col("o_orderpriority").alias("topic_name"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("task_type"),
        F.lit(1).alias("dest_cluster_id"),
        F.when(F.col("o_orderstatus") == "F", 3).otherwise(1).alias("status"),
        F.lit("north").alias("area"),
    )


def event_configs(spark, sf) -> DataFrame:
    return table(spark, sf, "part").select(
        F.when(F.col("p_size") == 1, "").otherwise(
            F.concat(F.col("p_brand"), F.lit("."), F.col("p_type"), F.lit("_"), F.col("p_size").cast("string"))
        ).alias("hive_table"),
        F.col("p_name").alias("final_topic"),
        F.when(F.col("p_type") == "PROMO", 1).otherwise(0).alias("is_common"),
    )


def shared_events(spark, sf) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        F.concat(F.lower("l_returnflag"), F.lit("."), F.lower("l_linestatus")).alias("name"),
        F.lit("shared_event").alias("source_kind"),
        F.col("l_suppkey").cast("string").alias("event_id"),
    )


# --- audit logs

AUDIT_DAY = "2024-01-03"
AUDIT_ROOT = "/data/logs/"


def path_audit(spark, sf) -> DataFrame:
    """Every page as a read of its host's directory by one of 997 applications."""
    host = F.split_part(F.col("url"), F.lit("/"), F.lit(3))
    app = F.format_string("%04d", F.col("page_id") % 997)
    return table(spark, sf, "pages").select(
        F.concat(F.lit(AUDIT_ROOT), host, F.lit("/day=2024-01-01/part-"), F.col("page_id").cast("string")).alias("src"),
        F.concat(F.lit("rpc_application_170_"), app, F.lit("_x")).alias("proto"),
        F.when(F.col("url").startswith("https"), "2024-01-02").otherwise("2024-01-03").cast("date").alias("day"),
    )


def excluded_apps(spark, sf) -> DataFrame:
    """Applications of documents labelled toxic."""
    app = F.format_string("application_170_%04d", F.col("doc_id") % 997)
    return table(spark, sf, "labels").where("toxic = 1").select(
        app.alias("app_id"), F.lit("2024-01-02").cast("date").alias("day")
    )


def statements(spark, sf) -> DataFrame:
    """Documents as audited statements."""
    return table(spark, sf, "documents").select(
        F.col("source").alias("user_name"),
        F.col("text").alias("query"),
        F.when(F.col("lang") == "de", "FAILED").otherwise("FINISHED").alias("job_state"),
        F.lit("2024-01-02").cast("date").alias("day"),
    )


def candidates(spark, sf) -> DataFrame:
    """Every word of the benchmark texts."""
    words = F.explode(F.split(F.lower("text"), "[^a-z]+")).alias("name")
    return table(spark, sf, "benchmark").select(words).where(F.col("name") != "").distinct()
