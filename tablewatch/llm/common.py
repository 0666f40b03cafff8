"""What the operators of this subpackage share: tables, stored intermediate results, row keys, words."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablewatch.session import shared_dir

#: Stands for a null id in keys; a document with this very id would share its key only if the texts were equal too.
NO_ID = -(2**63)

#: White space between words: space and the ASCII controls from tab to carriage return (fixed by the contract).
WORD_GAP = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: With this on, the shuffle files of a query go as soon as it has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, label: str, by: tuple[str, ...] = ()) -> DataFrame:
    """The frame written to the shared folder and read again: cuts the lineage and survives lost executors.

    Nothing reads the shuffles behind it any more, so they are removed at once rather than when the driver frees memory.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm-{label}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.partitionBy(*by).option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEANUP, before) if before is not None else spark.conf.unset(CLEANUP)
    again = spark.read.schema(df.schema).parquet(path)
    again.stored_at = path
    return again


def discard(*frames: DataFrame) -> None:
    """Remove the folders of stored frames that nothing reads any more."""
    for df in frames:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.stored_at)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def text_key(doc_id: str = "doc_id", text: str = "text") -> list[Column]:
    """Key of a document: its id and a 128-bit hash of its text, neither null.

    Rows that agree in both are one document to the operators, and each of them gets its result.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    return [
        F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("_id"),
        F.xxhash64(whole, F.col(text).isNull()).alias("_t1"),
        F.xxhash64(F.lit(7), whole).alias("_t2"),
    ]


KEY = ["_id", "_t1", "_t2"]


def held_out(doc_id: str = "doc_id") -> Column:
    """One document in five, by the checksum of its id as text; a null id counts as the text ``null``."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("null"))), F.lit(5)) == 0


def sample_order(doc_id: str = "doc_id") -> Column:
    """A fixed pseudo-random order of documents, for bounded training samples."""
    return F.xxhash64(F.lit("sample"), F.col(doc_id))


def extended(schema: StructType, more: str) -> StructType:
    """The schema with further fields, given as DDL."""
    return StructType([*schema.fields, *StructType.fromDDL(more).fields])


def quoted(names: list[str]) -> list[Column]:
    return [F.col(f"`{n}`") for n in names]


def wrapped(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text`` and the row without its text as one column, so that no name can clash with an operator's."""
    rest = [n for n in docs.columns if n != "text"]
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.struct(*quoted(rest)).alias("row"))


def unwrapped(rows: DataFrame, like: DataFrame, text: Column | None = None, cut: Column | None = None) -> DataFrame:
    """The columns of ``like`` again, with another ``text``; where ``cut`` holds, ``n_chars`` is set to its length."""
    text = F.col("text") if text is None else text
    out = []
    for field in like.schema.fields:
        value = text if field.name == "text" else F.col("row")[field.name]
        if field.name == "n_chars" and cut is not None:
            value = F.when(cut, F.length(text).cast(field.dataType)).otherwise(value)
        out.append(value.alias(field.name))
    return rows.select(*out)
