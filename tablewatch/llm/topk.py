"""Exact top-k by inner product with pivot-table elimination.

A table holds every vector's distances to a set of pivots. For a query q and any pivot p, |d(q,p) - d(x,p)| is a lower
bound of d(q,x), and the largest of these bounds gives an upper bound of the score, since
2 <q,x> = |q|^2 + |x|^2 - d(q,x)^2. Vectors are stored in blocks around their nearest pivot. A query first searches
its home block, which gives it a score to beat; then it visits the blocks whose bounds could beat it, evaluates
candidates in the order of their bounds, and stops where no bound reaches the k-th best score. Equal vectors have equal
scores for every query, so of each group of them only the smallest ids can be among the best and become candidates;
all of them remain queries. The result is exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tablewatch.llm.common import stored, table

PIVOTS = 48
#: Pivots are chosen from a sample of so many vectors; the choice affects speed alone.
PIVOT_SAMPLE = 1024
BLOCK, QUERIES = 2048, 1024
_STEP = 128


def integer_vectors(rows: DataFrame, scale: int = 256, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, v): every component times ``scale``, floored. Rows without an id, or whose vector is null or holds a
    null or non-finite component, take no part."""
    values = F.col(embedding).cast("array<double>")
    bad = F.exists(values, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    good = rows.where(F.col(vec_id).isNotNull() & F.col(embedding).isNotNull() & ~bad)
    return good.select(F.col(vec_id).cast("long").alias("vec_id"), F.transform(values, lambda x: F.floor(x * scale)).alias("v"))


def choose_pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """Vectors of the sample that lie far from each other: each next one is the farthest from those chosen."""
    chosen = [int(np.argmax(((sample - sample.mean(axis=0)) ** 2).sum(axis=1)))]
    near = ((sample - sample[chosen[0]]) ** 2).sum(axis=1)
    while len(chosen) < count and near.max() > 0:
        chosen.append(int(np.argmax(near)))
        near = np.minimum(near, ((sample - sample[chosen[-1]]) ** 2).sum(axis=1))
    return sample[chosen]


def pivot_table(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """(vec_id, v, norm, far, cell): squared norm, distances to the pivots, nearest pivot; all vectors have the pivots' length."""
    dim = pivots.shape[1]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.asarray(batch.column(1).flatten(), np.float64).reshape(-1, dim)
            far = np.stack([np.sqrt(((x - p) ** 2).sum(axis=1)) for p in pivots], axis=1)
            norm = (x**2).sum(axis=1)
            offsets = pa.array(np.arange(len(x) + 1) * len(pivots), pa.int32())
            lists = pa.ListArray.from_arrays(offsets, pa.array(far.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(norm), lists, pa.array(far.argmin(axis=1).astype(np.int32))], names=["vec_id", "v", "norm", "far", "cell"])

    schema = "vec_id long, v array<bigint>, norm double, far array<double>, cell int"
    return vectors.mapInArrow(measure, schema)


def candidates(vectors: DataFrame, k: int) -> DataFrame:
    """The rows that can be among the best k of any query: of equal vectors those with the k + 1 smallest ids, since ties
    go to the smaller id and a query leaves out one id, its own; of rows repeated as they are, k.

    Counts and row numbers are limited before they are shuffled, so a common vector makes no large group.
    """
    same = vectors.groupBy("v", "vec_id").agg(F.count("*").alias("times"))
    first = same.withColumn("n", F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))).where(F.col("n") <= k + 1)
    return first.select("vec_id", "v", F.explode(F.array_repeat(F.lit(0), F.least("times", F.lit(k)).cast("int")))).drop("col")


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -scores))[:k]


def _search(queries: pd.DataFrame, rows: pd.DataFrame, k: int) -> pd.DataFrame:
    """The best k of ``rows`` for each query, as far as they reach the query's score to beat."""
    x, far, norm = np.stack(rows.v.to_numpy()), np.stack(rows.far.to_numpy()), rows.norm.to_numpy()
    ids = rows.vec_id.to_numpy()
    out = []
    for q, q_far, q_norm, query_id, beat in zip(queries.qv, queries.qfar, queries.qnorm, queries.query_id, queries.beat):
        apart = np.abs(far - np.asarray(q_far)).max(axis=1)
        # the slack covers the rounding of the distances
        bound = (q_norm + norm - apart**2) / 2 + 1e-9 * (q_norm + norm) + 1
        order = np.argsort(-bound, kind="stable")
        order = order[ids[order] != query_id]
        got_ids, got = np.empty(0, np.int64), np.empty(0, np.int64)
        for lo in range(0, len(order), _STEP):
            part = order[lo : lo + _STEP]
            least = max(beat, got.min()) if len(got) == k else beat
            part = part[bound[part] >= least]
            if not len(part):
                break
            got_ids, got = np.append(got_ids, ids[part]), np.append(got, x[part] @ np.asarray(q))
            keep = _best(got_ids, got, k)
            got_ids, got = got_ids[keep], got[keep]
        reach = got >= beat
        out.append(pd.DataFrame({"query_id": query_id, "vec_id": got_ids[reach], "score": got[reach]}))
    return pd.concat(out)


def _visit(pairs: DataFrame, blocks: DataFrame, k: int) -> DataFrame:
    """Searches the pairs (query, block), a chunk of queries against a block at a time."""
    pairs = pairs.withColumnsRenamed({"cell": "q_cell", "part": "q_part", "chunk": "q_chunk"})
    asked = [F.col(f"q_{c}").alias(f"q_{c}") for c in ("cell", "part", "chunk")]
    pairs = pairs.select(*(c for c in pairs.columns if c not in ("q_cell", "q_part", "q_chunk")), *asked)
    met = pairs.select(F.col("q_cell").alias("cell"), F.col("q_part").alias("part"), F.col("q_chunk").alias("chunk")).distinct()
    rows = blocks.join(met, ["cell", "part"]).select("vec_id", "v", "norm", "far", *(F.col(c).alias(f"b_{c}") for c in ("cell", "part", "chunk")))

    def search(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(rows):
            return pd.DataFrame({"query_id": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="int64"), "score": pd.Series(dtype="int64")})
        return _search(queries, rows, k)

    sides = [f"q_{c}" for c in ("cell", "part", "chunk")], [f"b_{c}" for c in ("cell", "part", "chunk")]
    return pairs.groupBy(*sides[0]).cogroup(rows.groupBy(*sides[1])).applyInPandas(search, "query_id long, vec_id long, score long")


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, is_query, k: int = 5, pivots: int = PIVOTS) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query id the ``k`` other rows of highest inner product, ties to the smaller id.

    ``vectors`` has vec_id and integer components v. Rows with the query's id are its own and left out; other repeated
    rows are separate candidates; of a query id with several vectors the smallest is searched for. Components that one of
    two vectors lacks count as zero, so vectors of all lengths are compared; an empty one scores 0 with every other.
    An empty table gives an empty result; a query with fewer than ``k`` candidates gets them all.
    """
    spark = vectors.sparkSession
    longest = vectors.agg(F.max(F.size("v"))).first()[0]
    if longest is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    dim = max(longest, 1)
    alike = vectors.withColumn("v", F.concat("v", F.array_repeat(F.lit(0).cast("long"), F.lit(dim) - F.size("v"))))
    few = alike.orderBy(F.xxhash64("vec_id")).limit(PIVOT_SAMPLE).toPandas()
    chosen = choose_pivots(np.stack(few.v.to_numpy()).astype(np.float64), pivots)
    measured = stored(pivot_table(candidates(alike, k), chosen), "pivots")
    cells = {r.cell: r["count"] for r in measured.groupBy("cell").count().collect()}  # one row a pivot
    parts = F.create_map(*(F.lit(x) for c, n in cells.items() for x in (c, -(-n // BLOCK))))
    part = F.pmod(F.xxhash64("v"), parts[F.col("cell")]).cast("int")
    blocks = stored(measured.withColumn("part", part), "blocks")

    # a query's vector is a candidate's too, so its home block is there
    one_each = alike.where(is_query).groupBy("vec_id").agg(F.min("v").alias("v"))
    queries = stored(pivot_table(one_each, chosen).withColumn("part", part), "queries")
    n = queries.count()
    chunk = F.pmod(F.xxhash64(F.lit(3), "vec_id"), F.lit(max(1, -(-n // QUERIES)))).cast("int").alias("chunk")
    names = [F.col("vec_id").alias("query_id"), F.col("v").alias("qv"), F.col("norm").alias("qnorm"), F.col("far").alias("qfar"), chunk]
    asked = queries.select(*names, F.lit(float("-inf")).alias("beat"), "cell", "part")
    home = stored(_top(_visit(asked, blocks, k), k), "home")
    beat = home.where(F.col("rank") == k).select("query_id", F.col("score").cast("double").alias("least"))
    asked = asked.withColumnsRenamed({"cell": "home_cell", "part": "home_part"}).join(beat, "query_id", "left")
    asked = asked.withColumn("beat", F.coalesce("least", "beat")).drop("least")
    # one row a block: how far its vectors lie from each pivot, and their largest norm
    at = [f"far[{i}]" for i in range(len(few)) if i < pivots]
    sizes = blocks.agg(F.max(F.size("far"))).first()[0]
    shells = blocks.groupBy("cell", "part").agg(
        F.array(*(F.min(x) for x in (F.expr(a) for a in at[:sizes]))).alias("near"),
        F.array(*(F.max(F.expr(a)) for a in at[:sizes])).alias("out"),
        F.max("norm").alias("most"),
    )
    apart = F.array_max(F.zip_with(F.col("qfar"), F.arrays_zip("near", "out"), lambda d, s: F.greatest(s["near"] - d, d - s["out"], F.lit(0.0))))
    bound = (F.col("qnorm") + F.col("most") - apart * apart) / 2 + F.lit(1e-9) * (F.col("qnorm") + F.col("most")) + 1
    elsewhere = (F.col("cell") != F.col("home_cell")) | (F.col("part") != F.col("home_part"))
    # the stated queries against the blocks of all rows
    pairs = asked.crossJoin(shells).where(elsewhere & (bound >= F.col("beat")))
    found = _visit(pairs.select(*asked.columns, "cell", "part"), blocks, k).unionByName(home.drop("rank"))
    return _top(found, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op6_pivot_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(integer_vectors(table(spark, sf_dir, "embeddings")), F.col("vec_id") % 50 == 0)


OP6_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e[:least(len(q.e), len(c.e))], c.e[:least(len(q.e), len(c.e))])::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
