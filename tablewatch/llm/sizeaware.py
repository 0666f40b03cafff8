"""Exact n-gram Jaccard join, treating small sets and large ones differently.

Two sets at the similarity sought share some number of shingles among the first ones of either set in any order that
all sets follow; with rare shingles first, these first ones are few and shared by few. Small sets enumerate subsets of
fixed size of them, so a pair must share several at once; for a large set the subsets would be too many, so the
inverted lists of its first shingles are scanned. The size at which lists become cheaper is chosen by cost.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewatch.llm.common import KEY, discard, stored, table, text_key
from tablewatch.llm.graph import components
from tablewatch.llm.words import raw_words, shingles, word_ids

#: Shingles of a subset.
SUBSET = 2
#: Of a set's first shingles, beyond those that any pair needs, one more for so many members of the set.
MORE = 12
#: Neighbours of a hub that one copy of its set serves.
CHUNK = 256


def least_shared(n, percent: int):
    """Members that a set of ``n`` shares with any partner."""
    return (n * percent + 99) // 100


def _least(n: str, percent: int) -> Column:
    return F.ceil(F.col(n) * percent / 100).cast("int")


def _first(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """Key, ``n_shingles``, ``node`` (a 128-bit name of the set; null without shingles) and the ``head`` of the set:
    its first shingles by value, enough that of every partner some lie in both heads."""
    schema = "doc_id long, _id long, _t1 long, _t2 long, n_shingles long, node binary, head array<long>"
    lists = pa.list_(pa.int64())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, nodes, heads, offsets = [], [], [np.empty(0, np.int64)], [0]
            for text in batch.column(4):
                s = shingles(word_ids(raw_words(text.as_py(), True)), k)
                n = len(s)
                counts.append(n)
                nodes.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if n else None)
                # a set of one has no partner but itself
                heads.append(s[: n - least_shared(n, percent) + n // MORE + 1 if n > 1 else 0].view(np.int64))
                offsets.append(offsets[-1] + len(heads[-1]))
            flat = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(heads)), type=lists)
            out = [*batch.columns[:4], pa.array(counts, pa.int64()), pa.array(nodes, pa.binary()), flat]
            yield pa.RecordBatch.from_arrays(out, names=["doc_id", *KEY, "n_shingles", "node", "head"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), *text_key(), "text").mapInArrow(read, schema)


def _sets(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """(num, n, items) of the wanted sets (num, n and a document's key), each read from one document."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(word_ids(raw_words(t.as_py(), True)), k).view(np.int64) for t in batch.column(2)]
            offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets], dtype=np.int64)]).astype(np.int32)
            flat = np.concatenate([np.empty(0, np.int64), *sets])
            items = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat), type=pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), items], names=["num", "n", "items"])

    found = docs.select(*text_key(), "text").join(wanted, KEY)
    return found.select("num", "n", "text").mapInArrow(read, "num long, n long, items array<long>").dropDuplicates(["num"])


def _shared(sets: DataFrame, percent: int) -> DataFrame:
    """(num, n, shared: pairs of count and shingle) with the shingles of a set that other sets have too, for the sets
    whose shared ones are enough for a partner."""
    rows = sets.select("num", "n", F.explode("items").alias("item"))
    counts = rows.groupBy("item").agg(F.count("*").alias("f")).where("f > 1")
    shared = rows.join(counts, "item").groupBy("num").agg(F.first("n").alias("n"), F.collect_list(F.struct("f", "item")).alias("shared"))
    return shared.where(F.size("shared") >= _least("n", percent))


def _boundary(sets: DataFrame) -> int:
    """The largest size of a small set: the power of two at which subsets and list scans together cost least.

    A subset costs a row, a place in a list the row and its comparison with the list's hub; both are summed by powers
    of two of the size.
    """
    subsets = F.size("pairs_from") * (F.size("pairs_from") - 1) / 2
    sizes = sets.groupBy(F.floor(F.log2("n")).alias("size"))
    costs = sizes.agg(F.sum(subsets).alias("subsets"), F.sum(F.size("lists") * 2).alias("scans")).collect()
    top = max((r["size"] for r in costs), default=0) + 1
    total = [sum(r["subsets"] if r["size"] < c else r["scans"] for r in costs) for c in range(top + 1)]
    return 2 ** total.index(min(total)) - 1


def _entries(shared: DataFrame, percent: int) -> DataFrame:
    """(key, num, n, large, reach) of every bucket that a set is in; ``reach`` bounds what the set can share with others
    of the bucket if the bucket's shingles are the first that they share.

    Shingles follow each other from rare to frequent; those that no other set has come first and need no bucket.
    """
    ordered = shared.withColumns({"alone": F.col("n") - F.size("shared"), "shared": F.array_sort("shared")})

    def first(more: int) -> Column:
        length = (F.col("n") - _least("n", percent) + more - F.col("alone")).cast("int")
        return F.slice("shared", 1, F.greatest(length, F.lit(0)))

    sets = ordered.select("num", "n", "alone", first(1).alias("lists"), first(SUBSET).alias("pairs_from"))
    small = _boundary(sets)
    # a set that is small but may have a large partner is in the lists too
    lists = sets.where(F.floor(F.col("n") * 100 / percent) > small)
    lists = lists.select("num", "n", "alone", F.posexplode("lists").alias("at", "x"))
    lists = lists.select(F.array("x.item").alias("key"), "num", "n", (F.col("n") > small).alias("large"), (F.col("n") - F.col("alone") - F.col("at")).alias("reach"))
    pairs = sets.where(F.col("n") <= small).select("num", "n", "alone", "pairs_from", F.posexplode("pairs_from").alias("one", "x"))
    rest = F.expr("slice(pairs_from, one + 2, size(pairs_from))")
    pairs = pairs.select("num", "n", "alone", "one", "x", F.posexplode(rest).alias("two", "y"))
    reach = F.col("n") - F.col("alone") - F.col("one") - F.col("two") - 1 + SUBSET - 1
    pairs = pairs.select(F.array("x.item", "y.item").alias("key"), "num", "n", F.lit(False).alias("large"), reach.alias("reach"))
    return lists.unionAll(pairs)


def _possible(x: str, y: str, percent: int) -> Column:
    """Whether two entries of a bucket may be linked by their sizes and reach, and are compared in this bucket at all:
    pairs of small sets meet by subsets, others by lists."""
    one, two = (lambda c: F.col(f"{x}.{c}")), (lambda c: F.col(f"{y}.{c}"))
    meet = (F.size(one("key")) == SUBSET) | one("large") | two("large")
    return meet & (F.least(one("reach"), two("reach")) * (100 + percent) >= (one("n") + two("n")) * percent)


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) with 100 * intersection >= percent * union of their full sets.

    The set of ``b`` travels to its pair; a copy of the set of ``a`` serves a chunk of its pairs.
    """

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = x.values.to_numpy(), y.values.to_numpy()
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    chunks = pairs.groupBy("a").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks"))
    dealt = pairs.join(chunks, "a").withColumn("chunk", F.pmod(F.xxhash64("b"), "chunks").cast("int"))
    dealt = dealt.join(sets.select(F.col("num").alias("b"), F.col("items").alias("y")), "b")
    served = chunks.join(sets.select(F.col("num").alias("a"), F.col("items").alias("x")), "a")
    served = served.select("a", "x", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))
    return dealt.join(served, ["a", "chunk"]).select("a", "b", "x", "y").mapInArrow(confirm, "a long, b long")


def similar_sets(docs: DataFrame, k: int = 4, percent: int = 85) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` (smallest doc_id reachable over links) per document.

    Two documents are linked where 100 * intersection >= ``percent`` * union of their sets of ``k``-word shingles; the
    links are exact. Documents without words, null texts among them, have no links; equal sets are one set, so copies
    and repeated rows are never compared. A null id never names a component that has another id.

    1. Sets whose head has too few shingles that other heads have too cannot have a partner and are left out; so are,
       on whole sets, those with too few shingles in common with all others together.
    2. The rest enter buckets, by subsets or lists. In every bucket all are compared with the member that shares most
       buckets with others; members that are then outside its component are compared with those of other components,
       as far as sizes and places in the order allow a link.
    """
    signed = stored(_first(docs, k, percent), "signed")
    nodes = signed.where("node is not null").groupBy("node").agg(
        F.min("doc_id").alias("low"), F.min(F.struct(*KEY)).alias("first"), F.first("n_shingles").alias("n"), F.first("head").alias("head")
    )
    nodes = stored(nodes.withColumn("num", F.monotonically_increasing_id()), "nodes")
    of = stored(signed.select("doc_id", "n_shingles", "node"), "of")
    discard(signed)

    heads = nodes.select("num", F.explode("head").alias("item"))
    common = heads.groupBy("item").agg(F.count("*").alias("f")).where("f > 1").select("item")
    met = heads.join(common, "item").groupBy("num").agg(F.count("*").alias("met"))
    enough = F.floor(_least("n", percent) / MORE) + 1
    alive = nodes.join(met, "num").where(F.col("met") >= enough).select("num", "n", "first.*")
    sets = stored(_sets(docs, alive, k), "sets")
    shared = _shared(sets, percent).select("num", "n", F.col("shared.item").alias("items"))
    shared = stored(_shared(shared, percent), "shared")

    entries = stored(_entries(shared, percent), "entries")
    sizes = entries.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    entries_met = stored(entries.join(sizes, "key"), "met")
    degree = entries_met.groupBy("num").agg(F.sum("size").alias("degree"))
    columns = ["key", "num", "n", "large", "reach"]
    hubs = entries_met.join(degree, "num").groupBy("key").agg(F.max(F.struct("degree", *columns[1:])).alias("h"))
    hubs = hubs.select("key", F.struct("key", *(f"h.{c}" for c in columns[1:])).alias("hub"))
    members = stored(entries_met.join(hubs, "key").select("hub", F.struct(*columns).alias("e")), "members")
    stars = members.where("hub.num <> e.num").where(_possible("hub", "e", percent))
    stars = stored(stars.select(F.col("hub.num").alias("a"), F.col("e.num").alias("b")).distinct(), "stars")
    links = stored(_confirmed(stars, sets, percent), "links")
    found = stored(components(links), "components")

    root = found.select(F.col("node").alias("num"), "root")
    hub_root = found.select(F.col("node").alias("hub_num"), F.col("root").alias("hub_root"))
    rooted = members.select("e", F.col("e.num").alias("num"), F.col("hub.num").alias("hub_num")).join(root, "num", "left").join(hub_root, "hub_num", "left")
    rooted = rooted.select(F.col("e.key").alias("key"), "e", F.coalesce("root", "num").alias("root"), F.coalesce("hub_root", "hub_num").alias("hub_root"))
    rooted = stored(rooted.withColumn("over", F.col("root") != F.col("hub_root")), "rooted")
    left = rooted.where("over").select("key", F.col("e").alias("x"), F.col("root").alias("x_root"))
    right = rooted.select("key", F.col("e").alias("y"), F.col("root").alias("y_root"), "over")
    rest = left.join(right, "key").where("x_root <> y_root and (not over or x.num < y.num)").where(_possible("x", "y", percent))
    rest = rest.select(F.greatest("x.num", "y.num").alias("a"), F.least("x.num", "y.num").alias("b")).distinct()
    more = stored(_confirmed(stored(rest, "rest"), sets, percent), "more")
    if more.limit(1).count():
        found = stored(components(root.select(F.col("num").alias("a"), F.col("root").alias("b")).unionAll(more)), "components")

    named = nodes.join(found.select(F.col("node").alias("num"), "root"), "num", "left").select("node", "low", F.coalesce("root", "num").alias("root"))
    lowest = named.groupBy("root").agg(F.min("low").alias("component_id"))
    named = stored(named.join(lowest, "root").select("node", "component_id"), "named")
    discard(sets, shared, entries, entries_met, members, stars, links, rooted, more, nodes)
    out = of.join(named, "node", "left")
    return out.select("doc_id", "n_shingles", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def op11_size_aware_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_sets(table(spark, sf_dir, "documents"))


#: All pairs that share a shingle, counted; then the smallest id that each document reaches.
OP11_SQL = r"""
with recursive words as (
  select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda w: w <> '') as w from documents),
sets as (
  select doc_id, list_distinct(case when len(w) = 0 then [] when len(w) < 4 then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) end) as s from words),
named as (select doc_id, s, case when len(s) > 0 then md5(list_sort(s)::varchar) end as g from sets),
groups as (select g, min(doc_id) as doc_id, any_value(s) as s from named where g is not null group by g),
items as (select doc_id, len(s) as n, unnest(s) as item from groups),
shared as (
  select a.doc_id as a, b.doc_id as b from items a join items b
  on a.item = b.item and a.doc_id < b.doc_id and 100 * a.n >= 85 * b.n and 100 * b.n >= 85 * a.n
  group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 85 * (a.n + b.n - count(*))),
links as (select a, b from shared union all select b, a from shared),
reach as (select doc_id, doc_id as low from groups union select l.b, r.low from reach r join links l on l.a = r.doc_id),
roots as (select doc_id, min(low) as low from reach group by doc_id)
select n.doc_id, len(n.s) as n_shingles, coalesce(r.low, n.doc_id) as component_id
from named n left join groups g on g.g = n.g left join roots r on r.doc_id = g.doc_id
"""
