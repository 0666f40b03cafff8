"""Near-duplicate documents by circulant MinHash.

A shingle set is a subset of the 64-bit numbers. One permutation scatters it, a second one, shifted circularly by k,
gives coordinate k of the signature as its minimum over the set, so two permutations serve all coordinates.
Documents that agree in a whole band are candidates, unless so few coordinates agree that the similarity sought can
be ruled out, and links are confirmed on the full sets.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tablewatch.llm.common import KEY, stored, table, text_key, unwrapped, wrapped
from tablewatch.llm.graph import components
from tablewatch.llm.words import mix, raw_words, shingles, word_ids

#: 24 bands of 4 rows: of pairs with a similarity of exactly 0.8, four in a million share no band; above it, fewer.
BANDS, ROWS = 24, 4
#: A pair is ruled out where at the similarity sought so few coordinates would agree once in so many cases.
RULED_OUT = 1e-6
#: Members of larger buckets are compared in blocks of so many.
SIDE = 256
#: Buckets of at most so many members are compared in a join, where every pair is a row: a leftover makes at most so many.
FEW = 32
_BLOCK = 2048
_A, _B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_S = np.uint64(32)


def signature(sets: np.ndarray, size: int) -> np.ndarray:
    """Coordinate k is the minimum over the set of pi((sigma(x) + k) mod 2^64)."""
    best = np.full(size, np.iinfo(np.uint64).max, np.uint64)
    shift = np.arange(size, dtype=np.uint64)[:, None]
    scattered = mix(sets ^ _B)
    for lo in range(0, len(sets), _BLOCK):
        x = scattered[None, lo : lo + _BLOCK] + shift
        x *= _A
        x ^= x >> _S
        x *= _B
        np.minimum(best, x.min(axis=1), out=best)
    return best


def _band_names(sig: np.ndarray, bands: int) -> np.ndarray:
    names = np.arange(bands, dtype=np.uint64)
    for row in sig.reshape(bands, -1).T:
        names = mix(names + row)
    return names


def least_agreeing(size: int, percent: int, odds: float = RULED_OUT) -> int:
    """The number of agreeing coordinates that a pair of the least similarity falls below with these odds."""
    p, below = percent / 100, 0.0
    for n in range(size + 1):
        below += math.comb(size, n) * p**n * (1 - p) ** (size - n)
        if below > odds:
            return n
    return size


def signatures(docs: DataFrame, k: int, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Key, ``n_shingles``, ``node`` (a 128-bit name of the shingle set; null without shingles), the signature in 16 bits
    a coordinate, and band names per document."""
    schema = "doc_id long, _id long, _t1 long, _t2 long, n_shingles long, node binary, signature binary, bands array<long>"
    lists = pa.list_(pa.int64())

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, nodes, marks, offsets, values = [], [], [], [0], []
            for text in batch.column(4):
                s = shingles(word_ids(raw_words(text.as_py(), True)), k)
                counts.append(len(s))
                if len(s):
                    nodes.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                    sig = signature(s, bands * rows)
                    marks.append((sig >> np.uint64(48)).astype("<u2").tobytes())
                    values.append(_band_names(sig, bands).view(np.int64))
                else:
                    nodes.append(None)
                    marks.append(None)
                offsets.append(offsets[-1] + (bands if len(s) else 0))
            flat = np.concatenate(values) if values else np.empty(0, np.int64)
            names = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat), type=lists)
            out = [*batch.columns[:4], pa.array(counts, pa.int64()), pa.array(nodes, pa.binary()), pa.array(marks, pa.binary()), names]
            yield pa.RecordBatch.from_arrays(out, names=["doc_id", *KEY, "n_shingles", "node", "signature", "bands"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), *text_key(), "text").mapInArrow(sign, schema)


def _sets(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """(node, shingles as 64-bit integers) of the wanted nodes, each read from one of its documents."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(word_ids(raw_words(t.as_py(), True)), k).tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], names=["node", "items"])

    keyed = docs.select(*text_key(), "text")
    found = keyed.join(wanted, KEY)
    return found.select("node", "text").mapInArrow(read, "node binary, items binary").dropDuplicates(["node"])


def _linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)


def _agreeing(pairs: DataFrame, least: int) -> DataFrame:
    """The pairs (a, b) whose signatures ``x`` and ``y`` agree in at least so many coordinates."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two = (np.frombuffer(b"".join(batch.column(i).to_pylist()), "<u2").reshape(batch.num_rows, -1) for i in (2, 3))
            keep = (one == two).sum(axis=1) >= least if batch.num_rows else []
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.select("a", "b", "x", "y").mapInArrow(compare, "a binary, b binary")


def _alike(one: str, two: str, percent: int) -> Column:
    """Whether two sets of these sizes can be similar enough."""
    return F.least(one, two) * 100 >= F.greatest(one, two) * percent


def _likely(pairs: DataFrame, nodes: DataFrame, percent: int, least: int) -> DataFrame:
    """The pairs (a, b) whose sizes and signatures do not rule out a link."""
    one = nodes.select(F.col("node").alias("a"), F.col("signature").alias("x"), F.col("n").alias("na"))
    two = nodes.select(F.col("node").alias("b"), F.col("signature").alias("y"), F.col("n").alias("nb"))
    return _agreeing(pairs.join(one, "a").join(two, "b").where(_alike("na", "nb", percent)), least)


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) with 100 * intersection >= percent * union of their full sets."""

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [_linked(*(np.frombuffer(v.as_py(), np.uint64) for v in xy), percent) for xy in zip(batch.column(2), batch.column(3))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    one = sets.select(F.col("node").alias("a"), F.col("items").alias("x"))
    two = sets.select(F.col("node").alias("b"), F.col("items").alias("y"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "x", "y").mapInArrow(confirm, "a binary, b binary")


def _across(left: pd.DataFrame, right: pd.DataFrame, percent: int, least: int):
    """Index pairs of two blocks of one bucket that are in different components, in no earlier bucket together, and not
    ruled out by size or signature; of two that are both left over, only one order."""
    marks = np.frombuffer(b"".join(right.signature), "<u2").reshape(len(right), -1)
    bands = np.stack(right.bands.to_numpy())
    roots, nodes, sizes, over = right.root.to_numpy(), right.node.to_numpy(), right.n.to_numpy(), right.over.to_numpy()
    for i, x in enumerate(left.itertuples()):
        near = (marks == np.frombuffer(x.signature, "<u2")).sum(axis=1) >= least
        near &= 100 * np.minimum(sizes, x.n) >= percent * np.maximum(sizes, x.n)
        at = np.flatnonzero(near)
        at = at[(bands[at] == np.asarray(x.bands)).argmax(axis=1) == x.band]
        yield i, [j for j in at if roots[j] != x.root and not (over[j] and nodes[j] <= x.node)]


_SIDE_KEY = ["band", "name", "chunk", "block"]


def _leftovers(open_: DataFrame, nodes: DataFrame, docs: DataFrame, k: int, percent: int, least: int) -> DataFrame:
    """Links (a, b) between members of a bucket that are in different components.

    Leftovers are the members outside the component of their bucket's hub. They meet the members of a small bucket in
    a join, those of a larger one block by block.
    """
    sizes = open_.groupBy("band", "name").agg(F.count("*").alias("m"), F.count_if("over").alias("l")).where("l > 0")
    met = open_.join(sizes, ["band", "name"]).join(nodes.select("node", "n", "signature", "bands"), "node")
    met = stored(met, "met")
    most = min(FEW, SIDE)
    few = _in_small(met.where(F.col("m") <= most), nodes, docs, k, percent, least)
    return few.unionAll(_in_blocks(met.where(F.col("m") > most), nodes, docs, k, percent, least))


def _in_small(met: DataFrame, nodes: DataFrame, docs: DataFrame, k: int, percent: int, least: int) -> DataFrame:
    """Links of leftovers in buckets of at most ``FEW`` members, each of which meets at most so many others.

    Components, sizes and signatures are compared where the bucket is joined, so that few pairs are shuffled.
    """
    one = met.where("over").select("band", "name", *(F.col(c).alias(to) for c, to in (("node", "a"), ("root", "ra"), ("n", "na"), ("signature", "x"))))
    two = met.select("band", "name", "over", *(F.col(c).alias(to) for c, to in (("node", "b"), ("root", "rb"), ("n", "nb"), ("signature", "y"))))
    # of two that are both left over, only one order
    pairs = one.join(two, ["band", "name"]).where("ra <> rb and (not over or a < b)").where(_alike("na", "nb", percent))
    pairs = stored(_agreeing(pairs, least).distinct(), "pairs")
    ends = pairs.select(F.col("a").alias("node")).unionAll(pairs.select("b")).distinct()
    return _confirmed(pairs, _sets(docs, _first_documents(ends, nodes), k), percent)


def _in_blocks(met: DataFrame, nodes: DataFrame, docs: DataFrame, k: int, percent: int, least: int) -> DataFrame:
    """Links of leftovers in buckets of any size: a chunk of them meets a block of the bucket at a time.

    A first pass by signatures tells who is needed where, a second one brings those sets and compares.
    """
    chunks, blocks = (F.ceil(F.col(c) / SIDE).cast("int") for c in ("l", "m"))
    salt = lambda n: F.pmod(F.xxhash64("node"), n).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    columns = ["band", "name", "node", "root", "n", "over", "signature", "bands"]
    left = met.where("over").select(*columns, salt(chunks).alias("chunk"), blocks.alias("of")).select(*columns, "chunk", every(F.col("of")).alias("block"))
    right = met.select(*columns, salt(blocks).alias("block"), chunks.alias("of")).select(*columns, every(F.col("of")).alias("chunk"), "block")
    right = right.select(*(F.col(c).alias(f"right_{c}") for c in right.columns))

    def needed(one: pd.DataFrame, two: pd.DataFrame) -> pd.DataFrame:
        out, two = [], two.rename(columns=lambda c: c.removeprefix("right_"))
        if len(one) and len(two):
            wanted = set()
            for i, found in _across(one, two, percent, least):
                if found:
                    out.append((*one.iloc[i][["band", "name", "chunk", "block", "node"]], True, [two.node.iloc[j] for j in found]))
                    wanted.update(found)
            key = one.iloc[0][["band", "name", "chunk", "block"]] if out else None
            out += [(*key, two.node.iloc[j], False, None) for j in sorted(wanted)]
        return pd.DataFrame(out, columns=[*_SIDE_KEY, "node", "is_left", "with"])

    schema = "band int, name long, chunk int, block int, node binary, is_left boolean, with array<binary>"
    need = left.groupBy(*_SIDE_KEY).cogroup(right.groupBy(*(f"right_{c}" for c in _SIDE_KEY))).applyInPandas(needed, schema)
    need = stored(need, "needed")
    sets = _sets(docs, _first_documents(need.select("node").distinct(), nodes), k)
    rows = need.join(sets, "node").join(met.select("node", "root").distinct(), "node")

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        sets = {n: np.frombuffer(x, np.uint64) for n, x in zip(group.node, group["items"])}
        root = dict(zip(group.node, group.root))
        links, joined = [], set()
        for x, others in zip(group.node[group.is_left], group["with"][group.is_left]):
            for y in others:
                # one link to a component is enough
                if (x, root[y]) not in joined and _linked(sets[x], sets[y], percent):
                    joined.add((x, root[y]))
                    links.append((x, y))
        return pd.DataFrame(links, columns=["a", "b"])

    return rows.groupBy(*_SIDE_KEY).applyInPandas(compare, "a binary, b binary")


def _first_documents(wanted: DataFrame, nodes: DataFrame) -> DataFrame:
    return wanted.join(nodes, "node").select("node", "first.*")


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` (smallest doc_id reachable over links) and ``kept`` per document.

    Two documents are linked where the Jaccard similarity of their sets of ``k``-word shingles is at least
    ``percent`` / 100. Documents without words have no links; a null text has no words; equal sets are one node, so
    copies and repeated rows are never compared with each other. A null id is kept and never names a component that
    has another id. Also returned: the document's key (id and text hashes), ``node``, and ``root``, which names the
    component itself: unlike ``component_id``, no two components share it, whatever ids are null or repeated.

    In every bucket the member that shares most buckets with others is the hub, and all are confirmed against it.
    Members that this leaves outside the hub's component are then compared with all of another component, in blocks
    that emit links alone; members that are together already need no comparison.
    """
    least = least_agreeing(bands * rows, percent)
    signed = stored(signatures(docs, k, bands, rows), "signed")
    first = F.min(F.struct(*KEY)).alias("first")
    same = [F.first(c).alias(c) for c in ("bands", "signature")]
    nodes = signed.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("low"), first, F.first("n_shingles").alias("n"), *same)
    nodes = stored(nodes, "nodes")
    exploded = nodes.select("node", F.posexplode("bands").alias("band", "name"))
    shared = exploded.groupBy("band", "name").agg(F.count("*").alias("size")).where("size > 1")
    members = stored(exploded.join(shared, ["band", "name"]), "members")
    degree = members.groupBy("node").agg(F.sum("size").alias("degree"))
    ranked = members.join(degree, "node")
    hubs = ranked.groupBy("band", "name").agg(F.max(F.struct("degree", "node"))["node"].alias("hub"))
    members = stored(members.join(hubs, ["band", "name"]).select("band", "name", "hub", "node"), "hubs")
    stars = members.where("hub <> node").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    stars = stored(_likely(stars, nodes, percent, least), "stars")
    ends = stars.select(F.col("a").alias("node")).unionAll(stars.select("b")).distinct()
    sets = stored(_sets(docs, _first_documents(ends, nodes), k), "sets")
    links = stored(_confirmed(stars, sets, percent), "links")
    found = stored(components(links), "components")

    hub_roots = found.select(F.col("node").alias("hub"), F.col("root").alias("hub_root"))
    rooted = members.join(found, "node", "left").join(hub_roots, "hub", "left")
    rooted = rooted.select("band", "name", "node", F.coalesce("root", "node").alias("root"), F.coalesce("hub_root", "hub").alias("hub_root"))
    open_ = stored(rooted.withColumn("over", F.col("root") != F.col("hub_root")).drop("hub_root"), "open")
    more = stored(_leftovers(open_, nodes, docs, k, percent, least), "more")
    if more.limit(1).count():
        # what is linked across components joins their roots
        found = stored(components(found.select(F.col("node").alias("a"), F.col("root").alias("b")).unionAll(more)), "components")

    rooted = nodes.join(found, "node", "left").select("node", "low", F.coalesce("root", "node").alias("root"))
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    named = rooted.join(lowest, "root").select("node", "root", "component_id")
    out = signed.drop("bands", "signature").join(named, "node", "left").withColumn(
        "component_id", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    )
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), *KEY, "node", "root")


def keep_first(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """One row of each group of near-duplicates, with the columns of ``docs``: that of the smallest id, then text hash.

    A null id comes last. Unlike texts that share an id, or have none, are groups of their own.
    """
    found = near_duplicates(docs, k, percent).where("kept")
    lone = found.where("node is null")
    # of those kept in one component, all have the same id or none
    one = found.where("node is not null").groupBy("root").agg(F.min(F.struct(*KEY)).alias("first")).select("first.*")
    keep = lone.select(*KEY).unionAll(one).distinct()
    # several rows of one id and text are one document
    single = wrapped(docs).withColumns(dict(zip(KEY, text_key()))).join(keep, KEY)
    copies = single.withColumn("copy", F.row_number().over(Window.partitionBy(*KEY).orderBy(F.xxhash64("row"))))
    return unwrapped(copies.where("copy = 1"), docs)


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), k=2).select("doc_id", "n_shingles", "component_id", "kept")
