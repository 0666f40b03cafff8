"""Best-fit packing of tokenized documents into sequences of fixed capacity.

Pieces are range-sorted by length, which gives each its rank among the pieces of its length. Pieces of one length
are interchangeable, and so are sequences with one gap, so both sides of the matching are held as sorted *runs*
(length or gap, first rank, count). Rounds go from the longest to the shortest length: all pieces of the length sweep
the gaps upward from their successor (the smallest gap that holds them), the k-th piece takes the k-th place in that
order, the gaps are updated, and the next round follows. The number of runs is bounded by the capacity, whatever the
size of the corpus; rows take part in parallel, by looking their rank up in the runs, and are shuffled once.
"""

from __future__ import annotations

import bisect
import json
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewatch.llm.common import extended, stored, table

CAPACITY = 2048
VOCABULARY = "byte_bpe_50k.json"
#: Entries of a worker's word cache before it starts anew.
CACHE = 200_000
#: Blanks at which a text can be cut, and blanks beside other white space, at which it can't.
CUT, BESIDE = re.compile(r" (?<=\S )(?=\S)"), re.compile(r" (?:(?<=\s )|(?=\s))")
PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _byte_alphabet() -> dict[str, int]:
    """Characters that byte-level vocabularies write for the 256 bytes: printable ones as they are, others from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Encoder:
    """Token ids of whole texts, as the ``tokenizers`` library gives them for a byte-level BPE file.

    Where ids ascend in merge order the vocabulary is run as ranks, word by word with a cache, which is several times
    as fast; texts holding a special token are encoded whole, white space of several characters with its neighbours.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        self.bpe = self._ranks(spec)
        self.words: dict[str, bytes] = {}

    def _ranks(self, spec: dict):
        import public_tokenizers
        import tiktoken

        vocab, pre = spec["model"]["vocab"], spec.get("pre_tokenizer") or {}
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        ids = [vocab["".join(m)] for m in merges]
        plain = pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and not spec.get("normalizer")
        if not plain or ids != sorted(ids):
            return None
        byte = _byte_alphabet()
        ranks = {bytes(byte[c] for c in t): i for t, i in vocab.items() if t not in self.special}
        return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def _encoded(self, text: str) -> bytes:
        return np.asarray(self.bpe.encode_ordinary(text), "<u4").tobytes()

    def __call__(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        if self.bpe is None or any(s in text for s in self.special):
            return np.asarray(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        # a blank between characters that are no white space belongs to the word after it: no token crosses such a cut
        words, out = self.words, []
        first, *rest = CUT.split(text) if BESIDE.search(text) else text.split(" ")
        if first:
            out.append(self._encoded(first))
        for w in rest:
            ids = words.get(w)
            if ids is None:
                if len(words) >= CACHE:
                    words.clear()
                ids = self._encoded(" " + w)
                if len(w) < 64:
                    words[w] = ids
            out.append(ids)
        return b"".join(out)


_encoders: dict[str, Encoder] = {}


def encoder(path: str | None) -> Encoder:
    """This worker's encoder for a vocabulary file; without a path, the installed one."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(VOCABULARY)
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def pieces(docs: DataFrame, capacity: int = CAPACITY, end_id: int = 0, path: str | None = None) -> DataFrame:
    """Token pieces of every document: ids of the whole text, then ``end_id``, cut only where longer than ``capacity``.

    All pieces but the first have full length. A null text is empty and gives the end id alone; a null id is kept;
    repeated rows are separate documents. Further columns of ``docs`` are ignored.
    """
    end = np.asarray([end_id], "<u4").tobytes()
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encode(text.as_py() or "") + end
                n = len(ids) // 4
                start, piece = 0, 0
                stop = n % capacity or capacity
                while start < n:
                    rows.append((doc_id, piece, start, stop - start, zlib.crc32(ids[4 * start : 4 * stop])))
                    start, stop, piece = stop, stop + capacity, piece + 1
            cols = list(zip(*rows)) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(cols, schema)], schema=schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(cut, PIECE_SCHEMA)


def match_runs(histogram: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Rounds of best fit over runs: places (length, first rank, first sequence, pieces each, offset), and the sequences.

    A place holds from its first rank until the next place of the same length.
    """
    gaps: list[int] = []
    open_runs: dict[int, list[tuple[int, int]]] = defaultdict(list)
    places, sequences = [], 0

    def put(gap: int, first: int, count: int) -> None:
        if gap and count:
            if not open_runs[gap]:
                bisect.insort(gaps, gap)
            open_runs[gap].append((first, count))

    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            at = bisect.bisect_left(gaps, length)
            if at < len(gaps):
                gap = gaps[at]
                first, count = open_runs[gap].pop()
                if not open_runs[gap]:
                    del gaps[at]
                each = gap // length
            else:
                gap, first, each = capacity, sequences, capacity // length
                count = -(-left // each)
                sequences += count
            places.append((length, rank, first, each, capacity - gap))
            full = min(count, left // each)
            put(gap - each * length, first, full)
            over = left - full * each if full < count else 0
            if over:
                put(gap - over * length, first + full, 1)
            used = full + (1 if over else 0)
            put(gap, first + used, count - used)
            rank += full * each + over
            left -= full * each + over
    return places, sequences


def pack(items: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to rows with a ``length`` from 1 to ``capacity``.

    Every row gets a place; sequences are filled gaplessly from 0. Ties of length take places in the order of the
    other columns as partitioned; an empty table gives an empty table. Other columns are kept.
    """
    items = items.drop("sequence_id", "offset", "_part", "_rank")
    names = items.columns

    def ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), defaultdict(int)
        for batch in batches:
            lengths = np.asarray(batch.column(names.index("length")))
            ranks = np.empty(len(lengths), np.int64)
            cuts = np.flatnonzero(np.diff(lengths, prepend=-1))
            for lo, hi in zip(cuts, [*cuts[1:], len(lengths)]):
                n = int(lengths[lo])
                ranks[lo:hi] = np.arange(seen[n], seen[n] + hi - lo)
                seen[n] += hi - lo
            part_of = pa.array(np.full(len(lengths), part, np.int32))
            yield pa.RecordBatch.from_arrays([*batch.columns, part_of, pa.array(ranks)], names=[*names, "_part", "_rank"])

    tie = F.xxhash64(*(c for c in names if c != "length")) if len(names) > 1 else F.lit(0)
    in_order = items.withColumn("_tie", tie).repartitionByRange(F.desc("length"), "_tie").sortWithinPartitions(F.desc("length"), "_tie")
    rows = stored(in_order.drop("_tie").mapInArrow(ranked, extended(items.schema, "_part int, _rank long")), "ranked")
    # at most one row for each length and one more for each partition
    counts = rows.groupBy("length", "_part").count().orderBy("length", "_part").collect()
    first_rank, histogram = {}, defaultdict(int)
    for length, part, n in counts:
        first_rank[part, length] = histogram[length]
        histogram[length] += n
    if histogram and not 1 <= min(histogram) <= max(histogram) <= capacity:
        raise ValueError(f"lengths must lie between 1 and {capacity}")
    places, _ = match_runs(histogram, capacity)
    by_length = defaultdict(list)
    for length, *place in places:
        by_length[length].append(place)
    runs = {n: np.asarray(p, np.int64).T for n, p in by_length.items()}

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, part, rank = (np.asarray(batch.column(i)) for i in (names.index("length"), len(names), len(names) + 1))
            sequence, offset = np.empty(len(rank), np.int64), np.empty(len(rank), np.int64)
            cuts = np.flatnonzero((np.diff(length, prepend=-1) != 0) | (np.diff(part, prepend=-1) != 0))
            for lo, hi in zip(cuts, [*cuts[1:], len(rank)]):
                n = int(length[lo])
                ranks, firsts, each, offsets = runs[n]
                r = rank[lo:hi] + first_rank[int(part[lo]), n]
                at = np.searchsorted(ranks, r, "right") - 1
                r = r - ranks[at]
                sequence[lo:hi] = firsts[at] + r // each[at]
                offset[lo:hi] = offsets[at] + r % each[at] * n
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], pa.array(sequence), pa.array(offset)], names=[*names, "sequence_id", "offset"])

    return rows.mapInArrow(placed, extended(items.schema, "sequence_id long, offset long"))


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """Pieces of all documents with their sequence and offset."""
    return pack(stored(pieces(docs, capacity, path=path), "pieces"), capacity)


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
