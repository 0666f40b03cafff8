"""Repeated passages by recompression of word sequences.

Rounds rewrite every text: runs of one symbol become one symbol, then neighbouring pairs (left half of the alphabet,
right half) become one symbol. A symbol's name is a hash of what it stands for, and the half it belongs to a bit of
that name, so all tasks name equal runs and pairs alike. With each symbol goes the span of words that its making
depended on: every text that holds this span holds this symbol. A symbol that occurs once in the corpus therefore
rules out all windows around its span, and the windows that no such symbol rules out are verified by their own names.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewatch.llm.common import NO_ID, extended, stored, table, unwrapped, wrapped
from tablewatch.llm.words import mix, raw_words, word_ids

WINDOW = 35
#: Rounds of run and pair naming. Four give symbols of about three to eight words; after more, the words that a symbol
#: depends on often no longer fit in a window.
ROUNDS = 4
#: Symbols of fewer words are too common to rule anything out.
LEAST_WORDS = 4
#: Words or windows handled at a time.
TOGETHER = 1 << 16
#: Stands after each text where several are handled as one sequence.
MARK = 0x5BD1E995A5A5F00D
#: Key of a document in the shuffles.
KEY = ["_k1", "_k2"]


def _merged(level: tuple, low: np.ndarray, high: np.ndarray, joined: np.ndarray, seed: int) -> tuple:
    """The next level: symbols that are ``joined`` to the one before become one, dependences are united."""
    names, first, last = level[:3]
    starts = np.flatnonzero(~joined)
    ends = np.append(starts[1:], len(names)) - 1
    size = (ends - starts + 1).astype(np.uint64)
    made = mix(mix(names[starts] + np.uint64(seed)) ^ mix(names[ends] + size))
    low, high = np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts)
    return np.where(size > 1, made, names[starts]), first[starts], last[ends], low, high


def _beside(low: np.ndarray, high: np.ndarray, n: int) -> tuple[np.ndarray, ...]:
    """Dependences of the symbols before and after; beyond the text lies a place that no window holds."""
    return np.append(-1, low[:-1]), np.append(-1, high[:-1]), np.append(low[1:], n), np.append(high[1:], n)


def _runs(level: tuple, ids: np.ndarray, seed: int) -> tuple:
    """Runs of one symbol become one. That a run ends can mostly be told from the one word beside it."""
    names, first, last, low, high = level
    n = len(ids)
    low0, high0, low1, high1 = _beside(low, high, n)
    told0 = (first > 0) & (ids[first - 1] != ids[last])
    told1 = (last < n - 1) & (ids[(last + 1) % n] != ids[first])
    low0, high0 = np.where(told0, first - 1, low0), np.where(told0, first - 1, high0)
    low1, high1 = np.where(told1, last + 1, low1), np.where(told1, last + 1, high1)
    reach_low, reach_high = np.minimum(low, np.minimum(low0, low1)), np.maximum(high, np.maximum(high0, high1))
    return _merged(level, reach_low, reach_high, np.append(False, names[1:] == names[:-1]), seed)


def _pairs(level: tuple, ids: np.ndarray, seed: int) -> tuple:
    """A left symbol and a right one after it become one. One that stays depends on the neighbour it might have had."""
    names, _, _, low, high = level
    low0, high0, low1, high1 = _beside(low, high, len(ids))
    left = (mix(names + np.uint64(seed)) >> np.uint64(63)) == 0
    joined = np.append(False, left[:-1] & ~left[1:])
    alone = ~joined & ~np.append(joined[1:], False)
    low = np.where(alone, np.minimum(low, np.where(left, low1, low0)), low)
    high = np.where(alone, np.maximum(high, np.where(left, high1, high0)), high)
    return _merged(level, low, high, joined, seed)


def symbols(texts: list[np.ndarray], window: int, rounds: int) -> tuple[np.ndarray, ...]:
    """Text, name and dependence [low, high] of the symbols of the last round whose dependence fits in a window.

    All symbols are of one round, so a text that holds the words of a dependence counts the same symbol there. The
    texts are rewritten as one sequence with a mark after each; what depends on a mark is left out.
    """
    texts_at = [i for i, ids in enumerate(texts) if len(ids) >= window]
    if not texts_at:
        return tuple(np.empty(0, t) for t in (np.int64, np.uint64, np.int64, np.int64))
    mark = np.array([MARK], np.uint64)
    ids = np.concatenate([x for i in texts_at for x in (texts[i], mark)])
    sizes = np.array([len(texts[i]) for i in texts_at])
    starts = np.cumsum(sizes + 1) - sizes - 1
    # of which text a word is, by twos; the mark after it has the odd number
    of = np.repeat(np.arange(2 * len(sizes)), np.stack([sizes, np.ones_like(sizes)], axis=1).ravel())
    n = len(ids)
    at = np.arange(n, dtype=np.int32)
    level = (ids, at, at, at, at)
    for r in range(rounds):
        level = _runs(level, ids, 2 * r + 1)
        level = _pairs(level, ids, 2 * r + 2)
    names, first, last, low, high = level
    keep = (last - first + 1 >= LEAST_WORDS) & (low >= 0) & (high < n) & (high - low < window)
    names, low, high = names[keep], low[keep].astype(np.int64), high[keep].astype(np.int64)
    whole = (of[low] == of[high]) & (of[low] % 2 == 0)
    names, low, high = names[whole], low[whole], high[whole]
    text = of[low] // 2
    return np.array(texts_at)[text], names, low - starts[text], high - starts[text]


def _chunks(counts: list[int], most: int) -> Iterator[slice]:
    """Neighbouring texts of ``most`` words together, or one longer text."""
    lo = total = 0
    for i, n in enumerate(counts):
        if total and total + n > most:
            yield slice(lo, i)
            lo, total = i, 0
        total += n
    if lo < len(counts):
        yield slice(lo, len(counts))


def _text_key() -> list:
    """128 bits of a document's id and text: shorter than id and text hash, and no two documents share them in practice."""
    whole = [F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)), F.coalesce(F.col("text"), F.lit(""))]
    return [F.xxhash64(*whole).alias("_k1"), F.xxhash64(F.lit(7), *whole).alias("_k2")]


def _symbol_rows(keyed: DataFrame, window: int, rounds: int) -> DataFrame:
    """Key, name and dependence (its ends in one number) of every counted symbol."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [word_ids(raw_words(text.as_py(), False)) for text in batch.column(2)]
            for part in _chunks([len(ids) for ids in texts], TOGETHER):
                text, names, low, high = symbols(texts[part], window, rounds)
                if len(names):
                    at = pa.array(text + part.start)
                    spans = pa.array(low << 32 | high)
                    yield pa.RecordBatch.from_arrays([*(batch.column(j).take(at) for j in range(2)), pa.array(names.view(np.int64)), spans], names=[*KEY, "name", "span"])

    return keyed.select(*KEY, "text").mapInArrow(read, "_k1 long, _k2 long, name long, span long")


def _window_names(ids: np.ndarray, at: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit and a 32-bit name of the windows that start at ``at``."""
    one, two = np.full(len(at), window, np.uint64), np.full(len(at), ~np.uint64(window), np.uint64)
    other = mix(ids ^ np.uint64(0xA5A5A5A55A5A5A5A))
    for i in range(window):
        one = mix(one + ids[at + i])
        two = mix(two ^ other[at + i])
    return one.view(np.int64), (two >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _named_windows(found: DataFrame, window: int) -> DataFrame:
    """Key, start and names of the windows in the ranges ``starts``. Names cannot be compressed, so they are
    made here, not stored."""

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            open_at = [_expanded(r) for r in batch.column(3)]
            for part in _chunks([len(x) for x in open_at], TOGETHER):
                texts = [word_ids(raw_words(text.as_py(), False)) for text in batch.column(2)[part]]
                here = open_at[part]
                before = np.cumsum([0, *(len(ids) for ids in texts[:-1])])
                ids, all_at = np.concatenate(texts), np.concatenate([at + b for at, b in zip(here, before)])
                row, start = np.repeat(np.arange(part.start, part.stop), [len(x) for x in here]), np.concatenate(here)
                for lo in range(0, len(start), TOGETHER):
                    some = slice(lo, lo + TOGETHER)
                    one, two = _window_names(ids, all_at[some], window)
                    key = [batch.column(j).take(pa.array(row[some])) for j in range(2)]
                    yield pa.RecordBatch.from_arrays([*key, pa.array(start[some], pa.int32()), pa.array(one), pa.array(two)], names=[*KEY, "start", "w1", "w2"])

    return found.select(*KEY, "text", "starts").mapInArrow(name, "_k1 long, _k2 long, start int, w1 long, w2 int")


def _open_starts(words: int, spans: pa.Scalar, window: int) -> np.ndarray:
    """Starts of windows that no symbol seen once rules out: it rules out those that hold its whole span."""
    n = words - window + 1
    if n < 1:
        return np.empty(0, np.int64)
    steps = np.zeros(n + 1, np.int64)
    if spans.is_valid:
        span = np.asarray(spans.values)
        np.add.at(steps, np.clip((span & 0xFFFFFFFF) - window + 1, 0, n), 1)
        np.add.at(steps, np.clip((span >> 32) + 1, 0, n), -1)
    return np.flatnonzero(np.cumsum(steps[:n]) == 0)


def _ranges(at: np.ndarray) -> np.ndarray:
    """Ascending numbers as ranges: first of each and the one after its last, in turn."""
    breaks = np.flatnonzero(np.diff(at) != 1)
    return np.stack([at[np.append(0, breaks + 1)], at[np.append(breaks, len(at) - 1)] + 1], axis=1).ravel() if len(at) else at


def _expanded(ranges: pa.Scalar) -> np.ndarray:
    ends = np.asarray(ranges.values, np.int64).reshape(-1, 2)
    size = ends[:, 1] - ends[:, 0]
    return np.repeat(ends[:, 0] - np.cumsum(size) + size, size) + np.arange(size.sum())


def _lists(arrays: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    offsets = pa.array(np.cumsum([0, *map(len, arrays)]), pa.int32())
    flat = np.concatenate(arrays) if arrays else np.empty(0)
    return pa.ListArray.from_arrays(offsets, pa.array(flat.astype(kind.to_pandas_dtype())), type=pa.list_(kind))


def _with_windows(docs: DataFrame, window: int, rounds: int, closed=None) -> tuple[DataFrame, DataFrame]:
    """The documents without and with windows that may be repeated; the latter with ranges of the ``starts`` of those
    windows and with those of them that are ``lone`` after all.

    ``docs`` has doc_id, text and further columns. Words lie between ASCII white space, unchanged; a repeated row is a
    copy like any other. ``closed`` may make a column ``done`` of a text without such windows, which then travels
    no further.
    """
    keyed = docs.select(*_text_key(), "*")
    rows = _symbol_rows(keyed, window, rounds)
    once = rows.groupBy("name").agg(F.count("*").alias("times"), *(F.min(c).alias(c) for c in (*KEY, "span"))).where("times = 1")
    ruled = once.groupBy(*KEY).agg(F.collect_list("span").alias("spans"))
    names = [*KEY, *docs.columns]
    text_at = names.index("text")

    def open_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            starts, texts, done = [], [], []
            for text, spans in zip(batch.column(text_at), batch.column(len(names))):
                words = raw_words(text.as_py(), False)
                at = _open_starts(len(words), spans, window)
                starts.append(_ranges(at))
                over = closed is not None and not len(at)
                texts.append(None if over else text.as_py())
                done.append(closed(words) if over else None)
            columns = [pa.array(texts, pa.string()) if i == text_at else batch.column(i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(done, pa.string()), _lists(starts, pa.int32())], names=[*names, "done", "starts"])

    joined = keyed.join(ruled, KEY, "left").select(*names, "spans")
    made = extended(keyed.select(*names).schema, "done string, starts array<int>")
    found = stored(joined.mapInArrow(open_windows, made), "windows")
    some = F.size("starts") > 0
    windows = _named_windows(found.where(some), window)
    lone = windows.groupBy("w1", "w2").agg(F.count("*").alias("times"), *(F.min(c).alias(c) for c in (*KEY, "start"))).where("times = 1")
    lone = lone.groupBy(*KEY).agg(F.collect_list("start").alias("lone"))
    return found.where(~some).drop("starts"), found.where(some).join(lone, KEY, "left")


def _cover(starts: pa.Scalar, lone: pa.Scalar, n: int, window: int) -> np.ndarray:
    """Which of ``n`` words lie in a window that starts in the ranges and not in the list."""
    at = _expanded(starts)
    if lone.is_valid:
        at = np.setdiff1d(at, np.asarray(lone.values), assume_unique=True)
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, at, 1)
    np.add.at(steps, at + window, -1)
    return np.cumsum(steps[:n]) > 0


def _digest(kept: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(kept)).hexdigest()


def repeat_digest(docs: DataFrame, window: int = WINDOW, rounds: int = ROUNDS) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed`` and the SHA-256 of the kept words, joined by one space, per document.

    A word is removed where it is covered by a window whose words also start elsewhere, as judged on the input. A null
    or empty text has no words and the checksum of the empty string; texts shorter than a window keep all words.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, removed, sums = [], [], []
            for text, starts, lone in zip(*(batch.column(j) for j in (1, 2, 3))):
                words = raw_words(text.as_py(), False)
                gone = _cover(starts, lone, len(words), window)
                total.append(len(words))
                removed.append(int(gone.sum()))
                sums.append(_digest([w for w, g in zip(words, gone.tolist()) if not g]))
            out = [batch.column(0), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(sums, pa.string())]
            yield pa.RecordBatch.from_arrays(out, names=["doc_id", "n_words", "n_removed", "kept_sha256"])

    whole = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    closed, open_ = _with_windows(whole, window, rounds, lambda words: f"{len(words)} {_digest(words)}")
    n_words, kept = (F.substring_index("done", " ", i) for i in (1, -1))
    done = closed.select("doc_id", n_words.cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_removed"), kept.alias("kept_sha256"))
    rest = open_.select("doc_id", "text", "starts", "lone").mapInArrow(digest, "doc_id long, n_words long, n_removed long, kept_sha256 string")
    return done.unionByName(rest)


def without_repeats(docs: DataFrame, window: int = 50, rounds: int = ROUNDS) -> DataFrame:
    """The documents with repeated windows cut from their texts, all else as it was; those left without a word go.

    All columns are kept. ``n_chars``, where present, is set to the new length of a text that was cut.
    """
    word = re.compile(rb"[^\x20\x09-\x0D]+")

    def cut(text: str, starts: pa.Scalar, lone: pa.Scalar) -> tuple[str, bool]:
        raw = text.encode("utf-8", "surrogatepass")
        spans = [m.span() for m in word.finditer(raw)]
        gone = _cover(starts, lone, len(spans), window)
        edges = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0, append=0))
        kept, at = [], 0
        for lo, hi in zip(edges[::2], edges[1::2]):
            kept.append(raw[at : spans[lo][0]])
            at = spans[hi - 1][1]
        return b"".join([*kept, raw[at:]]).decode("utf-8", "surrogatepass"), bool(len(edges))

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [cut(t.as_py(), s, x) for t, s, x in zip(*(batch.column(j) for j in (0, 2, 3)))]
            yield pa.RecordBatch.from_arrays([pa.array([m[0] for m in made], pa.string()), batch.column(1), pa.array([m[1] for m in made], pa.bool_())], names=["text", "row", "cut"])

    closed, open_ = _with_windows(wrapped(docs), window, rounds)
    rows = open_.select("text", "row", "starts", "lone")
    rows = rows.mapInArrow(rewrite, extended(rows.select("text", "row").schema, "cut boolean"))
    rows = rows.unionByName(closed.select("text", "row", F.lit(False).alias("cut")))
    rows = rows.where(~F.col("cut") | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return unwrapped(rows, docs, cut=F.col("cut"))


def op8_recompression_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeat_digest(table(spark, sf_dir, "documents"))
