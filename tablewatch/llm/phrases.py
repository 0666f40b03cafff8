"""Phrase collocations by dynamic itemset counting.

The corpus is dealt into shards that are scanned in turn, again and again. Single words are counted from the first
shard on; a longer phrase is counted from the shard after the one at whose end both of its parts, the phrase without
its last word and the one without its first, had reached the threshold. Every phrase is counted for one full cycle
of shards, so its count is that of the whole corpus, and lengths interleave within one scan.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tablewatch.llm.common import discard, stored, table
from tablewatch.llm.words import mix, word_ids

#: Shards of a cycle.
SHARDS = 4
#: Slots of the table of phrases that reached the threshold. Phrases that share a slot are counted from the first one's
#: shard on, which costs work and changes no count; the table's size does not grow with the corpus.
SLOTS = 1 << 22
_MASK = np.uint64(SLOTS - 1)
_NEVER = np.uint8(255)
#: Words of a stream that are handled at once; keys that are gathered, or remembered, at once.
WORDS, KEYS = 1 << 18, 1 << 22
#: Shares of the texts, one in so many, that are searched for the words of phrases; the last one is the whole.
SHARES = (64, 8, 1)
#: Bits of a key that its mark does not depend on.
_MARK = 32
#: Names of phrases that are handed on at once.
NAMES = 10_000
#: Bytes of a text that are split into words at once.
SLICE = 1 << 20

#: A-Z in lower case; tab as space; the characters that end a piece, [.,;:!?\x0A-\x0D], as a byte that UTF-8 never uses.
_END = b"\xff"
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz " + _END * 10)
_END_ID = word_ids([_END])[0]


def _word_lists(text: str | None) -> Iterator[list[bytes]]:
    """Words of a text, and an end mark after each piece, in slices of bounded size."""
    raw = (text or "").encode("utf-8", "surrogatepass").translate(_FOLD)
    at = 0
    while at < len(raw):
        to = raw.find(b" ", at + SLICE)
        to = len(raw) if to < 0 else to
        yield raw[at:to].replace(_END, b" \xff ").split()
        at = to
    yield [_END]


def lang_key(lang: str) -> np.uint64:
    """The key of a language: that of its phrase without words."""
    return np.uint64(xxhash.xxh3_64_intdigest(lang.encode("utf-8", "surrogatepass"), seed=1))


def _words(text: str | None) -> list[bytes]:
    return [w for found in _word_lists(text) for w in found]


def _text_id() -> Column:
    """A hash of a text and its language; texts that share one are both searched, which changes no name."""
    return F.xxhash64("text", "lang").alias("text_id")


def _streams(docs: DataFrame, shards: int) -> DataFrame:
    """(seed, ids, text_id, shard): the key of each text's language, its words, with end marks, as 64-bit numbers, and a
    hash by which the text is found again."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seeds = np.array([lang_key(n.as_py()) for n in batch.column(1)], np.uint64).view(np.int64)
            ids = [np.concatenate([word_ids(w) for w in _word_lists(t.as_py())]).tobytes() for t in batch.column(0)]
            arrays = [pa.array(seeds), pa.array(ids, pa.binary()), batch.column(2), batch.column(3)]
            yield pa.RecordBatch.from_arrays(arrays, names=["seed", "ids", "text_id", "shard"])

    dealt = docs.withColumn("shard", F.pmod(F.monotonically_increasing_id(), F.lit(shards)).cast("int"))
    return dealt.select("text", "lang", _text_id(), "shard").mapInArrow(read, "seed long, ids binary, text_id long, shard int")


def _parts(ids: np.ndarray, seeds: np.ndarray, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray, int, int]]:
    """Parts of a stream of bounded size, each with the words that a phrase from its last start needs, and its place and
    number of starts."""
    for at in range(0, len(ids), WORDS):
        to = at + WORDS + longest - 1
        yield ids[at:to], seeds[at:to], at, WORDS


def _phrases(ids: np.ndarray, seeds: np.ndarray, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each length the keys of the phrases at every start, and whether a phrase lies within a piece."""
    inside = ids != _END_ID
    keys, ok = seeds, np.ones(len(ids), bool)
    for k in range(1, min(longest, len(ids)) + 1):
        n = len(ids) - k + 1
        keys = mix(keys[:n] + ids[k - 1 :])
        ok = ok[:n] & inside[k - 1 :]
        yield k, keys, ok


def _scan(shard: DataFrame, step: int, shards: int, reached, longest: int) -> DataFrame:
    """(key, tag, n): occurrences, in one shard, of the phrases that are active at a step. The tag is the step from which
    a phrase is active, times eight, and its length."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = np.frombuffer(reached.value, np.uint8)
        gathered: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def counted() -> pa.RecordBatch:
            keys, at, n = np.unique(np.concatenate([k for k, _ in gathered]), return_index=True, return_counts=True)
            tags = np.concatenate([t for _, t in gathered])[at]
            return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(tags), pa.array(n)], names=["key", "tag", "n"])

        for batch in batches:
            rows = [np.frombuffer(x.as_py(), np.uint64) for x in batch.column(1)]
            seeds = batch.column(0).to_numpy().view(np.uint64).repeat([len(x) for x in rows])
            for ids, seeds, _, starts in _parts(np.concatenate(rows), seeds, longest) if rows else ():
                since = np.zeros(len(ids) + 1, np.int16)
                for k, keys, ok in _phrases(ids, seeds, longest):
                    since = np.maximum(since[: len(keys)], since[1 : len(keys) + 1])
                    active = (ok & (since <= step) & (since + shards > step))[:starts]
                    found = np.flatnonzero(active)
                    if k == 1 and len(found):
                        gathered.append((seeds[found], np.zeros(len(found), np.int16)))
                    gathered.append((keys[found], since[found] * np.int16(8) + np.int16(k)))
                    size += len(found)
                    since = np.where(ok, slots[keys & _MASK], _NEVER).astype(np.int16)
                if size >= KEYS:
                    yield counted()
                    gathered, size = [], 0
        if size:
            yield counted()

    return shard.select("seed", "ids").mapInArrow(count, "key long, tag short, n long")


def _slots(keys: DataFrame) -> np.ndarray:
    """The distinct slots of keys: at most all of the table's."""
    found = keys.select(F.col("key").bitwiseAND(F.lit(SLOTS - 1)).cast("int").alias("slot")).distinct()
    return found.toArrow().column("slot").to_numpy()


def frequent(dealt: DataFrame, longest: int, least: int, shards: int = SHARDS) -> DataFrame:
    """(key, k, n) of all phrases of up to ``longest`` words with ``least`` or more occurrences, and for k = 0 the number
    of words of each language. ``dealt`` are the stored streams of all texts."""
    spark = dealt.sparkSession
    slots = np.full(SLOTS, _NEVER)
    state, step, last = None, 0, 0
    while step < last + shards:
        reached = spark.sparkContext.broadcast(slots.tobytes())
        new = _scan(dealt.where(F.col("shard") == step % shards), step, shards, reached, longest)
        both = new if state is None else state.unionByName(new)
        both = both.groupBy("key").agg(F.min("tag").alias("tag"), F.sum("n").alias("n"))
        # what has been counted for a full cycle and has not reached the threshold goes
        ended = F.shiftright("tag", 3) + shards <= step + 1
        before, state = state, stored(both.where((F.col("n") >= least) | ~ended), "counts")
        reached.destroy()
        if before is not None:
            discard(before)
        parts = F.col("tag").bitwiseAND(F.lit(7)).between(1, longest - 1)
        found = _slots(state.where((F.col("n") >= least) & parts))
        found = found[slots[found] == _NEVER]
        step += 1
        if len(found):
            slots[found] = step
            last = step
    return state.where(F.col("n") >= least).select("key", F.col("tag").bitwiseAND(F.lit(7)).cast("int").alias("k"), "n")


def _marks(keys: DataFrame) -> np.ndarray:
    """A mark of the key that takes each slot: 0 where there is none, 255 where there are several unlike ones."""
    slot = F.col("key").bitwiseAND(F.lit(SLOTS - 1)).cast("int").alias("slot")
    mark = (F.pmod(F.shiftright("key", _MARK), F.lit(254)) + 1).cast("int").alias("mark")
    found = keys.select(slot, mark).groupBy("slot").agg(F.min("mark").alias("low"), F.max("mark").alias("high")).toArrow()
    low, high = found.column("low").to_numpy(), found.column("high").to_numpy()
    marks = np.zeros(SLOTS, np.uint8)
    marks[found.column("slot").to_numpy()] = np.where(low == high, low, 255)
    return marks


def _marked(marks: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether keys may be among those that made the marks."""
    there = marks[keys & np.uint64(len(marks) - 1)]
    return (there == 255) | (there == (keys.view(np.int64) >> _MARK) % 254 + 1)


def _named(docs: DataFrame, marks, longest: int) -> DataFrame:
    """(key, lang, words) of the phrases of two and more words that may be marked, once and again."""
    schema = "key long, lang string, words array<binary>"

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        taken = np.frombuffer(marks.value, np.uint8)
        seen: set[int] = set()
        out: list[tuple[int, str, list[bytes]]] = []

        def named() -> pa.RecordBatch:
            types = [pa.int64(), pa.string(), pa.list_(pa.binary())]
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], names=["key", "lang", "words"])

        for batch in batches:
            for text, lang in zip(batch.column(0), batch.column(1)):
                words, lang = _words(text.as_py()), lang.as_py()
                whole = word_ids(words)
                for ids, seeds, place, starts in _parts(whole, np.full(len(words), lang_key(lang)), longest):
                    for k, keys, ok in _phrases(ids, seeds, longest):
                        if k > 1:
                            at = np.flatnonzero((ok & _marked(taken, keys))[:starts])
                            for key, i in zip(keys[at].view(np.int64).tolist(), (at + place).tolist()):
                                if key not in seen:
                                    seen.add(key)
                                    out.append((key, lang, words[i : i + k]))
            if len(out) >= NAMES:
                yield named()
                out = []
            if len(seen) >= KEYS:
                seen.clear()
        yield named()

    return docs.select("text", "lang").mapInArrow(name, schema)


def _holders(dealt: DataFrame, marks, longest: int) -> DataFrame:
    """(key, text_id) of texts that hold phrases that may be marked, found in the stored numbers of their words."""

    def hold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        taken = np.frombuffer(marks.value, np.uint8)
        seen = np.zeros(0, np.uint64)
        for batch in batches:
            rows = [np.frombuffer(x.as_py(), np.uint64) for x in batch.column(1)]
            lengths = [len(x) for x in rows]
            seeds = batch.column(0).to_numpy().view(np.uint64).repeat(lengths)
            texts = batch.column(2).to_numpy().repeat(lengths)
            for ids, seeds, place, starts in _parts(np.concatenate(rows), seeds, longest) if rows else ():
                for k, keys, ok in _phrases(ids, seeds, longest):
                    if k > 1:
                        at = np.flatnonzero((ok & _marked(taken, keys))[:starts])
                        new, first = np.unique(keys[at], return_index=True)
                        fresh = ~np.isin(new, seen)
                        if fresh.any():
                            new, first = new[fresh], at[first[fresh]] + place
                            yield pa.RecordBatch.from_arrays([pa.array(new.view(np.int64)), pa.array(texts[first])], names=["key", "text_id"])
                            seen = np.union1d(seen, new) if len(seen) < KEYS else new

    return dealt.select("seed", "ids", "text_id").mapInArrow(hold, "key long, text_id long")


def _all_named(docs: DataFrame, dealt: DataFrame, keys: DataFrame, longest: int) -> DataFrame:
    """(key, lang, words, a) of all keys (key, a).

    Nearly all frequent phrases stand in a small share of the texts. Those that do not are looked for in a larger one,
    the last in the stored numbers of all texts, which lead to one text for each of them.
    """
    spark, found = docs.sparkSession, []
    for share in SHARES:
        marks = spark.sparkContext.broadcast(_marks(keys).tobytes())
        if share > 1:
            some = docs.withColumn("at", F.pmod(F.monotonically_increasing_id(), F.lit(share))).where("at = 0")
        else:
            held = _holders(dealt, marks, longest).join(keys.select("key"), "key", "left_semi")
            held = stored(held.groupBy("key").agg(F.min("text_id").alias("text_id")).select("text_id").distinct(), "holders")
            some = docs.withColumn("text_id", _text_id()).join(held, "text_id", "left_semi")
        names = _named(some, marks, longest).dropDuplicates(["key"])
        found.append(stored(names.join(keys, "key"), "names"))
        marks.destroy()
        keys = stored(keys.join(found[-1], "key", "left_anti"), "unnamed")
        if not keys.limit(1).count():
            break
    return reduce(DataFrame.unionByName, found)


def _cuts(named: DataFrame, longest: int) -> DataFrame:
    """Every cut of every phrase: the keys of the first ``cut`` words and of the rest."""
    schema = "key long, lang string, phrase string, a long, k int, cut int, left long, right long, total long"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                words, seed = row["words"], lang_key(row["lang"])
                ids, phrase = word_ids(words), b" ".join(words).decode("utf-8", "replace")
                fore = [int(h[0]) for _, h, _ in _phrases(ids, np.full(len(ids), seed), longest)]
                for i in range(1, len(words)):
                    rest = list(_phrases(ids[i:], np.full(len(ids) - i, seed), longest))[-1][1][0]
                    keys = np.array([fore[i - 1], rest, seed], np.uint64).view(np.int64)
                    out.append((row["key"], row["lang"], phrase, row["a"], len(words), i, *keys.tolist()))
            names = ["key", "lang", "phrase", "a", "k", "cut", "left", "right", "total"]
            types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int32(), pa.int32(), *[pa.int64()] * 3]
            columns = zip(*out) if out else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    return named.select("key", "lang", "words", "a").mapInArrow(cut, schema)


def collocations(docs: DataFrame, longest: int = 5, least: int = 100, share: int = 100, top: int | None = 2000, shards: int = SHARDS) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of the phrases of 2 to ``longest`` words, best first in each language.

    A candidate has ``least`` or more occurrences (a) within pieces of text. Cut into two parts with l and r
    occurrences its score is floor(1000 * a * n / (l * r)), n being the words of its language; the lowest cut counts,
    of equals the shortest first part. Candidates within a longer one with at least ``share`` per cent of their
    occurrences are dropped. A null language is ``und``; null and empty texts have no words; repeated rows count again.
    Without candidates, or rows, the result is empty. ``top`` limits the report to the first rows of a language.
    """
    docs = docs.select("text", F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))
    dealt = stored(_streams(docs, shards), "streams", ("shard",))
    counts = frequent(dealt, longest, least, shards)
    longer = counts.where("k > 1").select("key", F.col("n").alias("a"))
    named = stored(_all_named(docs, dealt, longer, longest), "named")
    discard(dealt)
    cuts = stored(_cuts(named, longest), "cuts")

    number = lambda name, key: counts.select(F.col("key").alias(key), F.col("n").alias(name))
    whole = counts.where("k = 0").select(F.col("key").alias("total"), "n")
    scored = cuts.join(number("l", "left"), "left").join(number("r", "right"), "right").join(whole, "total")
    wide = lambda c: F.col(c).cast("decimal(18,0)")
    above, below = F.lit(1000).cast("decimal(4,0)") * wide("a") * F.col("n").cast("decimal(15,0)"), wide("l") * wide("r")
    scored = scored.withColumns({"above": above, "below": below}).withColumn("score", F.expr("above div below"))
    lowest = scored.groupBy("key", "lang", "phrase", "a", "n").agg(F.min(F.struct("score", "cut", "l", "r")).alias("low"))
    # a longer phrase around a candidate has one around it that is longer by one word, and no rarer
    around = cuts.where("k > 2 and cut = 1").select(F.col("right").alias("key"), "a")
    around = around.unionAll(cuts.where("k > 2 and cut = k - 1").select(F.col("left").alias("key"), "a"))
    around = around.groupBy("key").agg(F.max("a").alias("longer"))
    kept = lowest.join(around, "key", "left").where(f"longer is null or 100 * longer < {share} * a")
    best = Window.partitionBy("lang").orderBy(F.desc("low.score"), F.desc("a"), "phrase")
    out = kept.withColumn("rank", F.row_number().over(best).cast("long"))
    out = out if top is None else out.where(F.col("rank") <= top)
    return out.select("lang", "rank", "phrase", "a", "low.l", "low.r", "n", F.col("low.score").alias("score"))


def op13_dynamic_phrase_counting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


OP13_SQL = r"""
with pieces as (
  select coalesce(lang, 'und') as lang, unnest(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece from documents),
words as (select lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') as w from pieces),
starts as (select lang, w, unnest(range(1, len(w) + 1)) as i from words),
grams as (select lang, w, i, unnest(range(1, least(5, len(w) - i + 1) + 1)) as k from starts),
f as (select lang, array_to_string(w[i:i + k - 1], ' ') as phrase, k, count(*) as n from grams group by all having count(*) >= 100),
totals as (select lang, sum(len(w))::hugeint as n from words group by lang),
cuts as (
  select lang, phrase, k, n as a, string_split(phrase, ' ') as w, unnest(range(1, k)) as cut from f where k > 1),
parts as (select *, array_to_string(w[1:cut], ' ') as one, array_to_string(w[cut + 1:], ' ') as two from cuts),
scored as (
  select p.lang, p.phrase, p.a, x.n as l, y.n as r, t.n, (1000::hugeint * p.a * t.n) // (x.n::hugeint * y.n) as score, p.cut
  from parts p join f x on x.lang = p.lang and x.phrase = p.one join f y on y.lang = p.lang and y.phrase = p.two
  join totals t on t.lang = p.lang),
lowest as (select * from scored qualify row_number() over (partition by lang, phrase order by score, cut) = 1),
kept as (
  select * from lowest s where not exists (
    select 1 from f q where q.lang = s.lang and q.n >= s.a and length(q.phrase) > length(s.phrase)
      and contains(' ' || q.phrase || ' ', ' ' || s.phrase || ' ')))
select lang, rank, phrase, a, l, r, n::bigint as n, score::bigint as score from (
  select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept) where rank <= 2000
"""
