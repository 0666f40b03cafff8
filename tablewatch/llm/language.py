"""Language identification by bit-sliced Bloom filters of letter trigrams.

A slot of the filter holds one bit per language, so one look-up of a trigram returns the mask of all languages that
contain it. The counts of set bits per language over a text, less the hits that chance alone would give, decide.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tablewatch.llm.common import extended, held_out, sample_order, table, unwrapped, wrapped
from tablewatch.llm.words import mix

#: Bound of the training sample: so many documents of each language, whole texts.
SAMPLE = 2000
SLOTS, HASHES = 1 << 20, 3
#: A language contains a trigram that is in so many of its documents, and in a tenth of the share of any other language's.
LEAST_DOCS, LEAST_SHARE = 3, 0.1
UNDETERMINED = "und"
_SHIFT = [np.uint64(x) for x in (0, 21, 42)]
_letters: np.ndarray | None = None


def _is_letter() -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)
    return _letters


def trigrams(text: str | None) -> np.ndarray:
    """64-bit names of the lower-case letter trigrams of a text, one around every letter; other characters are gaps."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), "<u4")
    letter = _is_letter()[points]
    padded = np.zeros(len(points) + 2, np.uint64)
    padded[1:-1] = np.where(letter, points, 0)
    names = padded[:-2] | padded[1:-1] << _SHIFT[1] | padded[2:] << _SHIFT[2]
    return mix(names[letter])


def _slots(names: np.ndarray, slots: int, hashes: int) -> list[np.ndarray]:
    low, high = names & np.uint64(0xFFFFFFFF), (names >> np.uint64(32)) | np.uint64(1)
    return [((low + np.uint64(i) * high) % np.uint64(slots)).astype(np.int64) for i in range(hashes)]


class Filter:
    """The languages, the bit-sliced filter (slots x bytes of mask), and each language's rate of chance hits."""

    def __init__(self, languages: list[str], grams: list[np.ndarray], slots: int = SLOTS, hashes: int = HASHES):
        self.languages, self.hashes = languages, hashes
        self.bits = np.zeros((slots, max(1, -(-len(languages) // 8))), np.uint8)
        for i, names in enumerate(grams):
            for at in _slots(names, slots, hashes):
                self.bits[at, i // 8] |= np.uint8(1 << i % 8)
        filled = np.array([((self.bits[:, i // 8] >> (i % 8)) & 1).mean() for i in range(len(languages))])
        self.chance = filled**hashes

    def predict(self, text: str | None) -> tuple[str, float]:
        names = trigrams(text)
        if not len(names) or not self.languages:
            return UNDETERMINED, 0.0
        masks = None
        for at in _slots(names, len(self.bits), self.hashes):
            masks = self.bits[at] if masks is None else masks & self.bits[at]
        hits = np.unpackbits(masks, axis=1, bitorder="little")[:, : len(self.languages)].sum(axis=0, dtype=np.int64)
        share = (hits / len(names) - self.chance) / np.maximum(1 - self.chance, 1e-9)
        best = int(np.argmax(share))
        return self.languages[best], float(np.clip(share[best], 0, 1))


def learn(docs: DataFrame, sample: int = SAMPLE, slots: int = SLOTS, hashes: int = HASHES) -> Filter:
    """The filter learned from ``text`` and ``lang`` of documents that are not held out.

    It is fitted on at most ``sample`` whole documents of each language, chosen by a hash of their id. Rows whose text
    or lang is null teach nothing; without any other row the filter knows no language. Ties of the decision go to the
    language that comes first in the alphabet.
    """
    rows = docs.where(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text", "doc_id")
    counts = {r.lang: r["count"] for r in rows.groupBy("lang").count().collect()}
    languages = sorted(counts)
    if not languages:
        return Filter([], [], slots, hashes)
    # first a share by hash, so that the window that sets the exact bound sees few rows
    part = F.create_map(*(F.lit(x) for lang in languages for x in (lang, min(1.0, 1.2 * sample / counts[lang] + 0.0001))))
    few = rows.where(F.pmod(sample_order(), F.lit(1 << 20)) <= part[F.col("lang")] * (1 << 20))
    few = few.withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy(sample_order(), F.xxhash64("text")))).where(F.col("n") <= sample)
    number = {lang: i for i, lang in enumerate(languages)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of: dict[int, list[np.ndarray]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                of.setdefault(number[lang], []).append(np.unique(trigrams(text.as_py())))
            for i, found in of.items():
                names, docs_of = np.unique(np.concatenate(found), return_counts=True)
                lang = np.full(len(names), i, np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(lang), pa.array(names.view(np.int64)), pa.array(docs_of)], names=["lang", "gram", "n"])

    grams = few.select("lang", "text").mapInArrow(count, "lang int, gram long, n long")
    grams = grams.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    size = F.create_map(*(F.lit(x) for i, lang in enumerate(languages) for x in (i, float(min(sample, counts[lang])))))
    share = F.col("n") / size[F.col("lang")]
    least = F.when(size[F.col("lang")] < 100, 1).otherwise(LEAST_DOCS)
    most = F.max(share).over(Window.partitionBy("gram"))  # one row a language
    kept = grams.withColumn("most", most).where((F.col("n") >= least) & (share >= LEAST_SHARE * F.col("most")))
    found = kept.select("lang", "gram").toPandas()
    by = [found.gram.to_numpy(np.int64)[found.lang.to_numpy() == i].view(np.uint64) for i in range(len(languages))]
    return Filter(languages, by, slots, hashes)


def identify(docs: DataFrame, model: Filter) -> DataFrame:
    """Adds ``lang_pred`` and ``score`` to the documents; ``und`` and 0 where the text is null or has no letter."""
    docs = docs.drop("lang_pred", "score")
    names = docs.columns
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of a size fixed by its parameters

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = shared.value
        for batch in batches:
            found = [judge.predict(t.as_py()) for t in batch.column(names.index("text"))]
            out = [*batch.columns, pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())]
            yield pa.RecordBatch.from_arrays(out, names=[*names, "lang_pred", "score"])

    return docs.mapInArrow(predict, extended(docs.schema, "lang_pred string, score double"))


def accepted(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """The documents in a learned language: rejected are those that are undetermined, or whose trigrams are mostly in none."""
    known = identify(wrapped(docs), learn(docs))
    return unwrapped(known.where((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= least)), docs)


def op7_language_bitmask_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = identify(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), learn(docs))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
