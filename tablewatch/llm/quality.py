"""Quality by weak labels: overlapping heuristics vote, their accuracies are estimated, and a hashed linear scorer follows.

Each heuristic calls a whole text good, bad, or abstains. Expectation-maximisation over the counted vote patterns
(at most 3 to the number of heuristics, whatever the corpus) estimates how often each one is right, and with
that the probability that a pattern belongs to a good text. These posteriors of a bounded sample are
the targets of a logistic scorer over hashed byte trigrams, which then scores every text. No given label is read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewatch.llm.common import extended, sample_order, table
from tablewatch.llm.words import word_ids

#: Bound of the training sample of the scorer, whole texts.
SAMPLE = 5000
BITS, EPOCHS, RATE = 15, 6, 0.5
#: Weight of the prior on the heuristics' votes, as a share of the texts.
PRIOR = 0.2
#: Kinds of bytes: white space, upper and lower case, digits and bytes of other letters, marks, controls.
_SPACE, _UPPER, _LOWER, _OTHER, _MARK, _CONTROL = range(6)
_KIND = np.full(256, _CONTROL, np.uint8)
_KIND[[*range(9, 14), 32]] = _SPACE
_KIND[33:127] = _MARK
_KIND[65:91], _KIND[97:123] = _UPPER, _LOWER
_KIND[[*range(48, 58), *range(128, 256)]] = _OTHER
_CLOSING = b"\"')\t\r\x0b\x0c "

GOOD, BAD, NONE = 2, 1, 0


def _vote(value: float, good: float, bad: float) -> int:
    """Good up to the one bound, bad from the other, else no vote."""
    return GOOD if value <= good else BAD if value >= bad else NONE


def votes(text: str | None) -> list[int]:
    """One vote for each heuristic; a text without words is called bad by the first and gets no other vote."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    if n == 0:
        return [BAD] + [NONE] * (len(HEURISTICS) - 1)
    ids = word_ids(words)
    kind = np.empty(len(raw) + 2, np.uint8)
    kind[0] = kind[-1] = _SPACE
    kind[1:-1] = _KIND[np.frombuffer(raw, np.uint8)]
    of = np.bincount(kind[1:-1], minlength=6)
    mark, space = kind == _MARK, kind == _SPACE
    in_a_row = np.count_nonzero(mark[1:-1] & mark[2:] & ~mark[:-2])
    lone = np.count_nonzero(mark[1:-1] & space[2:] & space[:-2])
    lines = [x for x in raw.split(b"\n") if x.strip()]
    defect = lambda value, bad: _vote(value, -1.0, bad)  # noqa: E731  its absence is no sign of quality
    return [
        _vote(-n, -20, -2),
        defect((of[_MARK] + of[_CONTROL]) / len(raw), 0.12),
        defect(of[_UPPER] / max(1, of[_UPPER] + of[_LOWER]), 0.3),
        defect(in_a_row / n, 0.1),
        defect(lone / n, 0.1),
        defect(float((ids[1:] == ids[:-1]).mean()) if n > 1 else 0.0, 0.15),
        _vote(1 - len(np.unique(ids)) / n if n >= 30 else 0.5, 0.45, 0.7),
        defect(1 - len(set(lines)) / len(lines), 0.3),
        _vote(abs((len(raw) - of[_SPACE]) / n - 6), 3, 6),
        _vote(1 - sum(x.rstrip(_CLOSING).endswith((b".", b"!", b"?")) for x in lines) / len(lines), 0.3, 0.8),
    ]


HEURISTICS = ["words", "symbols", "capitals", "marks_in_a_row", "wordless", "words_in_a_row", "few_different_words", "equal_lines", "word_length", "line_ends"]


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200) -> tuple[float, np.ndarray]:
    """(share of good texts, P(vote | class) as [heuristic, class, vote]) by expectation-maximisation.

    It starts from calling bad whatever any heuristic calls bad. A prior worth ``PRIOR`` of the texts says that a vote
    is nine times as likely to be right as wrong, so that the classes keep their meaning.
    """
    one = np.eye(3)[patterns]  # pattern, heuristic, vote
    total = counts.sum()
    cast = (one * counts[:, None, None]).sum(axis=0) / total
    prior = np.repeat(cast[:, None, :], 2, axis=1)
    prior[:, 0, GOOD] /= 3
    prior[:, 0, BAD] *= 3
    prior[:, 1, BAD] /= 3
    good = np.where((patterns == BAD).any(axis=1), 0.1, 0.95)
    share, rates = 0.5, prior
    for _ in range(rounds):
        weight = np.stack([counts * (1 - good), counts * good])
        new = np.einsum("yp,pmv->myv", weight, one) + PRIOR * prior * weight.sum(axis=1)[None, :, None] + 1e-6 * total
        new /= new.sum(axis=2, keepdims=True)
        share = float(np.clip(weight[1].sum() / total, 0.01, 0.99))
        done = np.abs(new - rates).max() < 1e-7
        rates = new
        good = posterior(patterns, share, rates)
        if done:
            break
    return share, rates


def posterior(patterns: np.ndarray, share: float, rates: np.ndarray) -> np.ndarray:
    """Probability of a good text for each row of votes."""
    logs = np.log(np.maximum(rates, 1e-9))
    at = np.arange(patterns.shape[1])
    bad, good = (logs[at, y, patterns].sum(axis=1) for y in (0, 1))
    return 1 / (1 + np.exp(np.clip(bad - good + np.log((1 - share) / share), -50, 50)))


def trigram_counts(text: str | None) -> np.ndarray:
    """Hashed byte trigrams of a text with its ends, as a vector of length one."""
    raw = np.frombuffer(b"\n" + (text or "").encode("utf-8", "surrogatepass") + b"\n\n", np.uint8).astype(np.uint32)
    slot = (raw[:-2] * np.uint32(2654435761) ^ raw[1:-1] * np.uint32(2246822519) ^ raw[2:] * np.uint32(3266489917)) * np.uint32(668265263)
    counts = np.bincount(slot >> np.uint32(32 - BITS), minlength=1 << BITS).astype(np.float32)
    return counts / np.sqrt(np.dot(counts, counts))


def fit_scorer(texts: list[str | None], targets: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and bias of the logistic scorer, by adaptive steps over the texts in turn."""
    weights, bias = np.zeros(1 << BITS, np.float32), 0.0
    seen, seen_bias = np.full(1 << BITS, 1e-3, np.float32), 1e-3
    rows = []
    for text in texts:
        x = trigram_counts(text)
        at = np.flatnonzero(x)
        rows.append((at, x[at]))
    for _ in range(EPOCHS):
        for (at, x), y in zip(rows, targets):
            error = 1 / (1 + np.exp(-np.clip(weights[at] @ x + bias, -30, 30))) - y
            g = error * x
            seen[at] += g * g
            seen_bias += error * error
            weights[at] -= RATE * g / np.sqrt(seen[at])
            bias -= RATE * error / np.sqrt(seen_bias)
    return weights, float(bias)


def voted(docs: DataFrame) -> DataFrame:
    """Adds ``votes``, the votes as digits of one number to base three, in the order of ``HEURISTICS``."""
    docs = docs.drop("votes")
    names = docs.columns
    place = 3 ** np.arange(len(HEURISTICS))

    def cast(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = [int(np.dot(votes(t.as_py()), place)) for t in batch.column(names.index("text"))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(codes, pa.int64())], names=[*names, "votes"])

    return docs.mapInArrow(cast, extended(docs.schema, "votes long"))


def _digits(codes: np.ndarray) -> np.ndarray:
    return codes[:, None] // 3 ** np.arange(len(HEURISTICS)) % 3


class Model:
    """Share of good texts, vote rates of each heuristic by class, and the scorer."""

    def __init__(self, share: float, rates: np.ndarray, weights: np.ndarray, bias: float):
        self.share, self.rates, self.weights, self.bias = share, rates, weights, bias

    def accuracies(self) -> dict[str, float]:
        """How often each heuristic's votes are estimated to be right."""
        mass = np.array([1 - self.share, self.share])
        right = mass[0] * self.rates[:, 0, BAD] + mass[1] * self.rates[:, 1, GOOD]
        return dict(zip(HEURISTICS, (right / np.einsum("y,myv->m", mass, self.rates[:, :, 1:])).tolist()))


def learn(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """The label model of the votes on all documents, and the scorer fitted on at most ``sample`` whole texts by hash."""
    # at most 3 to the number of heuristics rows
    found = voted(docs.select("text")).groupBy("votes").count().orderBy("votes").collect()
    if not found:
        return Model(0.5, np.full((len(HEURISTICS), 2, 3), 1 / 3), np.zeros(1 << BITS, np.float32), 0.0)
    codes, counts = np.array([r.votes for r in found]), np.array([r["count"] for r in found], np.float64)
    share, rates = estimate(_digits(codes), counts)
    part = int(min(1.0, 1.2 * sample / counts.sum() + 0.0001) * (1 << 20))
    order = F.xxhash64(sample_order(), "text")
    few = docs.select("doc_id", "text").where(F.pmod(order, F.lit(1 << 20)) <= part).orderBy(order).limit(sample)
    texts = few.toArrow()["text"].to_pylist()
    targets = posterior(np.array([votes(t) for t in texts]).reshape(-1, len(HEURISTICS)), share, rates)
    return Model(share, rates, *fit_scorer(texts, targets))


def judge(docs: DataFrame, model: Model) -> DataFrame:
    """Adds ``weak_label`` (posterior of the votes), ``score`` (of the scorer, 0 to 1) and ``predicted`` (1: good, from 0.5)."""
    docs = docs.drop("weak_label", "score", "predicted")
    names = docs.columns
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of a fixed size

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            cast, raw = [], []
            for t in batch.column(names.index("text")):
                text = t.as_py()
                cast.append(votes(text))
                raw.append(float(m.weights @ trigram_counts(text)) + m.bias)
            score = 1 / (1 + np.exp(-np.clip(np.array(raw), -30, 30)))
            weak = posterior(np.array(cast).reshape(-1, len(HEURISTICS)), m.share, m.rates)
            out = [*batch.columns, pa.array(weak, pa.float64()), pa.array(score, pa.float64()), pa.array((score >= 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(out, names=[*names, "weak_label", "score", "predicted"])

    return docs.mapInArrow(rate, extended(docs.schema, "weak_label double, score double, predicted int"))


def op3_weak_label_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = judge(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), learn(docs))
    return found.select("doc_id", "weak_label", "score", "predicted")
