"""Toxicity by a support vector machine with a gapped subsequence string kernel and Nystroem landmarks.

Strings are the words of a sentence, lower-case letters and digits only, with their ends marked. The kernel of two
strings counts the subsequences of three characters that they share within a span of five, each gap discounted, so a
word with a character dropped in, doubled or replaced stays close to itself. Letters written apart are read as a word.
What stands between blanks is read as one word and by its parts between other signs; a long word by all its windows.
Landmarks are words of the training documents; a string is mapped to its kernel values with them, whitened by the
kernel of the landmarks, and a linear machine is fitted there. Since the kernel is a product of explicit counts, the
fitted machine folds into one weight for each subsequence, and scoring needs no landmark any more.

A sentence is as toxic as its worst word, a document as its worst sentence. Labels are given by document: the fit
alternates between picking the worst sentence of every labelled document and training on those.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tablewatch.llm.common import extended, held_out, sample_order, table
from tablewatch.llm.words import mix

#: Bounds of the training sample: so many documents of each label, whole texts.
SAMPLE = {1: 2500, 0: 4000}
LANDMARKS, ROUNDS = 160, 3
#: Places of the second and third character after the first, and the discount of a skipped place.
OFFSETS = [(a, b) for b in range(2, 5) for a in range(1, b)]
DECAY = 0.6
TABLE_BITS = 21
#: Share of toxic documents among those with a word, from which it may be toxic, and its least score at first.
PURITY, EVIDENCE = 0.5, 3.0
#: Weight of all toxic words against all clean ones in the fit.
WEIGHT = 0.2
#: Words of more letters are scored by windows of ``SPAN`` letters, one at every ``STEP``: any run of SPAN - STEP + 1
#: letters lies whole in one of them.
LONG, SPAN, STEP = 32, 12, 2
#: Bounds of the distinct words taken as background, and of a worker's cache of scored words.
BACKGROUND, CACHE = 20_000, 400_000

_apart = re.compile(r"(?<![^\W_])(?:[^\W_][\W_]{1,2}){3,}[^\W_](?![^\W_])")
_letters = re.compile(r"[^\W_]+")
_P = [np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)]


def _joined(match: re.Match) -> str:
    return " " + "".join(c for c in match.group() if c.isalnum()) + " "


def tokens(text: str | None) -> list[str]:
    """Words of a text as written, lower-case, with letters written apart joined."""
    return _apart.sub(_joined, (text or "").lower()).split()


def plain(token: str) -> str:
    return token if token.isalnum() else "".join(c for c in token if c.isalnum())


def units(token: str) -> Iterator[str]:
    """The words by which a token is judged: its letters together and those between its other signs; windows of long ones."""
    whole = plain(token)
    for word in (whole,) if len(whole) == len(token) else (whole, *_letters.findall(token)):
        if len(word) <= LONG:
            yield word
        else:
            yield from (word[lo : lo + SPAN] for lo in range(0, len(word) - SPAN + STEP, STEP))


def subsequences(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, subsequence, weight) of all gapped subsequences; every word's weights have length one."""
    marked = [f"\x02{w}\x03" for w in words]
    points = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    of = np.repeat(np.arange(len(words)), [len(w) for w in marked])
    parts = []
    for a, b in OFFSETS:
        n = len(points) - b
        if n <= 0:
            continue
        at = np.flatnonzero(of[:n] == of[b:])
        name = mix(points[at] * _P[0] + points[at + a] * _P[1] + points[at + b] * _P[2])
        parts.append((of[at], name, np.full(len(at), DECAY ** (b - 2))))
    if not parts:
        return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0)
    word, name, weight = (np.concatenate(x) for x in zip(*parts))
    norm = np.sqrt(np.bincount(word, weight**2, len(words)))
    return word, name, weight / norm[word]


def _slot(names: np.ndarray) -> np.ndarray:
    return (names >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


class Machine:
    """Weight of each subsequence (by hash), bias, and the two numbers that turn a margin into a probability."""

    def __init__(self, weights: np.ndarray, bias: float, slope: float = 1.0, base: float = 0.0):
        self.weights, self.bias, self.slope, self.base = weights, bias, slope, base
        self.known: dict[str, float] = {}

    def margins(self, words: list[str]) -> np.ndarray:
        word, name, weight = subsequences(words)
        return np.bincount(word, weight * self.weights[_slot(name)], len(words)) + self.bias

    def worst(self, texts: list[str | None]) -> np.ndarray:
        """The margin of each text's worst word; without words, that of the empty word."""
        split = [tokens(t) for t in texts]
        if len(self.known) > CACHE:
            self.known.clear()
        new = list({t for ts in split for t in ts if t not in self.known} | ({""} - self.known.keys()))
        found = np.full(len(new), -np.inf)
        every = ((i, word) for i, t in enumerate(new) for word in units(t))
        while part := list(islice(every, 20_000)):
            np.maximum.at(found, [i for i, _ in part], self.margins([word for _, word in part]))
        self.known.update(zip(new, found.tolist()))
        known = self.known
        return np.array([max(map(known.__getitem__, ts), default=known[""]) for ts in split])

    def probability(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.base, -30, 30)))


def _kernel(words: list[str], names: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Kernel values of words (rows) with the landmarks, given by their subsequences ``names`` and ``values``."""
    out = []
    for lo in range(0, len(words), 2000):
        word, name, weight = subsequences(words[lo : lo + 2000])
        at = np.minimum(np.searchsorted(names, name), len(names) - 1)
        hit = names[at] == name
        k = np.zeros((len(words[lo : lo + 2000]), values.shape[1]))
        word, at, weight = word[hit], at[hit], weight[hit]
        order = np.argsort(word, kind="stable")
        if len(order):
            word, rows = word[order], values[at[order]] * weight[order][:, None]
            starts = np.flatnonzero(np.diff(word, prepend=-1))
            k[word[starts]] = np.add.reduceat(rows, starts, axis=0)
        out.append(k)
    return np.concatenate(out)


def _fit_linear(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Squared-hinge machine by Newton steps on the examples inside the margin; the last weight is the bias."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(15):
        inside = y * (x @ w) < 1
        xs = x[inside] * weight[inside][:, None]
        new = np.linalg.solve(xs.T @ x[inside] + np.diag(penalty), xs.T @ y[inside])
        done = np.abs(new - w).max() < 1e-6
        w = new
        if done:
            break
    return w


def _by_hash(words: list[str]) -> list[str]:
    return sorted(words, key=lambda w: (zlib.crc32(w.encode("utf-8", "surrogatepass")), w))


def _calibrated(machine: Machine, margin: np.ndarray, y: np.ndarray) -> Machine:
    """Logistic regression of the labels on the documents' margins."""
    a, b = 1.0, 0.0
    x = np.stack([margin, np.ones(len(margin))], axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ [a, b], -30, 30)))
        h = x.T @ (x * (p * (1 - p))[:, None]) + 1e-3 * np.eye(2)
        step = np.linalg.solve(h, x.T @ (y - p) - 1e-3 * np.array([a, b]))
        a, b = a + step[0], b + step[1]
        if np.abs(step).max() < 1e-8:
            break
    machine.slope, machine.base = max(a, 1e-3), b
    return machine


def fit(texts: list[str | None], toxic: list[int], landmarks: int = LANDMARKS, rounds: int = ROUNDS) -> Machine:
    """The machine trained on labelled documents, given in a fixed order.

    Without both labels nothing can be told apart: all scores are then the share of toxic documents.
    """
    y = np.asarray(toxic)
    blank = Machine(np.zeros(1 << TABLE_BITS), 0.0)
    if not len(y) or y.min() == y.max():
        blank.slope, blank.base = 0.0, (0.0 if not len(y) else -5.0 if y.max() == 0 else 5.0)
        return blank
    number: dict[str, int] = {}
    docs = [np.array(sorted({number.setdefault(p, len(number)) for t in tokens(x) for p in units(t) if p}), np.int64) for x in texts]
    words = list(number)
    if not words:
        return _calibrated(blank, np.zeros(len(y)), y)
    pos = np.bincount(np.concatenate([d for d, t in zip(docs, y) if t]), minlength=len(words))
    neg = np.bincount(np.concatenate([d for d, t in zip(docs, y) if not t]), minlength=len(words))
    p, n = y.sum(), (1 - y).sum()
    rate = (pos + neg) / (p + n)
    score = (pos / p - neg / n) / np.sqrt(np.maximum(rate * (1 - rate), 1e-9) * (1 / p + 1 / n))
    # a toxic word is found mostly in toxic documents; what is merely frequent there is not
    pure = (pos + p / (p + n)) / (pos + neg + 1) >= PURITY
    marked = [i for i in np.argsort(-np.where(pure, score, -1), kind="stable")[: landmarks * 3 // 4] if pure[i] and pos[i]]
    clean = _by_hash([words[i] for i in np.flatnonzero(neg)])
    common = [words[i] for i in np.argsort(-neg, kind="stable")[: landmarks // 8] if neg[i]]
    chosen = list(dict.fromkeys([words[i] for i in marked] + common + clean[: landmarks - len(marked) - len(common)]))

    word, name, weight = subsequences(chosen)
    names, at = np.unique(name, return_inverse=True)
    values = np.zeros((len(names), len(chosen)))
    np.add.at(values, (at, word), weight)
    eigen, vectors = np.linalg.eigh(_kernel(chosen, names, values))
    white = vectors / np.sqrt(np.maximum(eigen, 1e-3))  # maps kernel values to Nystroem features

    often = [words[i] for i in np.argsort(-neg, kind="stable")[: BACKGROUND // 4] if neg[i]]
    background = [w for w in dict.fromkeys([*often, *clean[:BACKGROUND]]) if not pure[number[w]]]
    background = [number[w] for w in background]
    margin, machine, hard = score, blank, Counter()
    for _ in range(rounds):
        worst = [int(d[np.argmax(margin[d])]) if len(d) else -1 for d in docs]
        likely = [int(d[np.argmax(np.where(pure[d], margin[d], -np.inf))]) if len(d) else -1 for d in docs]
        bad = Counter(w for w, t in zip(likely, y) if t and w >= 0 and pure[w] and (margin[w] > -0.5 if machine is not blank else score[w] >= EVIDENCE))
        hard.update(w for w, t in zip(worst, y) if not t and w >= 0 and not pure[w] and margin[w] > -1)
        below = [w for w in dict.fromkeys([*background, *sorted(hard)]) if w not in bad]
        if not bad:
            break
        examples = [words[w] for w in [*bad, *below]]
        label = np.array([1.0] * len(bad) + [-1.0] * len(below))
        # a clean word weighs as often as it is met or has misled; the toxic ones together weigh a fixed share of that
        times = np.array([float(c) ** 0.5 for c in bad.values()] + [float(neg[w]) ** 0.5 + hard[w] for w in below])
        times[: len(bad)] *= WEIGHT * times[len(bad) :].sum() / times[: len(bad)].sum()
        w = _fit_linear(_kernel(examples, names, values) @ white, label, times)
        machine = Machine(np.zeros(1 << TABLE_BITS), float(w[-1]))
        np.add.at(machine.weights, _slot(names), values @ (white @ w[:-1]))
        margin = np.concatenate([machine.margins(words[lo : lo + 20_000]) for lo in range(0, len(words), 20_000)])
    empty = machine.margins([""])[0]
    return _calibrated(machine, np.array([max(margin[d].max(), empty) if len(d) else empty for d in docs]), y)


def learn(docs: DataFrame, labels: DataFrame, sample: dict[int, int] | None = None) -> Machine:
    """The machine learned from documents that are labelled and not held out.

    It is fitted on at most ``sample`` whole documents of each label, chosen by a hash of their id. Rows without an
    id, text or label teach nothing; a document labelled both ways counts as toxic.
    """
    sample = sample or SAMPLE
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    counts = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    if not counts:
        return fit([], [])
    # first a share by hash, so that the window that sets the exact bound sees few rows
    part = F.create_map(*(F.lit(x) for t, n in counts.items() for x in (t, min(1.0, 1.2 * sample[t] / n + 0.0001))))
    few = known.where(F.pmod(sample_order(), F.lit(1 << 20)) <= part[F.col("toxic")] * (1 << 20))
    bound = F.when(F.col("toxic") == 1, sample[1]).otherwise(sample[0])
    few = few.withColumn("n", F.row_number().over(Window.partitionBy("toxic").orderBy(sample_order(), "doc_id"))).where(F.col("n") <= bound)
    # the sample bounds the broadcast
    rows = docs.where(F.col("text").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = rows.join(F.broadcast(few.select("doc_id", "toxic")), "doc_id").toArrow()
    ordered = sorted(zip(rows["doc_id"].to_pylist(), rows["text"].to_pylist(), rows["toxic"].to_pylist()))
    return fit([r[1] for r in ordered], [r[2] for r in ordered])


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """Adds ``score`` (0 to 1) and ``predicted`` (1 from 0.5) to the documents; null and empty texts have a score too."""
    docs = docs.drop("score", "predicted")
    names = docs.columns
    shared = docs.sparkSession.sparkContext.broadcast(machine)  # of a fixed size

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = shared.value
        for whole in batches:
            for lo in range(0, max(1, whole.num_rows), 500):
                batch = whole.slice(lo, 500)
                found = machine.probability(machine.worst(batch.column(names.index("text")).to_pylist()))
                out = [*batch.columns, pa.array(found, pa.float64()), pa.array((found >= 0.5).astype(np.int32))]
                yield pa.RecordBatch.from_arrays(out, names=[*names, "score", "predicted"])

    return docs.mapInArrow(judge, extended(docs.schema, "score double, predicted int"))


def op4_subsequence_kernel_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    machine = learn(docs, table(spark, sf_dir, "labels"))
    found = score(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), machine)
    return found.select("doc_id", held_out().alias("held_out"), "score", "predicted")
