"""SentencePiece encoding and decoding, and sampled segmentations without replacement.

Pieces of a SentencePiece vocabulary span a lattice over every text; a path is a segmentation. Pieces are ranked, not
weighted, in a merge vocabulary, so a piece's log-probability is taken as -power * log(rank + shift), and bytes stand
in where no piece fits. The k segmentations with the highest Gumbel-perturbed log-probabilities are a sample without
replacement. They are found by A* search from the start of the lattice: a node stands for all paths that share its
prefix, its weight is exact by the sums over suffixes, and its perturbed value is the maximum of its paths. That maximum
belongs to one child, drawn by weight; the other children stay together as one node, whose maximum is a Gumbel below
it. Nodes leave the queue in the order of their values, so the first k complete paths are the sample. The noise is
seeded by the row's key alone.
"""

from __future__ import annotations

import heapq
import math
import random
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablewatch.llm.common import extended, quoted, table

VOCABULARY = "piece_bpe_32k.model"
SAMPLES = 3
#: Log-probability of a piece by its rank; bytes cost so much more than the last piece.
POWER, SHIFT, BYTE_COST = 0.7, 10.0, 4.0
#: Entries of a worker's cache of word lattices before it starts anew.
CACHE = 50_000
MARK = "▁"


class Pieces:
    """The vocabulary as log-probabilities by piece, and the lattices of words seen."""

    def __init__(self, path: str, power: float = POWER, shift: float = SHIFT):
        from sentencepiece import SentencePieceProcessor

        self.processor = p = SentencePieceProcessor(model_file=path)
        self.weight: dict[str, tuple[int, float]] = {}
        self.byte = [p.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        for i in range(p.get_piece_size()):
            if not (p.is_control(i) or p.is_unknown(i) or p.is_byte(i) or p.is_unused(i)):
                self.weight[p.id_to_piece(i)] = i, -power * math.log(i + shift)
        self.byte_weight = -power * math.log(p.get_piece_size() + shift) - BYTE_COST
        self.prefixes = {w[:n] for w in self.weight for n in range(1, len(w) + 1)}
        at = {i: bytes([b]) for b, i in enumerate(self.byte)}
        self.raw = [at.get(i) or p.id_to_piece(i).encode() for i in range(p.get_piece_size())]
        self.words: dict[str, list] = {}
        self.nodes: dict[str, tuple[float, list]] = {}

    def lattice(self, word: str) -> list:
        """Per place the steps (length, ids, log share, share, log of the others' share) by falling share."""
        known = self.words.get(word)
        if known:
            return known
        nodes, n = self.nodes, len(word)
        # what follows a place depends on the rest of the word alone, so words share the nodes of equal endings
        if len(nodes) >= 4 * CACHE:
            nodes.clear()
        sums, steps = [0.0] * (n + 1), [None] * n
        for i in range(n - 1, -1, -1):
            rest = word[i:]
            node = nodes.get(rest) if n - i <= 16 else None
            if node is None:
                node = self._node(rest, sums, i)
                if n - i <= 16:
                    nodes[rest] = node
            sums[i], steps[i] = node
        if len(self.words) >= CACHE:
            self.words.clear()
        if n <= 64:
            self.words[word] = steps
        return steps

    def _node(self, rest: str, sums: list[float], at: int) -> tuple[float, list]:
        weight, prefixes, out = self.weight, self.prefixes, []
        for n in range(1, len(rest) + 1):
            piece = rest[:n]
            if piece not in prefixes:
                break
            found = weight.get(piece)
            if found:
                out.append((found[1] + sums[at + n], n, (found[0],)))
        if not out or out[0][1] != 1:  # no piece for this character alone
            raw = rest[0].encode("utf-8", "surrogatepass")
            out.append((self.byte_weight * len(raw) + sums[at + 1], 1, tuple(self.byte[b] for b in raw)))
        if len(out) == 1:
            return out[0][0], [(1, out[0][2], 0.0, 1.0, -700.0)]
        out.sort(reverse=True)
        top = out[0][0]
        mass = [math.exp(x[0] - top) for x in out]
        whole = sum(mass)
        total = top + math.log(whole)
        return total, [(n, ids, w - total, m / whole, math.log(max(1e-300, (whole - m) / whole))) for (w, n, ids), m in zip(out, mass)]


def split(text: str) -> list[str]:
    """Words of the lattice: each space, written as a mark, begins a word; a leading mark stands for the text's start."""
    marked = MARK + text.replace(" ", MARK)
    cuts = [i for i, c in enumerate(marked) if c == MARK and i and marked[i - 1] != MARK]
    return [marked[a:b] for a, b in zip([0, *cuts], [*cuts, len(marked)])]


def sample(pieces: Pieces, text: str, k: int, seed: int) -> list[tuple[list[int], float, float]]:
    """Up to ``k`` distinct segmentations (ids, log-probability, perturbed log-probability), by falling perturbed value.

    An empty text has one segmentation, the empty one; a text with fewer than ``k`` segmentations gives them all.
    """
    if not text:
        return [([], 0.0, 0.0)]
    lattices = [pieces.lattice(w) for w in split(text)]
    draw, log = random.Random(seed).random, math.log
    # a node: minus its value, a number that settles ties, word, place, log-probability and ids so far, children taken
    number, done = 0, []
    queue = [(log(-log(draw() or 1e-300)), 0, 0, 0, 0.0, None, ())]
    while queue and len(done) < k:
        minus, _, at, place, total, chain, taken = heapq.heappop(queue)
        value, wanted = -minus, k - len(done) - 1
        queue = heapq.nsmallest(wanted, queue)
        worst = max(queue)[0] if queue else 0.0
        while at < len(lattices):
            steps = lattices[at]
            while place < len(steps):
                options = steps[place]
                if len(options) == 1:
                    n, ids = options[0][:2]
                    place += n
                    chain = (chain, ids)
                    continue
                best, r = 0, draw()
                if not taken:
                    while r > options[best][3] and best < len(options) - 1:
                        r -= options[best][3]
                        best += 1
                    n, ids, w, _, others = options[best]
                else:
                    free = [i for i in range(len(options)) if i not in taken]
                    r *= sum(options[i][3] for i in free)
                    for best in free:
                        r -= options[best][3]
                        if r <= 0:
                            break
                    n, ids, w = options[best][:3]
                    free.remove(best)
                    others = log(max(1e-300, sum(options[i][3] for i in free))) if free else -700.0
                if wanted and others > -690.0:
                    # the largest of the other children, below the node's own value
                    own = total + others - log(-log(draw() or 1e-300))
                    if len(queue) < wanted or -own < worst:
                        number += 1
                        heapq.heappush(queue, (_log_sum(-value, -own), number, at, place, total, chain, (*taken, best)))
                        if len(queue) > wanted:
                            queue = heapq.nsmallest(wanted, queue)
                        worst = max(queue)[0]
                total, chain, place, taken = total + w, (chain, ids), place + n, ()
            at, place = at + 1, 0
        done.append((_unrolled(chain), total, value))
    return done


def _log_sum(a: float, b: float) -> float:
    return max(a, b) + math.log1p(math.exp(-abs(a - b)))


def _unrolled(chain) -> list[int]:
    parts = []
    while chain:
        chain, ids = chain
        parts.append(ids)
    return [i for ids in reversed(parts) for i in ids]


def inclusion(samples: list[tuple[list[int], float, float]], k: int) -> list[float]:
    """Probability that each segmentation is in a sample whose threshold is the last perturbed value; 1 if all were found."""
    if len(samples) < k:
        return [1.0] * len(samples)
    threshold = samples[-1][2]
    return [-math.expm1(-math.exp(min(50.0, logp - threshold))) for _, logp, _ in samples]


_pieces: dict[str, Pieces] = {}


def vocabulary(path: str | None) -> Pieces:
    """This worker's vocabulary; without a path, the installed one."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(VOCABULARY)
    if path not in _pieces:
        _pieces[path] = Pieces(path)
    return _pieces[path]


def decode(pieces: Pieces, ids: list[int]) -> str:
    """The text of any segmentation: pieces and bytes joined, marks turned into spaces, the leading one dropped."""
    return b"".join(map(pieces.raw.__getitem__, ids)).decode("utf-8", "surrogatepass").replace(MARK, " ")[1:]


def encode_samples(rows: DataFrame, seed: Column, k: int = SAMPLES, path: str | None = None, text: str = "text") -> DataFrame:
    """Every row once for each of its sampled segmentations, with ``sample`` (from 1), ``ids``, ``log_prob``,
    ``inclusion`` and ``decoded``, which equals the text.

    The last of ``k`` segmentations sets the threshold of the inclusion probabilities. The seed is a number from the
    row's key, so a row gets the same segmentations in every run and partitioning. A null text is taken as empty.
    In a text that holds the mark of the vocabulary itself, it comes back as a space. Other columns are kept, whatever
    their names, but for those named like a result, which the result replaces.
    """
    made = "sample int, ids array<int>, log_prob double, inclusion double, decoded string"
    results = StructType.fromDDL(made).names
    names = [n for n in rows.columns if n.lower() not in results]
    kept = rows.select(*quoted(names)).schema

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = vocabulary(path)
        for whole in batches:
            for lo in range(0, max(1, whole.num_rows), 1000):
                batch = whole.slice(lo, 1000)
                at, out = [], []
                for i, (value, number) in enumerate(zip(batch.column(names.index(text)), batch.column(len(names)))):
                    found = sample(pieces, value.as_py() or "", k, number.as_py())
                    for n, ((ids, logp, _), share) in enumerate(zip(found, inclusion(found, k))):
                        at.append(i)
                        out.append((n + 1, ids, logp, share, decode(pieces, ids)))
                others = [c.take(pa.array(at, pa.int64())) for c in batch.columns[: len(names)]]
                types = [pa.int32(), pa.list_(pa.int32()), pa.float64(), pa.float64(), pa.string()]
                cols = [pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 5, types)]
                yield pa.RecordBatch.from_arrays([*others, *cols], names=[*names, *results])

    numbered = rows.select(*(c.alias(f"c{i}") for i, c in enumerate([*quoted(names), seed])))
    return numbered.mapInArrow(draw, extended(kept, made))


def op2_gumbel_segmentations(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "text")
    found = encode_samples(turns, F.xxhash64("conv_id", "turn"))
    return found.select("conv_id", "turn", "sample", F.size("ids").alias("n_ids"), "ids", "log_prob", "inclusion", (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"))
