"""Line, near-duplicate and substring dedup against brute force, and their edge cases."""

import hashlib
import itertools
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from conftest_texts import word_lists
from tablewatch.llm import minhash
from tablewatch.llm.common import stored
from tablewatch.llm.lines import cut_lines, without_repeated_lines
from tablewatch.llm.minhash import keep_first, least_agreeing, near_duplicates
from tablewatch.llm.recompression import _chunks, _expanded, _ranges, repeat_digest, symbols, without_repeats
from tablewatch.llm.words import mix, word_ids


def brute_lines(texts, least):
    """Kept text per document; texts in document order."""
    filled = [[(p, x) for p, x in enumerate((t or "").split("\n")) if x.strip(" \t\n\x0b\x0c\r")] for t in texts]
    seen, out = set(), []
    for t, lines in zip(texts, filled):
        gone = set()
        for i in range(len(lines) - least + 1):
            run = tuple(x for _, x in lines[i : i + least])
            if run in seen:
                gone.update(p for p, _ in lines[i : i + least])
            seen.add(run)
        out.append("\n".join(x for p, x in enumerate((t or "").split("\n")) if p not in gone))
    return out


@pytest.mark.parametrize("least", [1, 2, 3, 5, 8])
def test_line_runs_match_brute_force(spark, least):
    rng = np.random.default_rng(least)
    texts = ["\n".join(rng.choice(["a", "b", "c", "", " "], rng.integers(1, 30))) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.kept_text for r in cut_lines(df, least).collect()}
    assert [got[i] for i in range(len(texts))] == brute_lines(texts, least)


def test_line_dedup_edges(edge, none):
    rows = cut_lines(edge).collect()
    assert len(rows) == edge.count()
    by = {r.doc_id: r for r in rows if r.doc_id != 1}
    assert by[2].kept_text is None and by[2].n_removed == 0
    assert by[7].n_removed == 0 and by[8].n_removed == 4
    assert by[8].kept_text == "zero\n"
    kept = without_repeated_lines(edge)
    assert kept.columns == edge.columns
    assert kept.where("row <> 'mine' or score <> 'mine'").count() == 0
    assert cut_lines(none).count() == without_repeated_lines(none).count() == 0


def brute_components(texts, k, percent):
    sets = []
    for t in texts:
        w = (t or "").encode().lower().split()
        n = min(k, len(w))
        sets.append(frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if w else frozenset())
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(range(len(texts)), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * len(sets[a] | sets[b]):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(texts))], [len(s) for s in sets]


@pytest.mark.parametrize("side", [256, 4])
def test_near_duplicates_match_brute_force(spark, monkeypatch, side):
    """Copies of copies: chains whose ends are not linked, stars, and far members of a group; buckets joined or in blocks."""
    monkeypatch.setattr(minhash, "SIDE", side)
    rng = np.random.default_rng(3)
    texts = []
    for g in range(12):
        base = [f"g{g}w{i}" for i in range(60)]
        for _ in range(25):
            copy = list(base)
            for at in rng.choice(60, rng.integers(0, 7), replace=False):
                copy[at] = f"x{rng.integers(1e9)}"
            texts.append(" ".join(copy))
            if rng.random() < 0.3:
                base = copy
    texts += ["", None, "One", "one", "two words", "TWO words"]
    order = rng.permutation(len(texts))
    texts = [texts[i] for i in order]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: r for r in near_duplicates(df, k=2).collect()}
    roots, sizes = brute_components(texts, 2, 80)
    assert [got[i].component_id for i in range(len(texts))] == roots
    assert [got[i].n_shingles for i in range(len(texts))] == sizes
    assert all(got[i].kept == (roots[i] == i) for i in range(len(texts)))


def test_copies_that_are_not_linked_make_no_row_for_each_pair(spark, monkeypatch):
    """Copies of one text share buckets and agree in most coordinates, though hardly any two are linked: most pairs are
    compared without being stored as rows, and no link is lost."""
    copies, made = 160, {}

    def counted(df, label, *by):
        out = stored(df, label, *by)
        made[label] = made.get(label, 0) + out.count()
        return out

    monkeypatch.setattr(minhash, "stored", counted)
    rng = np.random.default_rng(copies)
    base = [f"w{i}" for i in range(200)]
    texts = []
    for g in range(copies):
        # one in ten is a near copy of the one before
        copy = list(copy if g % 10 == 9 else base)
        for at in rng.choice(200, 1 if g % 10 == 9 else 8, replace=False):
            copy[at] = f"x{rng.integers(1e9)}"
        texts.append(" ".join(copy))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.component_id for r in near_duplicates(df, k=2).collect()}
    roots, _ = brute_components(texts, 2, 80)
    assert [got[i] for i in range(copies)] == roots and copies // 2 < len(set(roots)) < copies
    assert made["pairs"] < copies * (copies - 1) // 8


def test_near_duplicates_match_brute_force_on_documents(docs):
    rows = {r.doc_id: r.text for r in docs.collect()}
    ids = sorted(rows)
    got = {r.doc_id: r.component_id for r in near_duplicates(docs, k=2).select("doc_id", "component_id").collect()}
    roots, _ = brute_components([rows[i] for i in ids], 2, 80)
    assert [got[i] for i in ids] == [ids[r] for r in roots]


def test_near_dedup_edges(edge, none):
    rows = near_duplicates(edge, k=2).collect()
    assert len(rows) == edge.count()
    found = {(r.doc_id, r.n_shingles): r for r in rows}
    assert found[0, 5].component_id == found[1, 5].component_id == 0
    assert found[2, 0].kept and found[3, 0].kept and found[4, 0].kept
    assert found[None, 7].component_id is None and found[None, 7].kept
    kept = keep_first(edge, k=2)
    assert kept.columns == edge.columns
    assert kept.where("doc_id = 1").count() == 1 and kept.where("_id <> 'mine' or node <> 'mine'").count() == 0
    assert near_duplicates(none).count() == keep_first(none).count() == 0


def test_unlike_texts_of_one_id_are_all_kept(spark):
    """Without ids, and with one shared id: near copies go, unrelated texts stay, the group of another id among them."""
    text = lambda name: " ".join(f"{name}{i}" for i in range(40))
    rows = [(None, text(n)) for n in "abcdef"] + [(7, text(n)) for n in "ghijkl"]
    rows += [(None, text("a") + " more"), (7, text("g") + " more"), (3, text("m")), (7, text("m") + " more"), (None, text("m"))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    kept = [(r.doc_id, r.text.split()[0][0]) for r in keep_first(df, k=2).collect()]
    expected = [(None, n) for n in "abcdef"] + [(7, n) for n in "ghijkl"] + [(3, "m")]
    assert sorted(kept, key=str) == sorted(expected, key=str)


def test_signature_bound():
    assert 50 < least_agreeing(96, 80) < 65 and least_agreeing(96, 100) == 96


def brute_repeats(texts, window):
    words = [(t or "").encode().split() for t in texts]
    times = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if times[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        out.append((len(w), sum(gone), [x for x, g in zip(w, gone) if not g]))
    return out


@pytest.mark.parametrize("words", ["ab", "abcdefgh", "many"])
def test_repeats_match_brute_force(spark, words):
    """Small alphabets make runs and periodic texts, where a parse depends most on what lies around."""
    texts = word_lists(words)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: r for r in repeat_digest(df, window=12, rounds=3).collect()}
    for i, (n, gone, kept) in enumerate(brute_repeats(texts, 12)):
        assert (got[i].n_words, got[i].n_removed) == (n, gone)
        assert got[i].kept_sha256 == hashlib.sha256(b" ".join(kept)).hexdigest()


def test_repeats_of_texts_whose_short_hashes_agree(spark):
    """Two texts without an id that agree in Spark's 32-bit hash keep apart what rules their windows out."""
    from pyspark.sql import functions as F

    own = "array_join(transform(sequence(0, 39), n -> concat('x', id, '_', n)), ' ')"
    one, two = (" ".join(f"{c}{i}" for i in range(40)) for c in "pq")
    made = spark.range(300_000).selectExpr("id", f"if(id % 2 = 0, concat({own}, ' {one}'), concat('{two} ', {own})) AS text")
    alike = made.groupBy(F.hash("text").alias("h")).agg(F.min_by("text", F.col("id") % 2).alias("a"), F.max_by("text", F.col("id") % 2).alias("b"), F.countDistinct(F.col("id") % 2).alias("n"))
    first = alike.where("n = 2").orderBy("h").first()
    texts = [first.a, first.b, one, two]
    df = spark.createDataFrame([(None, t) for t in texts], "doc_id long, text string")
    got = sorted((r.n_words, r.n_removed, r.kept_sha256) for r in repeat_digest(df, window=12, rounds=3).collect())
    assert got == sorted((n, gone, hashlib.sha256(b" ".join(kept)).hexdigest()) for n, gone, kept in brute_repeats(texts, 12))


def test_symbols_depend_on_their_span_alone():
    """A text that holds the words of a dependence counts the same symbol there, whatever surrounds it."""
    rng = np.random.default_rng(1)
    for letters in (2, 3, 30):
        for _ in range(150):
            ids = word_ids([b"%d" % x for x in rng.integers(letters, size=80)])
            _, names, low, high = symbols([ids], 35, 4)
            for name, lo, hi in zip(names, low, high):
                around = [word_ids([b"%d" % x for x in rng.integers(letters, size=40)]) for _ in range(2)]
                _, names2, low2, _ = symbols([np.concatenate([around[0], ids[lo : hi + 1], around[1]])], 35, 4)
                assert name in names2[low2 == 40]


def test_symbols_of_several_texts():
    rng = np.random.default_rng(5)
    texts = [mix(rng.integers(0, 40, n).astype(np.uint64)) for n in (300, 0, 34, 35, 90, 1000)]
    alone = [(i, *x) for i, t in enumerate(texts) for x in zip(*(c.tolist() for c in symbols([t], 35, 4)[1:]))]
    assert alone == list(zip(*(c.tolist() for c in symbols(texts, 35, 4))))
    for at in ([], [3], [3, 4, 5, 9, 10, 20], list(range(50))):
        assert _expanded(pa.scalar(_ranges(np.array(at, np.int64)), pa.list_(pa.int64()))).tolist() == at
    assert [(c.start, c.stop) for c in _chunks([5, 0, 9, 2, 30, 1], 10)] == [(0, 2), (2, 3), (3, 4), (4, 5), (5, 6)]


def test_repeat_edges(edge, none):
    rows = repeat_digest(edge).collect()
    assert len(rows) == edge.count()
    by = {r.doc_id: r for r in rows if r.doc_id != 1}
    empty = hashlib.sha256(b"").hexdigest()
    assert by[2].kept_sha256 == by[3].kept_sha256 == empty and by[2].n_words == 0
    assert by[9].n_removed == 200 and by[10].n_removed == 80 and by[11].n_removed == 80
    kept = without_repeats(edge, window=35)
    assert kept.columns == edge.columns
    assert kept.where("_t <> 'mine' or starts <> 'mine'").count() == 0
    found = {r.doc_id: r for r in kept.collect()}
    assert 9 not in found and found[11].text == "prefix  suffix" and found[11].n_chars == 14
    assert repeat_digest(none).count() == without_repeats(none).count() == 0
