"""Packing, sampled segmentations, classifiers, top-k, fingerprints and the pipeline."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewatch.llm import language, quality, sampling, toxicity
from tablewatch.llm.fingerprints import as_text, fingerprint, likeness, with_next
from tablewatch.llm.packing import match_runs, pack, pack_documents, pieces
from tablewatch.llm.topk import OP6_SQL, integer_vectors, top_k


def brute_best_fit(lengths, capacity):
    gaps = []
    for n in sorted(lengths, reverse=True):
        fits = [g for g in gaps if g >= n]
        if fits:
            g = min(fits)
            gaps.remove(g)
        else:
            g = capacity
        gaps.append(g - n)
    return len(gaps)


@pytest.mark.parametrize("seed", range(5))
def test_runs_pack_like_best_fit_decreasing(seed):
    rng = np.random.default_rng(seed)
    lengths = rng.integers(1, rng.choice([8, 40, 100]) + 1, 300).tolist()
    assert match_runs(Counter(lengths), 100)[1] == brute_best_fit(lengths, 100)


def check_packed(rows, capacity):
    end = Counter()
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == end[r.sequence_id]
        end[r.sequence_id] += r.length
    assert max(end.values()) <= capacity
    return len(end)


def test_packing_of_documents(docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = pack_documents(docs).collect()
    total = sum(r.length for r in rows)
    assert check_packed(rows, 2048) <= math.ceil(total / 2048) * 1.02 + 1
    of = {}
    for r in rows:
        of.setdefault(r.doc_id, []).append(r)
    for d in docs.collect():
        ids = np.array([*plain.encode(d.text, add_special_tokens=False).ids, 0], "<u4")
        mine = sorted(of[d.doc_id], key=lambda r: r.piece)
        assert [r.start for r in mine] == list(np.cumsum([0, *(r.length for r in mine[:-1])])) and sum(r.length for r in mine) == len(ids)
        assert all(r.length == 2048 for r in mine[1:])
        assert all(r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes()) for r in mine)


@pytest.mark.parametrize("text", ["a  b", "a \n  b", " a ", "\n\nx\n y", "x  y z", "it's <|endoftext|> here", "tab\tand\x1cmore", "é 日本 🙂 x", "don't  'll"])
def test_fast_encoding_is_the_tokenizers_one(spark, text):
    import public_tokenizers
    from tokenizers import Tokenizer

    from tablewatch.llm.packing import encoder

    ids = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")).encode(text, add_special_tokens=False).ids
    assert np.frombuffer(encoder(None)(text), "<u4").tolist() == ids


def test_fast_encoding_of_random_texts():
    """White space of all kinds, control characters, marks and letters in any order."""
    import public_tokenizers
    from tokenizers import Tokenizer

    from tablewatch.llm.packing import encoder

    whole, rng = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), np.random.default_rng(2)
    letters = list(" " * 8 + "ab'sé9.-\n\t\r\x0b\x1c\x1f\x85\xa0\u1680\u2003\u2028\u200b\u3000\ufeff日")
    for _ in range(20_000):
        text = "".join(rng.choice(letters, rng.integers(1, 12)))
        assert np.frombuffer(encoder(None)(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids, repr(text)


def test_packing_edges(spark, edge, none):
    rows = pack_documents(edge).collect()
    assert check_packed(rows, 2048) and {r.doc_id for r in rows} == {None, *range(12)}
    assert [r.length for r in rows if r.doc_id == 2] == [1]
    assert pack_documents(none).count() == pieces(none).count() == 0
    with pytest.raises(ValueError):
        pack(spark.createDataFrame([(5,)], "length long"), capacity=4)


def test_segmentations_follow_the_distribution():
    p = sampling.vocabulary(None)
    paths = [((), 0.0)]
    for word in sampling.split("thinker in"):
        steps = p.lattice(word)

        def from_(i):
            return [((), 0.0)] if i == len(steps) else [(ids + r, w + x) for n, ids, w, _, _ in steps[i] for r, x in from_(i + n)]

        paths = [(a + b, x + y) for a, x in paths for b, y in from_(0)]
    share = {path: math.exp(x) for path, x in paths}
    assert sum(share.values()) == pytest.approx(1)
    first, second = Counter(), Counter()
    for seed in range(4000):
        a, b = sampling.sample(p, "thinker in", 2, seed)
        assert a[0] != b[0] and a[2] >= b[2]
        first[tuple(a[0])] += 1
        second[tuple(b[0])] += 1
    for path in sorted(share, key=share.get)[-4:]:
        expected = sum(share[q] * share[path] / (1 - share[q]) for q in share if q != path)
        assert first[path] / 4000 == pytest.approx(share[path], abs=0.03)
        assert second[path] / 4000 == pytest.approx(expected, abs=0.03)
    every = sampling.sample(p, "thinker in", 10_000, 1)
    assert len(every) == len(share) and sampling.inclusion(every, 10_000) == [1.0] * len(every)


def test_segmentations_round_trip(edge, none):
    rows = sampling.encode_samples(edge, F.xxhash64("doc_id", "text"), k=2).collect()
    assert all(r.decoded == (r.text or "") for r in rows)
    assert Counter(r["sample"] for r in rows)[1] == edge.count()
    assert all(0 <= r.inclusion <= 1 for r in rows) and all(r.row == "mine" for r in rows)
    again = sampling.encode_samples(edge.repartition(5), F.xxhash64("doc_id", "text"), k=2).collect()
    assert sorted((r.text or "", r["sample"], tuple(r.ids)) for r in rows) == sorted((r.text or "", r["sample"], tuple(r.ids)) for r in again)
    assert sampling.encode_samples(none, F.xxhash64("doc_id")).count() == 0


def test_segmentations_beside_clashing_names(edge):
    """Columns named like helpers stay; those named like a result are replaced by it."""
    clashing = edge.where("doc_id in (2, 5, 6)").withColumns({n: F.lit("mine") for n in ["_seed", "c0", "a.b", "Sample", "ids", "decoded"]})
    rows = sampling.encode_samples(clashing, F.xxhash64("doc_id", "Sample"), k=2)
    assert rows.columns == [c for c in clashing.columns if c not in ("Sample", "ids", "decoded")] + ["sample", "ids", "log_prob", "inclusion", "decoded"]
    found = rows.collect()
    assert {r.doc_id for r in found} == {2, 5, 6} and all(r["_seed"] == r["c0"] == r["a.b"] == "mine" and r.decoded == (r.text or "") for r in found)


def test_quality_separates_bad_texts(spark, sf, docs, none, edge):
    found = quality.judge(docs, quality.learn(docs)).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    good, bad = ([r.score for r in found if r.quality == q] for q in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) > 0.9
    assert quality.learn(none).share == 0.5
    assert quality.judge(edge, quality.learn(edge)).where("score between 0 and 1 and weak_label between 0 and 1").count() == edge.count()


def test_label_model_finds_accuracies():
    rng = np.random.default_rng(0)
    good = rng.random(20_000) < 0.8
    right = rng.random((20_000, 5)) < np.array([0.95, 0.9, 0.85, 0.8, 0.7])
    cast = rng.random((20_000, 5)) < 0.8
    votes = np.where(cast, np.where(right == good[:, None], quality.GOOD, quality.BAD), quality.NONE)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    share, rates = quality.estimate(patterns, counts.astype(float))
    found = (quality.posterior(votes, share, rates) >= 0.5) == good
    assert share == pytest.approx(0.8, abs=0.08) and found.mean() > 0.93


def test_toxicity_tolerates_gaps():
    rng = np.random.default_rng(0)
    words = [f"{a}{b}{c}" for a in ("ba", "ne", "lo", "tri") for b in ("mu", "sa", "ke") for c in ("nd", "rt", "ll")]
    texts, toxic = [], []
    for i in range(300):
        text = list(rng.choice(words, 30))
        if i % 5 == 0:
            text.insert(int(rng.integers(30)), str(rng.choice(["wretchling", "scumfolk", "dolthead"])))
        texts.append(" ".join(text))
        toxic.append(int(i % 5 == 0))
    m = toxicity.fit(texts, toxic)
    score = lambda t: float(m.probability(m.worst([t]))[0])
    assert score("lomund wretchling trisart") > 0.5 and score("lomund trisart") < 0.5
    for odd in ("w.r.e.t.c.h.l.i.n.g", "wret-chling!", "wretchhling", "w r e t c h l i n g", "WRETCHLING"):
        assert score(f"lomund {odd} trisart") > 0.5, odd
    assert 0 <= score("") <= 1


def test_toxicity_late_in_long_tokens():
    """An insult counts wherever it stands: after other signs, among letters written apart, inside a word without end."""
    rng = np.random.default_rng(0)
    words = [f"{a}{b}{c}" for a in ("ba", "ne", "lo", "tri") for b in ("mu", "sa", "ke") for c in ("nd", "rt", "ll")]
    insults = ["wretchling", "scumfolk", "dolthead"]
    texts = [" ".join([*rng.choice(words, 30), *([insults[i % 3]] if i % 5 == 0 else [])]) for i in range(300)]
    m = toxicity.fit(texts, [int(i % 5 == 0) for i in range(300)])
    score = lambda t: float(m.probability(m.worst([t]))[0])
    listed, apart, solid = ",".join(f"word{i}" for i in range(60)), " ".join("lomund" * 50), "".join(rng.choice(words, 60))
    for clean in (listed, apart, solid):
        assert len(max(map(toxicity.plain, toxicity.tokens(clean)), key=len)) > 256 and score(clean) < 0.5
    for insult in insults:
        for odd in (f"{listed},{insult}", f"{listed}_{insult}", f"{apart} {' '.join(insult)}", solid + insult, solid + insult + solid):
            assert score(odd) > 0.5, odd
    # what is learned from long tokens is not their beginning alone
    late = toxicity.fit([f"{listed},{t.replace(' ', ',')}" for t in texts], [int(i % 5 == 0) for i in range(300)])
    assert late.probability(late.worst(["lomund dolthead"]))[0] > 0.5 > late.probability(late.worst(["lomund"]))[0]


def test_toxicity_edges(spark, edge, none):
    labels = spark.createDataFrame([(0, 1), (5, 0), (None, 1), (7, None)], "doc_id long, toxic int")
    found = toxicity.score(edge, toxicity.learn(edge, labels)).where("score between 0 and 1")
    assert found.count() == edge.count() and found.where("predicted <> int(score >= 0.5)").count() == 0
    assert toxicity.score(none, toxicity.learn(none, labels.limit(0))).count() == 0


def test_language_of_held_out_documents(docs):
    from tablewatch.llm.common import held_out

    rows = language.identify(docs, language.learn(docs)).where(held_out()).collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.9


def test_language_edges(edge, none, docs):
    model = language.learn(docs)
    by = {r.doc_id: r for r in language.identify(edge, model).collect()}
    assert all(by[i].lang_pred == "und" and by[i].score == 0 for i in (2, 3, 4, 6))
    kept = language.accepted(docs.unionByName(edge.select(docs.columns)))
    assert kept.columns == docs.columns and kept.where("doc_id = 6 and text like '12%'").count() == 0
    assert language.accepted(none).count() == 0 and language.learn(none).languages == []
    assert language.accepted(edge).columns == edge.columns


def brute_top(rows, k):
    ok = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for q, v in ok:
        if q % 5 == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in ok if i != q)
            out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])}
    return out


@pytest.mark.parametrize("count", [0, 1, 4, 300])
def test_top_k_matches_brute_force(spark, count):
    rng = np.random.default_rng(count)
    rows = [(i, rng.integers(-3, 3, 6).astype(float).tolist()) for i in range(count)]
    rows += [(1000, None), (None, [1.0] * 6), (1005, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (1010, [float("nan")] * 6)] if count else []
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {tuple(r) for r in top_k(integer_vectors(df), F.col("vec_id") % 5 == 0, pivots=8).collect()}
    assert got == brute_top(rows, 5)


@pytest.mark.parametrize("lengths", [[3, 2], [0, 0, 4], [0], [1, 5, 0, 9]])
def test_top_k_of_vectors_of_several_lengths(spark, lengths):
    """No vector is left out, and the SQL says the same: components that one of two lacks count as zero."""
    import duckdb

    rng = np.random.default_rng(len(lengths))
    rows = [(10 * i, rng.integers(-3, 4, lengths[i % len(lengths)]).astype(float).tolist()) for i in range(30)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {tuple(r) for r in top_k(integer_vectors(df), F.col("vec_id") % 50 == 0, pivots=4).collect()}
    con = duckdb.connect()
    con.execute("create table embeddings (vec_id bigint, embedding double[])")
    con.executemany("insert into embeddings values (?, ?)", rows)
    assert got == set(con.execute(OP6_SQL).fetchall()) and len(got) == 6 * 5


def test_top_k_with_a_common_vector(spark):
    rng = np.random.default_rng(1)
    common = [2.0, -1.0, 3.0, 0.0]
    rows = [(i, common if i % 3 == 0 else rng.integers(-2, 3, 4).astype(float).tolist()) for i in range(400)]
    rows += [(15, common)] * 9 + [(2, rows[2][1])] * 3 + [(7, common)] * 2
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    got = [tuple(r) for r in top_k(integer_vectors(df), F.col("vec_id") % 5 == 0, pivots=8).collect()]
    assert len(got) == len(set(got)) == 80 * 5 and set(got) == brute_top(rows, 5)


def test_fingerprints(spark, edge, none):
    rows = edge.withColumn("p", fingerprint(F.col("text"))).select("doc_id", "text", "p", as_text(F.col("p")).alias("s")).collect()
    of = {}
    for r in rows:
        assert of.setdefault(r.text or "", r.s) == r.s and len(r.s) == 10 * len(r.p)
    words = [f"w{i}" for i in range(400)]
    moved = words[200:] + words[:200]
    changed = [*words[:300], *(f"x{i}" for i in range(100))]
    df = spark.createDataFrame([[" ".join(w)] for w in (words, moved, changed, ["other"] * 50)], "t string")
    base = fingerprint(F.lit(" ".join(words)))
    same, swapped, near, far = (r[0] for r in df.select(likeness(base, fingerprint(F.col("t")))).collect())
    assert same == 1 and far == 0 and 0 < near < 1 and 0 < swapped < 1
    assert none.select(fingerprint(F.col("text"))).count() == 0


def test_fingerprints_of_texts_without_blanks(spark):
    rng = np.random.default_rng(2)
    base, other = ("".join(rng.choice(list("abcdefghij日本é🙂"), 2000)) for _ in range(2))
    texts = [base, "xy" + base, base[:1500] + other[:500], base[1000:] + base[:1000], other, base[:900] + " " + base[900:]]
    df = spark.createDataFrame([[t] for t in texts], "t string")
    prints = fingerprint(F.lit(base))
    same, moved_on, near, swapped, far, parted = (r[0] for r in df.select(likeness(prints, fingerprint(F.col("t")))).collect())
    assert same == 1 and far == 0 and moved_on > 0.8 and parted > 0.8 and 0.2 < near < 1 and 0 < swapped < 1
    assert spark.range(1).select(F.size(prints)).first()[0] > 20


@pytest.mark.parametrize("ranges", [1, 3, 256])
def test_next_document(spark, ranges):
    df = spark.createDataFrame([(i * 7 % 50, f"t{i * 7 % 50}") for i in range(50)], "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.next_text for r in with_next(df, ["text"], ranges).collect()}
    assert got == {i: f"t{(i + 1) % 50}" for i in range(50)}
    assert with_next(df.limit(0), ["text"], ranges).count() == 0


def test_pipeline_against_brute_force(spark, sf, docs):
    import corpus_pipeline
    from test_dedup import brute_components, brute_lines, brute_repeats

    packed = corpus_pipeline.run(spark, sf).collect()
    model = language.learn(docs)
    rows = [(d.doc_id, d.text) for d in sorted(docs.collect(), key=lambda d: d.doc_id)]
    rows = [(i, t) for i, t in rows if (p := model.predict(t))[0] != "und" and p[1] >= 0.5]
    rows = [(i, t) for (i, _), t in zip(rows, brute_lines([t for _, t in rows], 3)) if t.strip()]
    roots, _ = brute_components([t for _, t in rows], 5, 80)
    rows = [r for n, r in enumerate(rows) if roots[n] == n]
    kept = [(i, k) for (i, _), (_, _, k) in zip(rows, brute_repeats([t for _, t in rows], 50)) if k]
    assert {r.doc_id for r in packed} == {i for i, _ in kept}
    assert check_packed(packed, 2048)


def test_pipeline_stages_keep_columns(spark, edge):
    import corpus_pipeline

    rows = edge
    for name, stage in corpus_pipeline.STAGES[:-1]:
        rows = stage(spark, rows, "")
        assert rows.columns == edge.columns, name
    assert rows.where("doc_id in (2, 3, 4, 6)").count() == 0
