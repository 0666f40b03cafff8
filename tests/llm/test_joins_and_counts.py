"""Set join, spelling variants and phrase counting against brute force, on edge cases and against their SQL."""

import itertools
import random
import re
import zlib
from collections import Counter

import duckdb
import pytest

from tablewatch import llm
from tablewatch.llm import phrases, sizeaware, spelling

GAP = r"[\x20\x09-\x0D]+"
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def got(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def columns_of(rows):
    return sorted(rows, key=repr)


# --- set join


def brute_sets(texts, k):
    out = []
    for text in texts:
        words = [w for w in re.split(GAP, (text or "").translate(FOLD)) if w]
        m = min(k, len(words))
        out.append({tuple(words[i : i + m]) for i in range(len(words) - m + 1)} if words else set())
    return out


def brute_components(ids, sets, percent):
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in itertools.combinations(range(len(ids)), 2):
        both = len(sets[i] & sets[j])
        if sets[i] and sets[j] and 100 * both >= percent * len(sets[i] | sets[j]):
            root[find(i)] = find(j)
    low = {}
    for i, d in enumerate(ids):
        r = find(i)
        low[r] = min(low.get(r, d), d)
    return [(d, len(s), low[find(i)]) for i, (d, s) in enumerate(zip(ids, sets))]


def similar_texts(rng, n):
    """Small and large texts in chains of slight changes, so that links hang on single shingles."""
    texts = []
    while len(texts) < n:
        base = [f"w{rng.randrange(30 if rng.random() < 0.3 else 4000)}" for _ in range(rng.choice([3, 5, 7, 12, 25, 60, 200]))]
        for _ in range(rng.randrange(1, 9)):
            base = list(base)
            for _ in range(rng.randrange(0, 1 + len(base) // 25 + 1)):
                at = rng.randrange(len(base))
                base[at : at + 1] = rng.choice([[], [f"x{rng.randrange(10**6)}"], [base[at], f"y{rng.randrange(10**6)}"]])
            texts.append(" ".join(base))
    return texts


@pytest.mark.parametrize("k, percent", [(4, 85), (2, 70)])
def test_set_join_equals_brute_force(spark, k, percent):
    texts = similar_texts(random.Random(k), 350)
    ids = list(range(0, 7 * len(texts), 7))
    docs = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string").repartition(5)
    wanted = brute_components(ids, brute_sets(texts, k), percent)
    assert any(d != c for d, _, c in wanted)
    assert got(sizeaware.similar_sets(docs, k, percent), "doc_id", "n_shingles", "component_id") == columns_of(wanted)


def test_large_group_of_near_copies(spark):
    rng = random.Random(3)
    base = [f"w{i}" for i in range(120)]
    texts = []
    for i in range(160):
        words = list(base)
        for at in rng.sample(range(120), rng.choice([1, 2, 4])):
            words[at] = f"z{i}x{at}"
        texts.append(" ".join(words))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    wanted = brute_components(list(range(160)), brute_sets(texts, 4), 85)
    assert got(sizeaware.similar_sets(docs), "doc_id", "n_shingles", "component_id") == columns_of(wanted)


def test_least_shared_bounds_every_link():
    for n in range(1, 200):
        for m in range(n, 240):
            for both in range(n + 1):
                if 100 * both >= 85 * (n + m - both):
                    assert both >= sizeaware.least_shared(n, 85) and both >= sizeaware.least_shared(m, 85)


def test_set_join_edges(edge, none):
    rows = {r.doc_id: r for r in sizeaware.similar_sets(edge).collect()}
    assert rows[0].component_id == rows[1].component_id == 0 and rows[2].component_id == 2
    assert (rows[2].n_shingles, rows[3].n_shingles, rows[4].n_shingles, rows[5].n_shingles, rows[10].n_shingles) == (0, 0, 0, 1, 29_997)
    assert rows[None].component_id is None
    assert sizeaware.similar_sets(edge).count() == edge.count()
    assert sizeaware.similar_sets(none).collect() == []


# --- spelling variants


def brute_words(rows, length, least, odds):
    words = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(FOLD)
            h = zlib.crc32(f"{'null' if doc_id is None else doc_id}:{run}".encode())
            if h % odds == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            words[run] += len(run) >= length
    return {w: n for w, n in words.items() if n >= least}


def near_words(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(words, times=2):
    forms, near = {}, {}
    for w in words:
        near[w] = [v for v in words if near_words(w, v)]
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        forms[w] = best if best is not None and words[best] >= times * words[w] else None
    out = []
    for w, n in words.items():
        root = w
        while forms[root]:
            root = forms[root]
        out.append((w, n, len(near[w]), forms[w], words.get(forms[w]), root))
    return columns_of(out)


VARIANT = ["word", "n", "n_near", "form", "form_n", "root"]


@pytest.mark.parametrize("size", [7, 100_000])
def test_variants_equal_brute_force(spark, monkeypatch, size):
    monkeypatch.setattr(spelling, "RANGE", size)
    rng = random.Random(11)
    stems = ["".join(rng.choice("aabé") for _ in range(rng.randrange(4, 8))) for _ in range(60)]
    rows = [(i if i % 9 else None, " ".join(rng.choice(stems) + rng.choice(["", "", "b", "É"]) for _ in range(80)) + " 12 Aàaa-BBBBBB") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    words = brute_words(rows, 4, 2, 7)
    wanted = brute_variants(words)
    assert sum(r[3] is not None for r in wanted) > 5 and max(r[2] for r in wanted) > 3
    assert got(spelling.variants(docs, 4, 2, 7), *VARIANT) == wanted


def test_trie_numbers_name_prefixes(spark, monkeypatch):
    monkeypatch.setattr(spelling, "RANGE", 5)
    rng = random.Random(2)
    words = sorted({"".join(rng.choice("abcà") for _ in range(rng.randrange(1, 7))) for _ in range(60)})
    frame = spark.createDataFrame([(w, 1) for w in words], "word string, n long")
    rows = spelling._trie(frame, 12, "test").collect()
    assert sorted((r.id, r.word) for r in rows) == list(enumerate(words))
    number = {}
    for r in rows:
        for d, x in enumerate(r.path):
            if x is not None:
                assert number.setdefault(r.word[:d], x) == x
    assert len(set(number.values())) == len(number)
    shared = Counter(w[:d] for w in words for d in range(len(w) + 1))
    assert all(p in number for p, n in shared.items() if n > 1)


def test_variants_edges(edge, none, spark):
    rows = {r.word: r for r in spelling.variants(edge, 3, 1, 10**9).collect()}
    assert rows["alpha"].n == 3 and rows["alpha"].n_near == 0 and rows["alpha"].root == "alpha"
    assert spelling.variants(none).collect() == [] and spelling.variants(none).columns == VARIANT
    long = "q" * 3000
    docs = spark.createDataFrame([(1, f"{long} {long}q {long}q"), (2, None), (3, f"{long}q")], "doc_id long, text string")
    found = got(spelling.variants(docs, 5, 1, 10**9), *VARIANT)
    assert found == columns_of([(long, 1, 1, long + "q", 3, long + "q"), (long + "q", 3, 1, None, None, long + "q")])


# --- phrases


def brute_collocations(rows, longest, least, share, top):
    counts, totals = Counter(), Counter()
    for text, lang in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(FOLD)):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            totals[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    counts[lang, tuple(words[i : i + k])] += 1
    frequent = {p: n for p, n in counts.items() if n >= least}
    around = {}
    for (lang, p), n in frequent.items():
        for k in range(1, len(p)):
            for i in range(len(p) - k + 1):
                key = lang, p[i : i + k]
                around[key] = max(around.get(key, 0), n)
    found = []
    for (lang, p), a in frequent.items():
        if len(p) > 1 and 100 * around.get((lang, p), -1) < share * a:
            cuts = [(1000 * a * totals[lang] // (counts[lang, p[:k]] * counts[lang, p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            found.append((lang, " ".join(p), a, counts[lang, p[:k]], counts[lang, p[k:]], totals[lang], score))
    out = []
    for lang in {f[0] for f in found}:
        best = sorted((f for f in found if f[0] == lang), key=lambda f: (-f[6], -f[2], f[1].encode()))
        out += [(f[0], i + 1, *f[1:]) for i, f in enumerate(best[:top])]
    return columns_of(out)


PHRASE = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


@pytest.mark.parametrize("shards, words, slots", [(4, 1 << 18, 1 << 22), (1, 1 << 18, 1 << 22), (3, 50, 16)])
def test_phrases_equal_brute_force(spark, monkeypatch, shards, words, slots):
    import numpy as np

    monkeypatch.setattr(phrases, "WORDS", words)
    monkeypatch.setattr(phrases, "SLOTS", slots)
    monkeypatch.setattr(phrases, "_MASK", np.uint64(slots - 1))
    rng = random.Random(shards)
    vocabulary = [f"w{i}" for i in range(12)] + ["Ünï", "B", "\x1fq"]
    fixed = [["w1", "w2", "w3", "w4"], ["B", "w5"], ["w7"] * 6]
    rows = []
    for i in range(90):
        parts = []
        for _ in range(rng.randrange(1, 40)):
            parts += rng.choice(fixed) if rng.random() < 0.3 else [rng.choice(vocabulary)]
            parts.append(rng.choice(["", "", "", "", ".", "\n", "?!", "\t"]))
        rows.append((" ".join(parts), rng.choice(["en", "de", None, "und"])))
    rows += [(None, "en"), ("", "en"), (". , \n", "fr"), ("w1 " * 400, "xx")]
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(6)
    for least, share, top in ((8, 100, 2000), (20, 60, 5)):
        wanted = brute_collocations(rows, 5, least, share, top)
        assert wanted
        assert got(phrases.collocations(docs, 5, least, share, top, shards), *PHRASE) == wanted


def test_long_texts_are_split_between_words():
    text = "ab. " + "x" * 700 + " c\td,e " * 400
    whole = [w for part in phrases._word_lists(text) for w in part]
    size, phrases.SLICE = phrases.SLICE, 16
    try:
        assert [w for part in phrases._word_lists(text) for w in part] == whole
    finally:
        phrases.SLICE = size
    assert list(phrases._word_lists(None)) == [[phrases._END]]


def test_phrases_edges(edge, none):
    rows = [tuple(r) for r in edge.select("text", "lang").collect()]
    wanted = brute_collocations(rows, 5, 100, 100, 2000)
    assert wanted and got(phrases.collocations(edge, 5, 100), *PHRASE) == wanted
    assert phrases.collocations(none).collect() == []


# --- the registered queries


@pytest.mark.parametrize("name", sorted(llm.ORACLE))
def test_query_equals_its_sql(spark, sf, name):
    df = llm.QUERIES[name](spark, sf)
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    cursor = con.execute(llm.ORACLE[name])
    assert set(df.columns) == {d[0] for d in cursor.description}
    assert got(df, *[d[0] for d in cursor.description]) == columns_of(cursor.fetchall())


def test_every_operator_is_registered():
    assert {int(n[2:].split("_")[0]) for n in llm.QUERIES} == set(range(1, 14))


@pytest.mark.parametrize("name", ["op5_line_dedup", "op10_order_minhash"])
def test_native_operators_stay_in_the_engine(spark, sf, name):
    plan = llm.QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|InPandas|InArrow|CartesianProduct|NestedLoop", plan)


@pytest.mark.parametrize("name", ["op11_size_aware_join", "op12_trie_pair_variants", "op13_dynamic_phrase_counting"])
def test_no_join_without_a_key(spark, sf, name):
    plan = llm.QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("CartesianProduct|NestedLoop", plan)
