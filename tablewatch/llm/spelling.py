"""Spelling variants by a dictionary of trie-node pairs.

The nodes of the trie of all words and of the trie of all reversed words are numbered. A word and a place in it give a
pair of numbers: the node of what stands before the place and the node of what stands behind it. Two words that differ
by one replaced letter have the same pair where each skips its letter; a word with one letter more has, where it skips
that letter, the pair that the shorter word has between two of its letters. Equal pairs are found by one join on two
integers, whatever the length of the words, and nothing needs to be verified afterwards.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewatch.llm.common import discard, stored, table

#: Runs of letters (fixed by the contract).
LETTERS = "([A-Za-zÀ-ÿ]+)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words of one range of a trie.
RANGE = 100_000


def misspelt(docs: DataFrame, odds: int = 97) -> DataFrame:
    """(word) for every run of letters of every text, in lower case; one (document, run) in ``odds`` loses a letter.

    The crc32 of ``<doc_id>:<run>`` decides which runs and which letter; a null id counts as the text ``null``.
    """
    ids = F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("null")).alias("doc_id")
    runs = docs.select(ids, F.explode(F.regexp_extract_all("text", F.lit(LETTERS), 1)).alias("run"))
    runs = runs.select(F.concat_ws(":", "doc_id", low := F.translate("run", UPPER, LOWER)).alias("key"), low.alias("run"))
    at = F.pmod(F.crc32(F.col("key").cast("binary")), F.length("run"))
    cut = F.concat(F.expr("left(run, int(at))"), F.expr("substring(run, int(at) + 2)"))
    hit = F.crc32(F.col("key").cast("binary")) % odds == 0
    return runs.withColumns({"hit": hit, "at": at}).select(F.when(F.col("hit"), cut).otherwise(F.col("run")).alias("word"))


def vocabulary(words: DataFrame, length: int, least: int) -> DataFrame:
    """(word, n) of words of ``length`` or more letters with ``least`` or more occurrences."""
    return words.where(F.length("word") >= length).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least)


def _common(a: str, b: str) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    return next(i for i in range(n) if a[i] != b[i])


def _numbered(group: pd.DataFrame) -> pd.DataFrame:
    """Of the sorted words of one range: place, and the numbers of the nodes on its path, from 1 in every range; 0 where
    a node has no other word below it. The first and the last word keep all numbers, as the range may go on elsewhere;
    the last one also tells the path without gaps."""
    group = group.sort_values("word", key=lambda w: w.map(lambda s: s.encode("utf-8")))
    words = group.word.tolist()
    path, count, paths, before = [], 0, [], 0
    for i, word in enumerate(words):
        path = path[:before] + list(range(count + 1, count + 1 + len(word) - before))
        count += len(word) - before
        after = _common(word, words[i + 1]) if i + 1 < len(words) else len(word)
        shared = max(before, after) if i else len(word)
        paths.append(path[:shared] + [0] * (len(word) - shared))
        before = after
    return pd.DataFrame({"range": group.range, "word": words, "n": group.n, "at": range(len(words)), "path": paths, "nodes": count, "size": len(words)})


def _trie(words: DataFrame, ranges: int, label: str) -> DataFrame:
    """(word, n, id, path): ``id`` is the word's rank from 0, ``path[d]`` the number of the node of its first ``d``
    letters, the same for all words below it and null where there is no other word."""
    spark = words.sparkSession
    ranged = stored(words.repartitionByRange(ranges, "word").withColumn("range", F.spark_partition_id()), f"{label}-ranged")
    schema = "range int, word string, n long, at int, path array<long>, nodes long, size int"
    local = stored(ranged.groupBy("range").applyInPandas(_numbered, schema), label)
    ends = local.where("at = 0 or at = size - 1").orderBy("range", "at").collect()
    firsts, lasts = {r.range: r for r in ends if r["at"] == 0}, {r.range: r for r in ends if r["at"] == r["size"] - 1}
    # the first nodes of a range are those of the range before it as far as its first word agrees with the last one there
    starts, nodes, ids, before, last = [], 0, 0, [], ""
    for r in sorted(firsts):
        known = before[: _common(last, firsts[r].word)]
        starts.append((r, nodes, ids, known))
        last, of = lasts[r].word, lasts[r].path
        before = [known[x - 1] if x <= len(known) else x + nodes for x in of]
        nodes, ids = nodes + lasts[r].nodes, ids + lasts[r]["size"]
    starts = spark.createDataFrame(starts, "range int, nodes0 long, id0 long, known array<long>")
    number = lambda x: F.when(x > F.size("known"), x + F.col("nodes0")).when(x > 0, F.get("known", (x - 1).cast("int")))
    path = F.concat(F.array(F.lit(0).cast("long")), F.transform("path", number))
    out = stored(local.join(starts, "range").select("word", "n", (F.col("id0") + F.col("at")).alias("id"), path.alias("path")), f"{label}-nodes")
    discard(ranged, local)
    return out


def _pairs(words: DataFrame) -> DataFrame:
    """(before, behind, id, n, skips, last) of every word and place; ``last`` marks the last of equal neighbouring
    letters, so that a letter more or less is one pair however many equal letters stand beside it."""
    length = F.length("word")
    at = lambda name, i: F.get(F.col(name), i)

    def pair(i: Column, skip: int, last: Column) -> Column:
        return F.struct(at("fore", i).alias("before"), at("hind", length - i - skip).alias("behind"), F.lit(bool(skip)).alias("skips"), last.alias("last"))

    letter = lambda i: F.substr("word", i, F.lit(1))
    skipping = F.transform(F.sequence(F.lit(0), length - 1), lambda i: pair(i, 1, (i == length - 1) | (letter(i + 1) != letter(i + 2))))
    between = F.transform(F.sequence(F.lit(0), length), lambda i: pair(i, 0, F.lit(True)))
    rows = words.select("id", "n", F.inline(F.concat(skipping, between)))
    return rows.where("before is not null and behind is not null")


def neighbours(words: DataFrame) -> DataFrame:
    """(id, n_near, best_n, best) per word that has near words: how many, and the most frequent, of equals the first.

    The words of a pair differ by one letter, so there are no more than letters in the alphabet.
    """
    member = F.struct("n", (-F.col("id")).alias("back"), "skips", "last")
    groups = _pairs(words).groupBy("before", "behind").agg(F.collect_list(member).alias("all")).where(F.size("all") > 1)
    rows = groups.select(F.explode("all").alias("x"), "all")
    # two that skip a letter here differ by it; one that skips nothing is near those that skip a letter more
    near = lambda x, y: (x["back"] != y["back"]) & F.when(x["skips"] & y["skips"], True).when(x["skips"], x["last"]).otherwise(y["skips"] & y["last"])
    others = F.transform(F.filter("all", lambda y: near(F.col("x"), y)), lambda y: F.struct(y["n"].alias("n"), y["back"].alias("back")))
    rows = rows.select((-F.col("x.back")).alias("id"), others.alias("others")).where(F.size("others") > 0)
    found = rows.groupBy("id").agg(F.sum(F.size("others")).cast("long").alias("n_near"), F.max(F.array_max("others")).alias("best"))
    return found.select("id", "n_near", F.col("best.n").alias("best_n"), (-F.col("best.back")).alias("best"))


def _roots(forms: DataFrame) -> DataFrame:
    """(id, root) from (id, form): what following forms ends at. Every round doubles the steps taken."""
    state = stored(forms.select("id", F.col("form").alias("root")), "roots")
    while True:
        further = state.select(F.col("id").alias("root"), F.col("root").alias("next"))
        new = stored(state.join(further, "root", "left").select("id", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        discard(state)
        state = new.select("id", "root")
        state.stored_at = new.stored_at
        if not new.where("moved").limit(1).count():
            return state


def variants(docs: DataFrame, length: int = 5, least: int = 3, odds: int = 97, times: int = 2) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` of every word of ``length`` or more letters with ``least`` occurrences.

    Two words are near if they differ by exactly one inserted, deleted or replaced code point. A word's form is its
    most frequent near word, of equals the first in code-point order, if that is ``times`` as frequent; its root is
    what following forms ends at, the word itself without a form. Null and empty texts have no words; rows of one text
    count each; without words the result is empty.
    """
    counts = stored(vocabulary(misspelt(docs, odds), length, least), "vocabulary")
    ranges = max(1, -(-counts.count() // RANGE))
    fore = _trie(counts, ranges, "fore")
    hind = _trie(counts.select(F.reverse("word").alias("word"), "n"), ranges, "hind")
    hind_of = hind.select(F.reverse("word").alias("word"), F.col("path").alias("hind"))
    words = stored(fore.withColumnRenamed("path", "fore").join(hind_of, "word"), "words")
    discard(fore, hind, counts)
    near = stored(neighbours(words), "near")
    forms = words.select("id", "n").join(near, "id").where(F.col("best_n") >= times * F.col("n")).select("id", F.col("best").alias("form"))
    forms = stored(forms, "forms")
    roots = _roots(forms)
    name = lambda key, label: words.select(F.col("id").alias(key), F.col("word").alias(label), F.col("n").alias(f"{key}_n"))
    related = forms.join(roots, "id").join(name("form", "form_word"), "form").join(name("root", "root_word"), "root")
    related = related.select("id", F.col("form_word").alias("form"), "form_n", F.col("root_word").alias("root"))
    out = words.select("id", "word", "n").join(near.select("id", "n_near"), "id", "left").join(related, "id", "left")
    return out.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form", "form_n", F.coalesce("root", "word").alias("root"))


def op12_trie_pair_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(table(spark, sf_dir, "documents"))


#: Crc32 bit by bit; words joined by what is left without one letter.
OP12_SQL = r"""
with recursive crc as (
  select list(c order by i) as t from (select i, list_reduce(list_prepend(i::bigint, range(8)),
    lambda c, j: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as c from range(256) r(i))),
runs as (
  select doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run, count(*) as n
  from (select doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]+')) as run from documents)
  where length(run) >= 5 group by all),
bytes as (select *, hex(encode(concat(coalesce(doc_id::varchar, 'null'), ':', run))) as h from runs),
sums as (
  select run, n, xor(4294967295, list_reduce(list_prepend(4294967295::bigint, list_transform(range(0, length(h), 2),
    lambda i: ('0x' || substr(h, i + 1, 2))::bigint)), lambda a, b: xor(a >> 8, crc.t[(xor(a, b) & 255) + 1]))) as h
  from bytes, crc),
words as (
  select case when h % 97 = 0 then left(run, h % length(run)) || substr(run, h % length(run) + 2) else run end as word, sum(n)::bigint as n
  from sums group by word having length(word) >= 5 and sum(n) >= 3),
skips as (select word, n, i, left(word, i) || substr(word, i + 2) as rest from (select *, unnest(range(length(word))) as i from words)),
pairs as (
  select a.word, b.word as near from skips a join skips b on a.i = b.i and a.rest = b.rest and a.word <> b.word and length(a.word) = length(b.word)
  union select word, rest from skips where rest in (select word from words)
  union select rest, word from skips where rest in (select word from words)),
near as (
  select p.word, count(*) as n_near, arg_max(struct_pack(w := w.word, n := w.n), -r.r) as best from pairs p join words w on w.word = p.near
  join (select word, row_number() over (order by n desc, word) as r from words) r on r.word = p.near group by p.word),
forms as (select w.word, n.best.w as form, n.best.n as form_n from words w join near n on n.word = w.word where n.best.n >= 2 * w.n),
follow as (
  select word, form as here, 1 as step from forms
  union all select f.word, g.form, f.step + 1 from follow f join forms g on g.word = f.here),
roots as (select word, arg_max(here, step) as root from follow group by word)
select w.word, w.n, coalesce(x.n_near, 0) as n_near, f.form, f.form_n, coalesce(r.root, w.word) as root
from words w left join near x on x.word = w.word left join forms f on f.word = w.word left join roots r on r.word = w.word
"""
