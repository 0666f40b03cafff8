"""Line dedup: a suffix array over the line sequences of all documents, by distributed prefix doubling.

A suffix starts at a line of a document and ends with that document. Its rank at a depth counts the suffixes whose
first lines sort below; ranks at twice the depth are those of pairs of ranks. Suffixes that share a rank at the least
run length form an interval of the suffix array whose longest common prefix has at least that many lines: the same run
of lines stands at each of them. The first stays, the lines of later ones go. A suffix alone in its interval is
dropped from further rounds, so only repeated lines are carried on.

Native: DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tablewatch.llm.common import KEY, stored, table, text_key, unwrapped, wrapped

LEAST_LINES = 3
#: Ranks are counted in so many ranges of the sorted keys, then across them.
RANGES = 1024


def _let(value: Column, use) -> Column:
    """``use`` of a value that is computed once."""
    return F.transform(F.array(value), use)[0]


def _lines(text: str = "text") -> Column:
    return F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)


def _filled(lines: Column) -> Column:
    """Places of the lines that hold more than white space."""
    return F.filter(F.transform(lines, lambda x, i: F.when(x.rlike(r"[^\x20\x09-\x0D]"), i)), lambda i: i.isNotNull())


def _ranks(keys: DataFrame) -> DataFrame:
    """``rank`` of the distinct keys (a, b): the suffixes (``n`` each) whose key sorts below; ``range`` grows with the key."""
    before = Window.partitionBy("range").orderBy("a", "b").rowsBetween(Window.unboundedPreceding, -1)
    within = keys.withColumn("within", F.coalesce(F.sum("n").over(before), F.lit(0)))
    # one row a range
    across = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = keys.groupBy("range").agg(F.sum("n").alias("total")).withColumn("offset", F.coalesce(F.sum("total").over(across), F.lit(0)))
    return within.join(offsets.select("range", "offset"), "range").withColumn("rank", F.col("offset") + F.col("within")).drop("within", "offset")


def repeated_runs(docs: DataFrame, least: int = LEAST_LINES) -> DataFrame:
    """Key, ``i`` and ``first`` of every suffix whose first ``least`` filled lines also stand elsewhere.

    ``i`` counts the filled lines of the document from 0; ``first`` is the place where the run stands first, in the
    order of document id and text hash.
    """
    lines = _let(_lines(), lambda a: F.transform(_filled(a), lambda p: a[p]))
    hashed = F.transform(lines, lambda x: F.struct(F.xxhash64(x).alias("a"), F.xxhash64(F.lit(7), x).alias("b")))
    rows = docs.select(*text_key(), "text").select(*KEY, F.posexplode(hashed).alias("i", "line"))
    # hashes spread evenly over the ranges as they are
    bits = RANGES.bit_length() - 1
    rows = stored(rows.select(*KEY, "i", "line.a", "line.b", F.shiftright("line.a", 64 - bits).alias("range")), "lines")
    depth = 1
    while True:
        keys = rows.groupBy("range", "a", "b").agg(F.count("*").alias("n"), F.min(F.struct(*KEY, "i")).alias("first"))
        keys = stored(_ranks(keys.where("n > 1")), "ranks")
        ranked = rows.join(keys, ["range", "a", "b"]).select(*KEY, "i", "rank", "n", "first")
        if depth >= least:
            return ranked.select(*KEY, "i", "first")
        total = keys.agg(F.sum("n")).first()[0] or 1
        step = min(depth, least - depth)
        after = Window.partitionBy(*KEY).orderBy("i").rangeBetween(step, step)
        pairs = ranked.withColumn("b", F.max("rank").over(after)).where("b is not null")
        # suffixes of one rank are spread over the ranks that they fill by the rank of the second half
        place = (F.col("rank") + F.col("n") * F.col("b") / F.lit(total)) * F.lit(RANGES) / F.lit(total)
        rows = stored(pairs.select(*KEY, "i", F.col("rank").alias("a"), "b", F.floor(place).alias("range")), "pairs")
        depth += step


def _cut(text: Column, starts: Column, least: int) -> Column:
    """(kept text, lines, removed lines) without ``least`` filled lines from each start."""

    def of(lines: Column) -> Column:
        index = F.array_distinct(F.flatten(F.transform(starts, lambda i: F.sequence(i, i + F.lit(least - 1)))))
        gone = _let(_filled(lines), lambda p: F.transform(F.sort_array(index), lambda i: p[i]))
        return _let(gone, lambda g: rebuilt(lines, g))

    def rebuilt(lines: Column, gone: Column) -> Column:
        edge = lambda j: F.when(j < 0, F.lit(-1)).when(j >= F.size(gone), F.size(lines)).otherwise(F.get(gone, j))
        between = F.transform(
            F.sequence(F.lit(0), F.size(gone)),
            lambda j: F.slice(lines, edge(j - 1) + 2, edge(j) - edge(j - 1) - 1),
        )
        return F.struct(F.array_join(F.flatten(between), "\n").alias("kept"), F.size(lines).alias("n"), F.size(gone).alias("gone"))

    whole = F.struct(text.alias("kept"), F.size(_lines()).alias("n"), F.lit(0).alias("gone"))
    return F.when(starts.isNull(), whole).otherwise(_let(_lines(), of))


def cut_lines(docs: DataFrame, least: int = LEAST_LINES) -> DataFrame:
    """Adds ``kept_text``, ``n_lines`` and ``n_removed`` to the documents.

    A run of ``least`` or more filled lines that stands at an earlier place too (smaller document id, then earlier in
    the document) is removed; a longer run is removed line by line of its windows. Blank lines are no part of runs and
    stay. A null text stays null and counts as one blank line. Rows that agree in id and text are one document; a
    null id sorts first. Other columns are kept.
    """
    docs = docs.drop("kept_text", "n_lines", "n_removed")
    later = repeated_runs(docs, least).where(F.struct(*KEY, "i") != F.col("first"))
    starts = later.groupBy(*KEY).agg(F.collect_set("i").alias("_starts"))
    names = docs.columns
    rows = docs.withColumns(dict(zip(KEY, text_key()))).join(starts, KEY, "left")
    rows = rows.select(*names, _cut(F.col("text"), F.col("_starts"), least).alias("_made"))
    return rows.select(*names, F.col("_made.kept").alias("kept_text"), F.col("_made.n").alias("n_lines"), F.col("_made.gone").alias("n_removed"))


def without_repeated_lines(docs: DataFrame, least: int = LEAST_LINES) -> DataFrame:
    """The documents with later copies of line runs cut from their texts; those left without a filled line go.

    ``n_chars``, where present, is set to the new length of a text that was cut.
    """
    rows = cut_lines(wrapped(docs), least).where((F.col("n_removed") == 0) | F.col("kept_text").rlike(r"[^\x20\x09-\x0D]"))
    return unwrapped(rows, docs, F.col("kept_text"), F.col("n_removed") > 0)


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cut_lines(table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    kept = F.sha2(F.coalesce(F.col("kept_text"), F.lit("")), 256)
    return rows.select("doc_id", F.col("n_lines").cast("long").alias("n_lines"), F.col("n_removed").cast("long").alias("n_removed"), kept.alias("kept_sha256"))


OP5_SQL = r"""
WITH lines AS (
  SELECT doc_id, text, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS p
  FROM documents),
filled AS (
  SELECT doc_id, p, line, row_number() OVER (PARTITION BY doc_id ORDER BY p) AS i
  FROM lines WHERE regexp_matches(line, '[^ 	-
]')),
runs AS (
  SELECT doc_id, i, line AS l0, lead(line, 1) OVER d AS l1, lead(line, 2) OVER d AS l2
  FROM filled WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
later AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY l0, l1, l2 ORDER BY doc_id, i) AS nth
  FROM runs WHERE l2 IS NOT NULL),
gone AS (SELECT DISTINCT doc_id, i + k AS i FROM later, (VALUES (0), (1), (2)) AS t(k) WHERE nth > 1),
marked AS (
  SELECT l.doc_id, l.p, l.line, g.i IS NOT NULL AS removed
  FROM lines l LEFT JOIN filled f USING (doc_id, p) LEFT JOIN gone g ON g.doc_id = f.doc_id AND g.i = f.i)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE removed) AS n_removed,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (WHERE NOT removed), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
