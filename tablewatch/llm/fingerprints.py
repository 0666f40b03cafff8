"""Document fingerprints by Order MinHash.

The k-mers of a text are its runs of k words, numbered by occurrence, so that a repeated one counts as often as it
stands there. A long word counts as the words that its runs of GRAM characters are, one from each place, so a text
without white space has k-mers in proportion to its length too. One hash deals them to bins; in each bin the smallest are selected, put back into text order and hashed
as a tuple. A bin's value survives an edit only if the same k-mers stay minimal and keep their order, so agreement of
two fingerprints falls with the edit distance of the texts, moved passages included.

Native: DataFrame functions only. No row is shuffled but to find the next document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tablewatch.llm.common import table

K, TUPLE = 2, 2
#: Bins are the upper bits of an element; then 35 bits of its hash; then the place of the k-mer in the text.
BIN_BITS, PLACE_BITS = 5, 24
_PLACE = (1 << PLACE_BITS) - 1
#: Words of more characters are taken by their runs of ``GRAM`` characters.
LONG_WORD, GRAM = 24, 6
#: White space between words: space and the ASCII controls from tab to carriage return.
_BLANKS = " \t\n\x0b\x0c\r"
#: Ranges of ids within which the next document is found; what lies at their edges is joined on.
RANGES = 256


def _let(value: Column, use) -> Column:
    """``use`` of a value that is computed once."""
    return F.transform(F.array(value), use)[0]


def _grams(word: Column) -> Column:
    """A long word as its runs of characters, any other as it is."""
    runs = lambda c: F.transform(
        F.sequence(F.lit(0), F.size(c) - GRAM), lambda i: F.concat(*(F.get(c, i + j) for j in range(GRAM)))
    )
    return F.when(F.char_length(word) > LONG_WORD, _let(F.split(word, ""), runs)).otherwise(F.array(word))


def _words(text: Column) -> Column:
    inner = F.btrim(text, F.lit(_BLANKS))
    words = F.split(inner, r"[\x20\x09-\x0D]+")
    long = inner.rlike(r"[^\x20\x09-\x0D]{%d}" % (LONG_WORD + 1))
    return (
        F.when(inner == "", F.array().cast("array<string>"))
        .when(long, F.flatten(F.transform(words, _grams)))
        .otherwise(words)
    )


def _kmers(words: Column, k: int) -> Column:
    """Hash of every k-mer with its place in the lower bits, sorted; a shorter text is one k-mer, an empty one has none."""
    one = lambda i: F.xxhash64(*(F.get(words, i + j) for j in range(k)))
    packed = lambda i: one(i).bitwiseAND(F.lit(~_PLACE)).bitwiseOR(i.cast("long").bitwiseAND(F.lit(_PLACE)))
    places = F.sequence(F.lit(0), F.greatest(F.size(words) - k, F.lit(0)))
    return F.when(F.size(words) == 0, F.array().cast("array<long>")).otherwise(F.sort_array(F.transform(places, packed)))


def _hash_of(packed: Column) -> Column:
    return packed.bitwiseAND(F.lit(~_PLACE))


def _occurrence(kmers: Column, x: Column, j: Column) -> Column:
    """How many equal k-mers come before place ``j`` of the sorted k-mers, by doubling steps back."""
    same = lambda back: (j >= back) & (_hash_of(F.get(kmers, j - back)) == _hash_of(x))
    steps = F.array(*(F.lit(1 << b) for b in reversed(range(PLACE_BITS))))
    count = F.aggregate(steps, F.lit(1), lambda n, d: F.when(same(n + d), n + d).otherwise(n))
    return F.when(same(F.lit(1)), count).otherwise(F.lit(0))


def _bin(element: Column) -> Column:
    return F.shiftrightunsigned(element, 64 - BIN_BITS)


def _selected(kmers: Column, size: int) -> Column:
    """The smallest ``size`` elements of each bin, sorted by bin and hash."""
    hashed = lambda x, j: F.xxhash64(_hash_of(x), _occurrence(kmers, x, j))
    element = lambda x, j: hashed(x, j).bitwiseAND(F.lit(~_PLACE)).bitwiseOR(x.bitwiseAND(F.lit(_PLACE)))
    elements = F.sort_array(F.transform(kmers, element))
    return _let(elements, lambda e: F.filter(e, lambda x, j: (j < size) | (_bin(F.get(e, j - size)) != _bin(x))))


def _tuples(chosen: Column) -> Column:
    """Bin number and 32-bit hash of the bin's elements in text order, as one number a bin."""
    starts = F.filter(
        F.transform(chosen, lambda x, j: F.when((j == 0) | (_bin(F.get(chosen, j - 1)) != _bin(x)), j)), lambda j: j.isNotNull()
    )

    def value(s: Column, at: Column) -> Column:
        stop = F.coalesce(F.get(s, at + 1), F.size(chosen))
        start = F.get(s, at)
        members = F.slice(chosen, start + 1, stop - start)
        placed = F.transform(members, lambda x: F.struct(x.bitwiseAND(F.lit(_PLACE)).alias("place"), _hash_of(x).alias("of")))
        name = F.xxhash64(F.transform(F.sort_array(placed), lambda m: m["of"]))
        return F.shiftleft(_bin(F.get(chosen, start)), 32).bitwiseOR(name.bitwiseAND(F.lit(0xFFFFFFFF)))

    return _let(starts, lambda s: F.transform(s, lambda _, at: value(s, at)))


def fingerprint(text: Column, k: int = K, size: int = TUPLE) -> Column:
    """Order MinHash of a text as an array of longs, one for each bin that has a k-mer; null is taken as empty."""
    whole = F.coalesce(text, F.lit(""))
    return _let(_words(whole), lambda w: _let(_kmers(w, k), lambda m: _let(_selected(m, size), _tuples)))


def as_text(prints: Column) -> Column:
    """Ten hexadecimal digits for each bin: two for its number, eight for its value."""
    return F.array_join(F.transform(prints, lambda x: F.lpad(F.lower(F.hex(x)), 10, "0")), "")


def likeness(one: Column, two: Column) -> Column:
    """Share of the bins used by either that agree, from 0 to 1; two texts without words are alike."""
    bins = lambda p: F.transform(p, lambda x: F.shiftright(x, 32))
    either = F.size(F.array_union(bins(one), bins(two)))
    return F.when(either == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(one, two)) / either)


def with_next(docs: DataFrame, columns: list[str], ranges: int = RANGES) -> DataFrame:
    """Adds ``next_<column>`` of the next document in ascending ``doc_id`` (null first, ties by text hash); the last has the first.

    Ids are cut into ranges at their quantiles; within one, the next row is found by a window, and the last row of a
    range gets the first of the next one.
    """
    cuts = docs.agg(F.percentile_approx("doc_id", [i / ranges for i in range(1, ranges)], 10_000)).first()[0] or []
    cuts = F.array(*(F.lit(c) for c in sorted(set(cuts)))).cast("array<long>")
    rows = docs.withColumn("_range", F.size(F.filter(cuts, lambda c: c < F.coalesce("doc_id", F.lit(-(2**63))))))
    order = F.struct("doc_id", F.xxhash64("text"))
    firsts = rows.groupBy("_range").agg(F.min_by(F.struct(*columns), order).alias("_first"))
    # one row a range
    across = Window.orderBy("_range")
    whole = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    firsts = firsts.select("_range", F.coalesce(F.lead("_first").over(across), F.first("_first").over(whole)).alias("_first"))
    after = Window.partitionBy("_range").orderBy(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    rows = rows.withColumn("_next", F.lead(F.struct(*columns)).over(after)).join(firsts, "_range")
    found = F.coalesce("_next", "_first")
    return rows.select(*docs.columns, *(found[c].alias(f"next_{c}") for c in columns))


def op10_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = with_next(docs.withColumn("prints", fingerprint(F.col("text"))), ["text", "prints"])
    n = F.char_length("text")
    cut = F.floor(n / 4).cast("int")
    rows = rows.withColumn("edited", F.concat(F.substring("text", F.lit(1), n - cut), F.substring("next_text", F.lit(1), cut)))
    rows = rows.withColumn("edited_prints", fingerprint(F.col("edited")))
    return rows.select(
        "doc_id",
        n.cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("prints")).alias("fingerprint"),
        as_text(F.col("edited_prints")).alias("edited_fingerprint"),
        likeness(F.col("prints"), F.col("edited_prints")).alias("near_edited"),
        likeness(F.col("prints"), F.col("next_prints")).alias("near_next"),
    )
