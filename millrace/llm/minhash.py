"""Document fingerprints: one-permutation MinHash with optimal densification, kept as four-bit numbers."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

BINS = 256
BITS = 4        # of each bin's value that are kept: one hexadecimal digit
WORDS = 5       # of a shingle
PROBES = 8      # tries of an empty bin before all full bins are ranked for it
SPACE = "[\\x20\\x09-\\x0D]+"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once per row, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def shingle_hashes(text: Column, words: int = WORDS) -> Column:
    """A 64-bit hash of every run of ``words`` words, repeats included; fewer words make one shingle, none make none."""
    parts = F.filter(F.split(text, SPACE), lambda w: w != "")

    def runs(hashes: Column) -> Column:
        n = F.size(hashes)
        all_of = F.aggregate(hashes, F.lit(42).cast("bigint"), lambda a, h: F.xxhash64(a, h))
        each = F.transform(F.sequence(F.lit(0), n - words),
                           lambda i: F.xxhash64(*(F.get(hashes, i + k) for k in range(words))))
        return F.when(n >= words, each).when(n > 0, F.array(all_of)).otherwise(F.array().cast("array<bigint>"))

    return let(F.transform(parts, lambda w: F.xxhash64(w)), runs)


def _bin(value: Column) -> Column:
    return F.shiftrightunsigned(value, 64 - int(math.log2(BINS))).cast("int")


def bins(hashes: Column) -> Column:
    """BINS numbers of BITS bits each; an empty array if there is no hash.

    A hash falls into the bin that its leading bits name, and a bin keeps its
    smallest.  An empty bin takes the value of the first full one in an order of
    its own: PROBES hashed tries, then all by a second hash.  So two texts fill
    it alike wherever their full bins agree.
    """
    def first_of_bin(ordered: Column) -> Column:
        # Sorted hashes of a bin stand together, its smallest in front.
        return F.filter(ordered, lambda h, i: (i == 0) | (_bin(h) != _bin(F.get(ordered, i - 1))))

    def filled(mins: Column) -> Column:
        low = F.transform(mins, lambda h: h.bitwiseAND(F.lit((1 << BITS) - 1)).cast("int"))
        by_bin = F.map_from_arrays(F.transform(mins, _bin), low)

        def all_bins(own: Column) -> Column:
            def value(b: Column) -> Column:
                tries = [F.get(own, F.pmod(F.xxhash64(b, F.lit(t)), F.lit(BINS)).cast("int")) for t in range(PROBES)]
                last = F.array_min(F.transform(mins, lambda h: F.struct(
                    F.xxhash64(b, _bin(h), F.lit(PROBES)).alias("rank"),
                    h.bitwiseAND(F.lit((1 << BITS) - 1)).cast("int").alias("low"))))["low"]
                return F.coalesce(F.get(own, b), *tries, last)

            return F.transform(F.sequence(F.lit(0), F.lit(BINS - 1)), value)

        dense = let(let(by_bin, lambda m: F.transform(F.sequence(F.lit(0), F.lit(BINS - 1)),
                                                      lambda b: F.try_element_at(m, b))), all_bins)
        return F.when(F.size(mins) == 0, F.array().cast("array<int>")).otherwise(dense)

    return let(let(F.sort_array(hashes), first_of_bin), filled)


def packed(values: Column) -> Column:
    """The bins as a hexadecimal string, one digit each."""
    return F.array_join(F.transform(values, lambda v: F.lower(F.hex(v))), "")


def likeness(a: Column, b: Column) -> Column:
    """The estimated share of common shingles, 0 to 1.

    Bins of unlike texts agree by chance once in 2^BITS; that is taken off.
    Two texts without shingles are alike, one without and one with are not.
    """
    equal = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda same: same)) / F.lit(float(BINS))
    chance = 2.0 ** -BITS
    both = F.greatest(F.lit(0.0), (equal - chance) / (1 - chance))
    return (F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0)
            .when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(both))


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fingerprint) of every whole text; a null text is an empty one, whose fingerprint is empty."""
    return docs.select(F.col(key), packed(bins(shingle_hashes(F.coalesce(text, F.lit(""))))).alias("fingerprint"))


def _cuts(docs: DataFrame, at: Column) -> tuple[int | None, list[int]]:
    """The smallest place, and places of about equal numbers of rows between: some per shuffle partition."""
    n = 8 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / n for i in range(1, n)]
    row = docs.select(at.alias("at")).agg(
        F.min("at"), F.percentile_approx("at", shares, 10 * n).alias("cuts")).first()
    return row[0], sorted({c for c in row[1] or [] if c > row[0]})


def with_next(docs: DataFrame, key: str, carry: list[str]) -> tuple[DataFrame, Callable[[str], Column]]:
    """``docs`` dealt so that each row stands in one window with the row that follows it by ``key``.

    Returns rows (key, carry..., own) and a function that gives the next row's
    value of a column; the last row is followed by the first.  Rows with
    ``own`` false are the first of the next stretch, there to be looked at, and
    must be dropped afterwards.  The stretches are cut at existing keys, so one
    shuffle is enough, and no window holds more than a stretch.  Null keys come
    first; rows of one key stand by their carried columns.
    """
    at = F.coalesce(F.col(key), F.lit(-(1 << 63)))
    least, cuts = _cuts(docs, at)
    group = max(1, math.isqrt(len(cuts)))
    literal = F.split(F.lit(",".join(map(str, cuts))), ",").cast("array<bigint>") if cuts else None
    tops = F.split(F.lit(",".join(map(str, cuts[::group]))), ",").cast("array<bigint>") if cuts else None

    def stretch(of: Column) -> Column:
        if not cuts:
            return F.lit(0)
        block = F.size(F.filter(tops, lambda c: c <= of))
        inside = F.size(F.filter(F.slice(literal, F.greatest(block - 1, F.lit(0)) * group + 1, group), lambda c: c <= of))
        return F.when(block == 0, 0).otherwise((block - 1) * group + inside)

    rows = docs.select(F.col(key), *carry, at.alias("_at")).withColumn("_stretch", stretch(F.col("_at")))
    begins = F.get(literal, F.col("_stretch") - 1) == F.col("_at") if cuts else F.lit(False)
    places = F.array_compact(F.array(
        F.struct(F.col("_stretch").alias("s"), F.lit(True).alias("own")),
        F.when((F.col("_stretch") > 0) & begins, F.struct((F.col("_stretch") - 1).alias("s"), F.lit(False).alias("own"))),
        F.when(F.col("_at") == F.lit(least), F.struct(F.lit(len(cuts)).alias("s"), F.lit(False).alias("own")))))
    dealt = rows.withColumn("_place", F.explode(places)).select(
        F.col(key), *carry, "_at", F.col("_place.s").alias("_stretch"), F.col("_place.own").alias("own"))
    window = Window.partitionBy("_stretch").orderBy(F.col("own").desc(), "_at", *carry)
    return dealt, lambda column: F.lead(column).over(window)


def edited_fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they are.

    The edited text has the last half of the code points (rounded down)
    replaced by the first as many (or all) of the next document's, by ascending
    key; after the last comes the first.  Returns key, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited and near_next (the likeness to
    the next document).  A null text is an empty one; every row gives a row.
    """
    named = docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    dealt, following = with_next(named, key, ["_text"])
    n, half = F.char_length("_text"), F.floor(F.char_length("_text") / 2).cast("int")
    paired = dealt.withColumn("_next", following("_text")).withColumn(
        "_edited", F.concat(F.expr("substring(_text, 1, char_length(_text) - int(floor(char_length(_text) / 2)))"),
                            F.substring(F.coalesce("_next", F.lit("")), F.lit(1), half)))
    made = paired.select(
        key, "own", "_at", "_stretch", "_text", n.cast("bigint").alias("n_chars"),
        F.sha2("_edited", 256).alias("edited_sha256"), bins(shingle_hashes(F.col("_text"))).alias("_bins"),
        bins(shingle_hashes(F.col("_edited"))).alias("_edited_bins"))
    return made.withColumn("_next_bins", following("_bins")).filter("own").select(
        key, "n_chars", "edited_sha256", packed(F.col("_bins")).alias("fingerprint"),
        packed(F.col("_edited_bins")).alias("edited_fingerprint"),
        likeness(F.col("_bins"), F.col("_edited_bins")).alias("near_edited"),
        likeness(F.col("_bins"), F.col("_next_bins")).alias("near_next"))
