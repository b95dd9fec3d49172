"""Document fingerprints by winnowing, in SQL functions.

Every k-gram of code points is hashed (32 bits), and of each window of ``window`` consecutive hashes the least is kept,
the rightmost among equals, with its position. Two texts that share a run of at least ``window + k - 1`` code points
therefore share a fingerprint. A text is taken as UTF-32, so that a gram is four bytes a code point at a known place,
and in pieces of ``PIECE`` windows, so that the arrays of a long text stay small; pieces overlap by a window, and so
give what the whole text gives.

A hash and its position are one number: the hash above, the distance from the last possible position below. The least
of such numbers is the least hash, and among equal hashes the rightmost. Minima over a window come by doubling: over 2
positions, then 4, 8, ... .

Defined cases: a null text counts as empty; an empty text has no fingerprints; a text shorter than k has one, of the
whole text; a text shorter than a window has the least of its hashes. Two empty sets are alike (1), an empty and
another aren't (0). Documents are ordered by doc_id, nulls as the smallest, equal ids by text; a single document is its
own successor; an empty table gives an empty result; extra columns are left.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelmart.llm.scratch import partitions

K, WINDOW = 16, 32
PIECE = 1 << 15
_LAST = (1 << 31) - 1


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _minima(numbers: Column, window: int) -> Column:
    """At each place the least of the next ``window`` numbers, or of as many as there are."""
    if window == 1:
        return numbers
    half = 1 << (window - 1).bit_length() - 1
    return _let(_minima(numbers, half), lambda m: F.zip_with(m, F.slice(m, window - half + 1, F.size(m)), lambda a, b: F.least(a, b)))


def fingerprints(text: Column, k: int = K, window: int = WINDOW, skipped: Column | None = None) -> Column:
    """The selected numbers, in the order of their windows; positions count from ``skipped`` on."""
    last_place = F.lit(_LAST).cast("long") - (F.lit(0) if skipped is None else skipped)

    def number(wide: Column, at: Column, size: int | Column) -> Column:
        hashed = F.hash(F.substring(wide, at * 4 + 1, size)).cast("long").bitwiseAND(F.lit(0xFFFFFFFF))
        return F.shiftleft(hashed, 31).bitwiseOR(last_place - at)

    def of(wide: Column) -> Column:
        grams = (F.octet_length(wide) / 4).cast("int") - (k - 1)
        starts = F.greatest(grams - (window - 1), F.lit(1))

        def piece(p: Column) -> Column:
            first = p * PIECE
            last = F.least(first + (PIECE + window - 2), grams - 1)
            hashed = F.transform(F.sequence(first, last), lambda i: number(wide, i, 4 * k))
            return _let(hashed, lambda h: F.array_distinct(F.slice(_minima(h, window), 1, F.least(F.lit(PIECE), starts - first))))

        whole = F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(0), ((starts - 1) / PIECE).cast("int")), piece)))
        short = F.array(number(wide, F.lit(0), F.octet_length(wide)))
        return F.when(grams > 0, whole).when(F.octet_length(wide) > 0, short).otherwise(F.array().cast("array<long>"))

    return _let(F.encode(F.coalesce(text, F.lit("")), "UTF-32"), of)


def refingerprinted(text: Column, kept: Column, before: Column, k: int = K, window: int = WINDOW) -> Column:
    """The fingerprint of a text whose first ``kept`` code points are those of a text with the fingerprint ``before``.

    Windows inside the kept part select what they selected before. A number whose place is below the count of those
    windows was selected by one of them, and the windows too early for the computation below select no others; so only
    the windows that reach into the new part, and as many before them as one holds, are hashed again.
    """

    def of(inside: Column) -> Column:
        skipped = F.greatest(inside - window, F.lit(0))  # what is left holds a whole window
        same = F.filter(before, lambda x: F.lit(_LAST).cast("long") - x.bitwiseAND(F.lit(_LAST).cast("long")) < inside)
        return F.array_distinct(F.concat(same, fingerprints(F.substr(text, skipped + 1), k, window, skipped)))

    return _let(kept - (k + window - 2), of)  # counted once, not for every gram


def hashes(fingerprint: Column) -> Column:
    return F.transform(fingerprint, lambda x: F.shiftright(x, 31))


def positions(fingerprint: Column) -> Column:
    return F.transform(fingerprint, lambda x: F.lit(_LAST) - x.bitwiseAND(F.lit(_LAST).cast("long")))


def as_text(fingerprint: Column) -> Column:
    """hash@position of each, in hexadecimal."""
    return F.array_join(F.transform(fingerprint, lambda x: F.concat(F.hex(F.shiftright(x, 31)), F.lit("@"), F.hex(F.lit(_LAST) - x.bitwiseAND(F.lit(_LAST).cast("long"))))), " ")


def likeness(a: Column, b: Column) -> Column:
    """Shared hashes among all hashes of two fingerprints."""
    joint = F.size(F.array_union(a, b))
    return F.when(joint == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / joint)


def with_next(docs: DataFrame, columns: list[str]) -> DataFrame:
    """The rows with ``next_<column>`` of the document of the next smaller doc_id; the smallest is followed by the greatest.

    doc_id is cut into ranges of about equal rows, each ordered by itself. The greatest rows of a range also stand at the
    end of the range above it, so that its last row has a successor; only the ranges' bounds are known to the driver.
    """
    spark = docs.sparkSession
    ranges = min(1024, 4 * partitions(spark))
    least = F.lit(-(1 << 63)).cast("long")
    rows = docs.withColumn("_key", F.coalesce(F.col("doc_id").cast("long"), least))
    points = rows.select("_key").agg(F.percentile_approx("_key", [i / ranges for i in range(1, ranges)], 10 * ranges)).first()[0]
    bounds = F.array(*(F.lit(b).cast("long") for b in sorted(set(points or []))))
    rows = rows.withColumn("_range", F.size(F.filter(bounds, lambda b: b < F.col("_key"))))
    greatest = {r["_range"]: r["top"] for r in rows.groupBy("_range").agg(F.max("_key").alias("top")).collect()}
    if not greatest:
        return docs.select("*", *(F.col(c).alias(f"next_{c}") for c in columns))
    used = sorted(greatest)
    above = {b: used[(i + 1) % len(used)] for i, b in enumerate(used)}  # the greatest range is followed by the least
    pairs = [F.lit(x) for b in used for x in (b, F.struct(F.lit(greatest[b]).alias("top"), F.lit(above[b]).alias("above")))]
    of = F.create_map(*pairs)[F.col("_range")]
    here = F.struct(F.lit(False).alias("guest"), F.col("_range").alias("range"))
    there = F.struct(F.lit(True).alias("guest"), of["above"].alias("range"))
    rows = rows.withColumn("_at", F.explode(F.when(F.col("_key") == of["top"], F.array(here, there)).otherwise(F.array(here))))
    order = Window.partitionBy("_at.range").orderBy("_at.guest", F.desc("_key"), "text")
    rows = rows.select("*", *(F.lead(c).over(order).alias(f"next_{c}") for c in columns))
    return rows.where("not _at.guest").drop("_key", "_range", "_at")


def edited(text: Column, next_text: Column) -> Column:
    """The text with its last third replaced by as many code points from the beginning of the next one."""
    n = F.char_length(text)
    third = F.floor(n / 3).cast("int")
    return F.concat(F.left(text, n - third), F.left(next_text, third))


def compared(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited, fingerprint, edited_fingerprint (arrays), near_edited, near_next of every document."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = with_next(rows.withColumn("fingerprint", fingerprints(F.col("text"))), ["text", "fingerprint"])
    kept = F.char_length("text") - F.floor(F.char_length("text") / 3).cast("int")
    rows = rows.withColumn("edited", edited(F.col("text"), F.col("next_text")))
    rows = rows.withColumn("edited_fingerprint", refingerprinted(F.col("edited"), kept, F.col("fingerprint")))
    own, other, after = (hashes(F.col(c)) for c in ("fingerprint", "edited_fingerprint", "next_fingerprint"))
    return rows.select(
        "doc_id",
        F.char_length("text").cast("long").alias("n_chars"),
        "edited",
        "fingerprint",
        "edited_fingerprint",
        likeness(own, other).alias("near_edited"),
        likeness(own, after).alias("near_next"),
    )
