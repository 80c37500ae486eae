"""Document fingerprints (3): threshold-scaled sketches of word shingles, in DataFrame functions only.

A sketch keeps every shingle hash below a fixed fraction of the hash range, so its size follows the document's. Two
sketches of any two documents are samples of the same hashes: their union is the sketch of both texts together, and the
share of one found in the other estimates containment however unequal the lengths are.

A sketch also keeps a document's lowest few hashes, wherever they lie, so that short texts are held whole. Each sketch is
complete up to a bound of its own (:func:`complete_to`), and two are compared up to the smaller bound. So two short texts,
or a text and its edited version, are compared exactly; a short text without a hash below the fraction is unlike any long
one, as what the long one has up there is not known (a third of all texts of 8 shingles).

Defined cases: a null text is an empty one; a text with fewer words than a shingle has one shingle, the whole sequence; a
text without words has an empty sketch, alike (1.0) to another empty one and unlike (0.0) to any other; repeated rows are
rows of their own; null ids come last in a chain; extra columns pass through. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablebridge.functions.paths import quote
from tablebridge.llm.common import WORD, apart, bound, fresh

LOWEST = -(1 << 63)
FRACTION, LEAST = 0.125, 16


def shingle_hashes(text: Column, words: int) -> Column:
    """Hashes of the runs of ``words`` words, in order, repeats kept."""
    each = F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"({WORD})")), lambda w: F.xxhash64(w))
    run = lambda h: F.transform(
        F.sequence(F.lit(0), F.greatest(F.size(h) - words, F.lit(0))),
        lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(words)]),
    )
    return bound(each, lambda h: F.when(F.size(h) > 0, run(h)).otherwise(F.array().cast("array<long>")))


def sketch(text: Column, fraction: float = FRACTION, words: int = 5, least: int = LEAST) -> Column:
    """Sorted distinct shingle hashes in the lowest ``fraction`` of the range, and at least the ``least`` lowest ones."""
    limit = LOWEST + int(fraction * (1 << 64))

    def small(hashes: Column) -> Column:
        below = F.array_sort(F.array_distinct(F.filter(hashes, lambda h: h < F.lit(limit))))
        return bound(below, lambda b: F.when(F.size(b) >= least, b).otherwise(F.slice(F.array_sort(F.array_distinct(hashes)), 1, least)))

    return bound(shingle_hashes(text, words), small)


def complete_to(hashes: Column, fraction: float = FRACTION, least: int = LEAST) -> Column:
    """The largest number up to which a sketch holds every hash of its text."""
    limit = LOWEST + int(fraction * (1 << 64)) - 1
    return F.when(F.size(hashes) < least, F.lit(-LOWEST - 1)).otherwise(F.greatest(F.element_at(hashes, -1), F.lit(limit)))


def _comparable(left: Column, right: Column, fraction: float, least: int, body) -> Column:
    """``body`` of both sketches up to the smaller of their bounds."""
    to = F.least(complete_to(left, fraction, least), complete_to(right, fraction, least))
    cut = lambda hashes: F.filter(hashes, lambda h: h <= to)
    return bound(F.struct(cut(left).alias("l"), cut(right).alias("r")), lambda both: body(both["l"], both["r"]))


def merged(left: Column, right: Column, fraction: float = FRACTION, least: int = LEAST) -> Column:
    """The sketch of two texts together."""
    return _comparable(left, right, fraction, least, lambda a, b: F.array_sort(F.array_union(a, b)))


def containment(part: Column, whole: Column, fraction: float = FRACTION, least: int = LEAST) -> Column:
    """Estimated share of the shingles of ``part`` that ``whole`` has; two empty sketches hold one another."""
    share = lambda a, b: F.when(F.size(a) > 0, F.size(F.array_intersect(a, b)) / F.size(a)).otherwise(0.0)
    return F.when(F.size(part) == 0, (F.size(whole) == 0).cast("double")).otherwise(_comparable(part, whole, fraction, least, share))


def likeness(left: Column, right: Column, fraction: float = FRACTION, least: int = LEAST) -> Column:
    """Containment of the smaller sketch in the larger one, which does not suffer from unequal lengths."""

    def share(a: Column, b: Column) -> Column:
        few = F.least(F.size(a), F.size(b))
        return F.when(few > 0, F.size(F.array_intersect(a, b)) / few).otherwise(0.0)

    empty = (F.size(left) == 0) | (F.size(right) == 0)
    return F.when(empty, (F.size(left) == F.size(right)).cast("double")).otherwise(_comparable(left, right, fraction, least, share))


def resemblance(left: Column, right: Column, fraction: float = FRACTION, least: int = LEAST) -> Column:
    """Estimated Jaccard similarity."""

    def share(a: Column, b: Column) -> Column:
        union = F.size(F.array_union(a, b))
        return F.when(union > 0, F.size(F.array_intersect(a, b)) / union).otherwise(0.0)

    both = (F.size(left) == 0) & (F.size(right) == 0)
    return F.when(both, F.lit(1.0)).otherwise(_comparable(left, right, fraction, least, share))


def fingerprint(hashes: Column) -> Column:
    """A sketch as text: 16 hexadecimal digits a hash."""
    return F.array_join(F.transform(hashes, lambda h: F.lower(F.lpad(F.hex(h), 16, "0"))), "")


def hashes_of(fingerprint_text: Column) -> Column:
    """The sketch that a fingerprint was made of."""
    at = F.sequence(F.lit(0), (F.length(fingerprint_text) / 16).cast("int") - 1)
    digits = lambda i: F.substring(fingerprint_text, i * 16 + 1, F.lit(16))
    read = F.transform(at, lambda i: F.conv(digits(i), 16, -10).cast("long"))
    return F.when(F.length(fingerprint_text) > 0, read).otherwise(F.array().cast("array<long>"))


def with_next(
    docs: DataFrame,
    columns: list[str],
    id_column: str = "doc_id",
    rows_per_range: int = 2_000,
    most_ranges: int = 4_096,
) -> DataFrame:
    """``docs`` with ``next_<column>``: what the next smaller id has there; the smallest id gets that of the largest.

    Ids are cut into ranges by their quantiles, so one shuffle by range suffices and all ranges are alike in size. Only
    the first row of each range is needed elsewhere: a copy of it closes the range before. The driver sees bounds and
    first ids, at most ``most_ranges`` of each. Rows of one id stand in the order of a hash of what they lead with.
    """
    spark = docs.sparkSession
    docs = apart(docs, *[f"next_{c}" for c in columns], keep=(id_column, *columns))
    own, group, tie, copied, before, minus, first_tie = fresh(docs, "_id", "_range", "_tie", "_copy", "_before", "_minus", "_first_tie")
    ids = docs.select(F.col(id_column).cast("long").alias("id"))
    many = min(most_ranges, max(8, -(-ids.count() // rows_per_range)))
    shares = [i / many for i in range(1, many)]
    cuts = ids.agg(F.percentile_approx("id", shares, max(10_000, 20 * many)).alias("cuts")).first().cuts
    # Ranges count from the largest id on; null ids are a range of their own behind them.
    bounds = sorted(set(cuts or []), reverse=True)
    place = F.size(F.filter(F.array(*[F.lit(x).cast("long") for x in bounds]), lambda x: x > F.col(own)))
    placed = docs.withColumn(own, F.col(id_column).cast("long")).withColumns(
        {
            group: F.when(F.col(own).isNull(), F.lit(len(bounds) + 1)).otherwise(place if bounds else F.lit(0)),
            tie: F.xxhash64(*columns),
        }
    )
    firsts = (
        placed.select(F.col(group).alias("range"), F.struct((-F.col(own)).alias("id"), F.col(tie).alias("tie")).alias("first"))
        .groupBy("range")
        .agg(F.min("first").alias("first"))
        .collect()
    )
    firsts = sorted((row["range"], row["first"].id, row["first"].tie) for row in firsts)
    follows = [(this[0], *after[1:]) for this, after in zip(firsts, firsts[1:] + firsts[:1])]
    wanted = spark.createDataFrame(follows, f"{before} int, {minus} long, {first_tie} long")
    copies = (
        placed.join(F.broadcast(wanted), (-F.col(own)).eqNullSafe(F.col(minus)) & (F.col(tie) == F.col(first_tie)))
        .withColumn(group, F.col(before))
        .select(*[F.col(quote(c)) for c in placed.columns], F.lit(1).alias(copied))
    )
    order = [F.col(copied), F.col(own).desc_nulls_last(), F.col(tie)]
    within = Window.partitionBy(group).orderBy(*order)
    both = placed.withColumn(copied, F.lit(0)).unionByName(copies)
    led = both.withColumns({f"next_{c}": F.lead(c).over(within) for c in columns})
    return led.filter(F.col(copied) == 0).drop(own, group, tie, copied)


def edited(text: Column, other: Column) -> Column:
    """``text`` with its last floor(n / 2) code points replaced by the first as many of ``other``."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(other, F.lit(1), half))


def fingerprints(
    docs: DataFrame, fraction: float = FRACTION, words: int = 5, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``docs`` with ``sketch`` and ``fingerprint``, its text form."""
    made = apart(docs, "sketch", "fingerprint", keep=(id_column, text_column)).withColumn("sketch", sketch(F.col(text_column).cast("string"), fraction, words))
    return made.withColumn("fingerprint", fingerprint(F.col("sketch")))
