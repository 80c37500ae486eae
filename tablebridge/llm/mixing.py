"""Mixing sources to target weights (2), in DataFrame functions only.

Every document has a uniform 60-bit hash of its id. A source takes each document a whole number of times, and once more
where the hash lies below the source's threshold, so a larger budget only ever adds documents. The threshold comes from
histograms: sizes summed by source and by ten bits of the hash, the bucket in which the budget ends, then the same again
inside that bucket alone. Six rounds use up all bits; most corpora need two or three. Nothing is sorted but the 1,024
buckets of one source, and a hot source is summed before it is shuffled.

Defined cases: a null text has size 0; a null source is a source of its own and comes last; documents of one id share a
hash and so a fate (all null ids are one id); the last hash is taken when that brings the source nearer its target; a
source of size 0 has target 0; extra columns pass through. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablebridge.llm.common import WORD, apart, fresh, kept, spread

BITS, STEP = 60, 10
RESULTS = ("mix_copies", "mix_size", "mix_target")


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sources: DataFrame, weights: tuple[float, ...], total: float | None, most: int) -> DataFrame:
    """``source, source_size`` with ``target``: the total shared by weight, stopping at ``most`` times a source's size.

    What is over is shared again by weight until none is above, which comes to one level L with min(most * size, L * weight)
    for every source: sources reach their stop in order of size over weight, so one pass in that order finds L.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    numbered = sources.withColumn("nth", F.row_number().over(by_name) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("nth") % len(weights) + 1).cast("int"))
    weighted = numbered.select("source", "source_size", weight.alias("weight"))
    full = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before, after = full.rowsBetween(Window.unboundedPreceding, -1), full.rowsBetween(0, Window.unboundedFollowing)
    everything = F.sum("source_size").over(Window.partitionBy()) if total is None else F.lit(total)
    left = everything - F.coalesce(F.sum("source_size").over(before), F.lit(0)) * most
    levels = weighted.withColumns(
        {"level": left.cast("double") / F.sum("weight").over(after), "nth": F.row_number().over(full)}
    )
    enough = F.col("level") * F.col("weight") <= F.col("source_size") * most
    level = F.min(F.when(enough, F.struct("nth", "level"))).over(Window.partitionBy())["level"]
    stop = (F.col("source_size") * most).cast("double")
    target = F.coalesce(F.least(stop, level * F.col("weight")), stop)
    return levels.select("source", "source_size", "weight", target.alias("target"))


def mixture_plan(
    docs: DataFrame,
    weights: tuple[float, ...] = (5.0, 2.0, 1.0),
    total: float | None = None,
    most: int = 3,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
) -> DataFrame:
    """One row per source: source_size, weight, target, ``copies`` of each document, and the hash below which one more.

    ``weights`` go to the sources in the order of their names, over and over. ``total`` is the mixture's size, by default
    that of the corpus; it cannot be above ``most`` times that.
    """
    sized = kept(
        docs.select(
            F.col(source_column).cast("string").alias("source"),
            n_words(F.col(text_column)).alias("size"),
            spread(id_column).alias("hash"),
        ),
        "mixing-sizes",
    )
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sources, weights, total, most)
    whole = F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(most))).otherwise(0)
    state = kept(
        targets.withColumn("copies", whole.cast("long")).select(
            "*",
            (F.col("target") - F.col("copies") * F.col("source_size")).alias("left"),
            F.lit(0).cast("long").alias("prefix"),
        ),
        "mixing-targets",
    )
    open_rows = sized.filter(F.col("size") > 0)
    for used in range(0, BITS, STEP):
        shift = BITS - used - STEP
        wanted = state.select(F.col("source").alias("of"), "prefix", "left")
        inside = open_rows.join(
            wanted,
            F.col("source").eqNullSafe(F.col("of")) & (F.shiftright("hash", shift + STEP) == F.col("prefix")),
        )
        sums = inside.groupBy("source", "left", F.shiftright("hash", shift).alias("bucket")).agg(
            F.sum("size").alias("size"), F.min("hash").alias("low"), F.max("hash").alias("high")
        )
        upwards = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        run = sums.withColumn("up_to", F.sum("size").over(upwards))
        # The first bucket that the budget does not cover; a budget that covers all has none, and its threshold is the end.
        bound = (
            run.filter(F.col("up_to") > F.col("left"))
            .groupBy("source")
            .agg(F.min(F.struct("bucket", "up_to", "size", "low", "high")).alias("b"))
            .select(F.col("source").alias("of"), "b")
        )
        state = kept(
            state.join(bound, F.col("source").eqNullSafe(F.col("of")), "left").select(
                "source",
                "source_size",
                "weight",
                "target",
                "copies",
                F.when(F.col("b").isNull(), F.col("left")).otherwise(F.col("left") - F.col("b.up_to") + F.col("b.size")).alias("left"),
                F.when(F.col("b").isNull(), F.shiftleft(F.col("prefix"), STEP) + (1 << STEP) - 1)
                .otherwise(F.col("b.bucket"))
                .alias("prefix"),
                F.col("b.size").alias("last_size"),
                F.col("b.low").alias("last_low"),
                F.col("b.high").alias("last_high"),
            ),
            "mixing-thresholds",
        )
        if state.filter(F.col("last_low") < F.col("last_high")).isEmpty():
            break
    one_more = F.col("left") * 2 >= F.col("last_size")
    threshold = (
        F.when(F.col("copies") >= most, F.lit(0))  # at the stop already, documents without words included
        .when(F.col("last_low").isNull(), F.lit(1 << BITS))
        .when(one_more, F.col("last_low") + 1)
        .otherwise(F.col("last_low"))
    )
    return state.select(
        "source", "source_size", "weight", "target", "copies", threshold.cast("long").alias("threshold")
    )


def mix(docs: DataFrame, plan: DataFrame, id_column: str = "doc_id", source_column: str = "source") -> DataFrame:
    """``docs`` with ``mix_copies``, how often the mixture takes the row, and its source's ``mix_size`` and ``mix_target``."""
    docs = apart(docs, *RESULTS, keep=(id_column, source_column))
    of, whole, threshold = fresh(docs, "mix_of", "mix_whole", "mix_threshold")
    sources = plan.select(
        F.col("source").alias(of),
        F.col("source_size").alias("mix_size"),
        F.col("target").alias("mix_target"),
        F.col("copies").alias(whole),
        F.col("threshold").alias(threshold),
    )
    copies = F.col(whole) + F.when(spread(id_column) < F.col(threshold), 1).otherwise(0)
    return (
        docs.join(sources, docs[source_column].cast("string").eqNullSafe(F.col(of)), "left")
        .withColumn("mix_copies", copies)
        .drop(of, whole, threshold)
    )
