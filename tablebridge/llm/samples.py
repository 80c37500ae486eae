"""Bounded, duplicate-free samples of labelled documents to fit classifiers on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablebridge.llm.common import kept
from tablebridge.llm.fingerprints import shingle_hashes


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    rows: int,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """(doc_id, text, label, fold): at most ``rows`` labelled documents, of which near copies have been left out.

    An id with several rows brings one of their texts, the one of the least hash.

    The rows are those of the smallest hashes of the id, so another run takes the same. A document of several labels
    counts as 1 if any is 1; null labels and ids do not count. Copies would make their chance words look telling, so a
    document that agrees with an earlier one in any of four MinHash values is left out. ``fold`` (0 to 4) is by hash.
    What the driver sees is at most ``rows`` ids with four numbers each, and the broadcast side has at most ``rows`` ids.
    """
    spark = docs.sparkSession
    chosen = (
        labels.select(F.col(id_column).cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
        .dropna()
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    chosen = kept(chosen, "labels-chosen")
    texts = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text")
    )
    hashes = shingle_hashes(F.col("text"), 3)
    # One text for each id, the same in every run: an id that a table repeats without end is one row of the sample.
    single = F.min_by("text", F.struct(F.xxhash64("text"), F.col("text"))).alias("text")
    sample = (
        texts.join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id", "label")
        .agg(single)
        .withColumn("hashes", hashes)
        .withColumn("again", F.transform("hashes", lambda h: F.xxhash64(h, F.lit(1))))
        .select(
            "doc_id",
            "text",
            "label",
            F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(5)).cast("int").alias("fold"),
            *[f(c).alias(f"key{i}") for i, (f, c) in enumerate((f, c) for f in (F.array_min, F.array_max) for c in ("hashes", "again"))],
        )
    )
    sample = kept(sample, "labels-sample")
    seen: set[tuple[int, int]] = set()
    single = []
    for row in sample.drop("text", "label", "fold").orderBy(F.xxhash64("doc_id"), "doc_id").toLocalIterator():
        keys = {(i, key) for i, key in enumerate(row[1:]) if key is not None}
        if not keys & seen:
            single.append((row.doc_id,))
        seen |= keys
    wanted = spark.createDataFrame(single, "doc_id long").distinct()
    return sample.join(F.broadcast(wanted), "doc_id").select("doc_id", "text", "label", "fold")


def logistic(x, y, ridge: float = 1e-2, rounds: int = 50):
    """Weights and intercept of a ridge logistic regression by Newton steps; for a few columns and a bounded sample."""
    import numpy as np

    design = np.column_stack([x, np.ones(len(y))])
    beta = np.zeros(design.shape[1])
    penalty = np.eye(len(beta)) * ridge * max(1, len(y)) * 1e-2
    penalty[-1, -1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        slope = design.T @ (p - y) + penalty @ beta
        bend = (design * (p * (1 - p) + 1e-9)[:, None]).T @ design + penalty
        step = np.linalg.solve(bend, slope)
        beta -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return beta
