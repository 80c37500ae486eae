"""The corpus pipeline: toxic and poor documents go, one of each near-duplicate group stays, the rest is mixed and packed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablebridge.llm import registered
from tablebridge.llm.common import fresh, held_out, kept, read
from tablebridge.llm.mixing import RESULTS, mix, mixture_plan
from tablebridge.llm.neardup import deduplicated
from tablebridge.llm.packing import pack
from tablebridge.llm.quality import fit_quality, score_quality
from tablebridge.llm.toxicity import fit_toxicity, score_toxicity


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels to learn from; a fifth of them is held out, as in the operators' own queries."""
    return read(spark, sf_dir, "labels").filter(~held_out("doc_id", 5, 0))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below 0.5."""
    model = fit_toxicity(docs, _labels(spark, sf_dir))
    (result,) = fresh(docs, "_toxicity")
    return score_toxicity(docs, model, result=result).filter(F.col(result)["score"] < 0.5).drop(result)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is 0.3 or more."""
    model = fit_quality(docs, _labels(spark, sf_dir))
    (result,) = fresh(docs, "_quality")
    return score_quality(docs, model, result=result).filter(F.col(result)["score"] >= 0.3).drop(result)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at a similarity of 0.8."""
    return deduplicated(docs, words=5, percent=80)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them, up to three times; those it does not take go."""
    mixed = mix(docs, mixture_plan(docs))
    often = F.sequence(F.lit(1).cast("long"), F.col("mix_copies"))
    (copy,) = fresh(mixed, "_copy")
    # A column that has the name of a result was moved aside and gets its name back: columns keep their places.
    each = mixed.filter("mix_copies > 0").withColumn(copy, F.explode(often)).drop(copy, *RESULTS)
    return each.toDF(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, laid into windows of 2048 tokens."""
    return pack(docs, registered.PACKING_TOKENIZER)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("mixing", mixing),
    ("packing", packing),
]
# Learnt scores, hash sketches and a tokenizer have no SQL; the tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage in turn over ``documents``; each result is written to the shared scratch folder and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = kept(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
