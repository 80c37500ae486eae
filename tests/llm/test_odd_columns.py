"""Columns of any name: no operator fails on one, or loses it."""

import corpus_pipeline
import public_tokenizers
import pytest
from llm_fixtures import corpus, rows_of  # noqa: F401
from pyspark.sql import functions as F

from tablebridge.llm.embedding_dups import embedding_duplicates
from tablebridge.llm.filter_audit import audit, text_filters
from tablebridge.llm.fingerprints import fingerprints, with_next
from tablebridge.llm.licenses import scan
from tablebridge.llm.mixing import mix, mixture_plan
from tablebridge.llm.neardup import deduplicated, near_duplicates
from tablebridge.llm.packing import pack
from tablebridge.llm.quality import QualityModel, score_quality
from tablebridge.llm.samples import labelled_sample
from tablebridge.llm.top_inner import top_inner_products
from tablebridge.llm.toxicity import ToxicModel, score_toxicity
from tablebridge.llm.url_filters import filter_urls
from tablebridge.llm.whitening import whiten

NAMES = (
    "_id _key _row _host _own _path _rule _trust _distrust url_filter mix_of mix_whole mix_copies mix_size mix_target mix_threshold labels base found "
    "n_words _words _copy _range _tie _before _minus _first_tie next_text sketch fingerprint toxicity quality language score node id label key n size cell "
    "part digest mask spread x number stripe query hash odd`name a.b ID"
).split()


@pytest.fixture(scope="module")
def odd(spark, corpus):
    """The documents beside columns of all these names."""
    spark.conf.set("spark.sql.caseSensitive", "true")
    docs = corpus.select("doc_id", "text", "lang", "source")
    yield docs.select("*", *[F.lit(f"value of {name}").alias(name) for name in NAMES])
    spark.conf.set("spark.sql.caseSensitive", "false")


def quoted(name):
    return F.col("`" + name.replace("`", "``") + "`")


def keeps_all(before, after, results):
    """Every row and every value of before is there: under its name, or behind it where a result has the name."""
    names = [f"{c}_before" if c in results else c for c in before.columns]
    assert set(names) <= set(after.columns)
    got = after.select(*[quoted(n).alias(f"c{i}") for i, n in enumerate(names)])
    want = before.toDF(*[f"c{i}" for i in range(len(names))])
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


OPERATORS = {
    "mix": (lambda d: mix(d, mixture_plan(d)), ("mix_copies", "mix_size", "mix_target")),
    "fingerprints": (fingerprints, ("sketch", "fingerprint")),
    "with_next": (lambda d: with_next(d, ["text"]), ("next_text",)),
    "toxicity": (lambda d: score_toxicity(d, ToxicModel(base=0.5)), ("toxicity",)),
    "quality": (lambda d: score_quality(d, QualityModel(base=0.5)), ("quality",)),
    "scan": (scan, ("n_words", "base", "found", "labels")),
    "urls": (lambda d: filter_urls(d, (("allow", "com/"),), url_column="text", html_column="source"), ("url_filter",)),
}


@pytest.mark.parametrize("name", list(OPERATORS))
def test_extra_columns_stay(odd, name):
    run, results = OPERATORS[name]
    keeps_all(odd, run(odd), results)


def test_operators_without_extra_columns(spark, odd):
    ids = odd.count()
    assert near_duplicates(odd).count() == ids and pack(odd, public_tokenizers.path("word_bpe_49k.json")).count() >= ids
    labels = spark.createDataFrame([(i, i % 2, 0, "x") for i in range(50)], "doc_id long, quality int, toxic int, mask string")
    assert audit(odd, text_filters(F.coalesce("text", F.lit(""))), labels).count() > 0
    vectors = odd.select(F.monotonically_increasing_id().alias("vec_id"), F.array(F.rand(1), F.rand(2)).alias("embedding"), *map(quoted, odd.columns))
    assert embedding_duplicates(vectors).count() == ids and whiten(vectors)[0].count() == ids and top_inner_products(vectors, every=10).count() > 0


def test_deduplicated_keeps_the_columns(odd):
    found = deduplicated(odd)
    assert found.columns == odd.columns
    assert all(r["_id"] == "value of _id" and r["a.b"] == "value of a.b" for r in found.collect())


def test_mixing_stage_keeps_the_columns(spark, odd):
    found = corpus_pipeline.mixing(spark, odd, "")
    assert found.columns == odd.columns and all(r["mix_copies"] == "value of mix_copies" for r in found.collect())


def test_a_name_that_is_read_cannot_be_a_result(odd):
    with pytest.raises(ValueError, match="are read here"):
        score_toxicity(odd, ToxicModel(base=0.5), text_column="toxicity")


def test_one_id_of_many_rows_is_one_row_of_the_sample(spark):
    rows = [(i, f"text number {i} has words {i * 7}") for i in range(30)] + [(5, f"other text {i} of five") for i in range(10_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)] + [(5, 1)] * 50, "doc_id long, toxic int")
    found = labelled_sample(docs, labels, "toxic", 30).collect()
    assert len(found) <= 30 and len({r.doc_id for r in found}) == len(found)
