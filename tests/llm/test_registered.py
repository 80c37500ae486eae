"""The registered queries: against their SQL where there is one, and their contracts on the driver's tables."""

import re
import zlib

import corpus_pipeline
import oracle
import pytest

import __spark_entry__ as entry
from tablebridge.llm.registered import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_urls": {"page_id", "host", "path", "rule", "verdict"},
    "op2_mixing": {"doc_id", "size", "source_size", "target", "taken"},
    "op3_fingerprints": {"doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"},
    "op4_minhash": {"doc_id", "n_shingles", "component_id", "kept"},
    "op5_toxicity": {"doc_id", "held_out", "score", "predicted"},
    "op6_packing": {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"},
    "op7_quality": {"doc_id", "held_out", "score", "predicted"},
    "op8_embeddings": {"vec_id", "n_links", "component_id", "kept"},
    "op9_language": {"doc_id", "held_out", "lang_pred", "score"},
    "op10_licenses": {"doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"},
    "op11_audit": set("part filter_order step kept removed redundant unique_fails good_lost toxic_lost shapley".split()),
    "op12_whitening": {"vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"},
    "op13_search": {"query_id", "rank", "vec_id", "score"},
}
TABLES = {"op1_urls": "pages", "op8_embeddings": "embeddings", "op12_whitening": "embeddings"}
SEVERAL = ("op6_packing", "op12_whitening")  # rows for each row of the table


@pytest.fixture(scope="module")
def db():
    return oracle.connect(SF_DIR)


def test_all_are_registered():
    assert set(QUERIES) == set(COLUMNS) and {*COLUMNS, "pipeline"} <= set(entry.queries())
    assert set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_oracle(spark, db, name):
    assert oracle.compare(QUERIES[name](spark, SF_DIR), db, ORACLES[name]) == []


@pytest.mark.parametrize("name", [name for name in COLUMNS if name not in ORACLES])
def test_contract(spark, name):
    rows = QUERIES[name](spark, SF_DIR).collect()
    assert COLUMNS[name] <= set(rows[0].asDict())
    table = spark.read.parquet(f"{SF_DIR}/{TABLES.get(name, 'documents')}.parquet").collect()
    if name not in SEVERAL:
        assert sorted(r[0] for r in rows) == sorted(r[0] for r in table)
    for r in rows:
        if "held_out" in COLUMNS[name]:
            parts, part = (4, 2) if name == "op9_language" else (5, 0)
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % parts == part)
        if "score" in COLUMNS[name]:
            assert 0 <= r.score <= 1
        if "predicted" in COLUMNS[name]:
            assert r.predicted == int(r.score >= (0.5 if name == "op5_toxicity" else 0.3))
        if name == "op3_fingerprints":
            assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 and re.fullmatch("[0-9a-f]{64}", r.edited_sha256)


def test_pipeline_stages(spark):
    """Each stage keeps the columns, only ever drops or repeats rows, and hands on what the next one packs in full."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").persist()
    labels = {r.doc_id: r for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    before = {r.doc_id: r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_DIR).persist()
        rows = docs.collect()
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert all(before[r.doc_id] == r for r in rows) and rows
        gone = set(before) - {r.doc_id for r in rows}
        if name == "toxicity":
            # So few labels hardly teach what is toxic, but clean documents must stay.
            assert sum(1 - labels[i].toxic for i in gone if i in labels) <= 2
        if name == "near_duplicates":
            assert len({r.text for r in rows}) == len(rows) == len({r.doc_id for r in rows})
        if name == "mixing":
            assert max(sum(x.doc_id == r.doc_id for x in rows) for r in rows) <= 3
        before = {r.doc_id: r for r in rows}
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).collect()
    assert sorted({p.doc_id for p in pieces}) == sorted(before)
    assert sum(p.length for p in pieces) == sum(p.doc_tokens for p in pieces if p.start == 0)
    spots = sorted((p.sequence_id * 2048 + p.offset, p.length) for p in pieces)
    assert all(a + n == b for (a, n), (b, _) in zip(spots, spots[1:]))
