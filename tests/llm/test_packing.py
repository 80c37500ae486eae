import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from llm_fixtures import corpus, nothing, rows_of  # noqa: F401

from tablebridge.llm.packing import WordIds, pack, places

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def test_word_ids_are_the_tokenizers_own(tokenizer):
    texts = ["it's don't I'LL", "İstanbul ΣΑΣ", "ábc é é", "x y z", "1234 a1b2", "<|endoftext|> <|startoftext|>x"]
    texts += ["日本語 ß ﬁ", "", "o'clock 'tis", "a\x1cb \x85c", "^^ ``` $$%%", "ª ² ½", "Façade, NAÏVE!!", "a\x00b\x7f"]
    encoder = WordIds(PATH, 1)
    for text, ids in zip(texts, encoder.encode(texts)):
        assert np.frombuffer(ids, np.uint16).tolist() == tokenizer.encode(text, add_special_tokens=False).ids + [1], text


@pytest.mark.parametrize("weights", [None, {"s0": 5.0, "s1": 0.1, None: 2.0}])
def test_every_id_has_one_place(corpus, rows_of, tokenizer, weights):
    pieces = pack(corpus.repartition(5, "doc_id", "text"), PATH, window=64, quantum=16, weights=weights).collect()
    whole = sorted(tuple(tokenizer.encode(r.text or "", add_special_tokens=False).ids + [1]) for r in rows_of)
    taken = np.concatenate([np.arange(p.sequence_id * 64 + p.offset, p.sequence_id * 64 + p.offset + p.length) for p in pieces])
    assert sorted(taken.tolist()) == list(range(sum(map(len, whole))))  # no gap, no overlap
    assert all(p.offset + p.length <= 64 and p.length > 0 for p in pieces)
    by_place = {}
    for p in pieces:
        ids = np.frombuffer(p.ids, "<u4").tolist()
        assert len(ids) == p.length
        by_place.setdefault((p.doc_id, p.doc_tokens), []).append((p.start, ids))
    for key, own in by_place.items():
        texts = [t for t in whole if len(t) == key[1]]
        same = [r for r in rows_of if r.doc_id == key[0] and len(tokenizer.encode(r.text or "", add_special_tokens=False).ids) + 1 == key[1]]
        assert sum(len(ids) for _, ids in own) == key[1] * len(same)
        flat = {}
        for start, ids in own:
            flat.update({start + i: x for i, x in enumerate(ids)})
        if len(same) == 1 or len({r.text for r in same}) == 1:
            assert tuple(flat[i] for i in range(key[1])) in texts


def test_windows_follow_the_target_shares(spark):
    rows = [(i, "word " * 400, "abc"[i % 3], 0) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, x int").repartition(7)
    pieces = pack(docs, PATH, window=256, quantum=16, weights={"a": 2.0, "b": 1.0, "c": 1.0}).collect()
    total = {}
    for p in pieces:
        total.setdefault(p.sequence_id, {}).setdefault(p.source, []).append(p.length)
    for window in range(60):  # long before the queue of a ends
        shares = {s: sum(x) for s, x in total[window].items()}
        assert abs(shares["a"] - 128) <= 16 and abs(shares["b"] - 64) <= 16 and abs(shares["c"] - 64) <= 16


def test_places_match_a_running_round_robin():
    totals, weights, quantum = np.array([50, 33, 8, 64]), np.array([5, 3, 1, 7]), 8
    due = sorted(((2 * b + 1) / w, q, b) for q, (n, w) in enumerate(zip(totals, weights)) for b in range(-(-n // quantum)))
    at = 0
    for _, q, b in due:
        assert places(np.array([b]), np.array([q]), totals, weights, quantum)[0] == at
        at += min(quantum, totals[q] - b * quantum)


def test_nothing(nothing):
    assert pack(nothing, PATH).count() == 0


def test_checksum_of_a_piece(corpus):
    piece = pack(corpus.filter("doc_id = 203"), PATH).first()
    assert zlib.crc32(piece.ids) == zlib.crc32(np.frombuffer(piece.ids, "<u4").tobytes()) and piece.start == 0


def test_tables_of_words_stay_bounded(tokenizer, monkeypatch):
    from tablebridge.llm import packing

    monkeypatch.setattr(packing, "KEPT", 4000)
    monkeypatch.setattr(packing, "CACHED", 50)
    encoder = WordIds(PATH, 1)
    for turn in range(20):
        texts = [" ".join(f"w{turn}x{i}, The" for i in range(40)), None, "z" * 6000 * (turn == 7), "the end"]
        for text, ids in zip(texts, encoder.encode(texts)):
            assert np.frombuffer(ids, np.uint16).tolist() == tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        assert encoder.words.nbytes + encoder.ids.nbytes <= 4000 and len(encoder.parts) < 500


def test_many_words_take_little_memory():
    """A worker that lives on keeps what words it saw in a few bytes each."""
    import tracemalloc

    import pyarrow as pa

    encoder = WordIds(PATH, 1)
    encoder.encode(["warm up"])
    before = pa.total_allocated_bytes()
    tracemalloc.start()
    for turn in range(3):
        encoder.encode_column(pa.array([" ".join(f"{turn}.{i}" for i in range(at, at + 5000)) for at in range(0, 100_000, 5000)]))
    held = tracemalloc.get_traced_memory()[0] + pa.total_allocated_bytes() - before
    tracemalloc.stop()
    assert held < 25e6
