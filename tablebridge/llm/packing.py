"""Packing (6): documents of many sources laid into windows of a fixed length at target token proportions.

Each source is a queue: its documents end to end in the order of the input's partitions. A queue is served in quanta of
``quantum`` tokens by deficit round-robin: the next quantum goes to the queue that is furthest behind its target share.
What a queue is owed is a fraction of how far all queues have come, so the schedule needs no running state: the place of
the b-th quantum of a queue is the number of tokens of all queues that are due before it, which any task works out from
the totals of the sources alone. Deficits therefore carry over windows and over partitions exactly, every token has one
place, and only the last window of the corpus can be short.

Two passes and no shuffle of texts or ids: tokenise (ids to the shared scratch folder, 2 bytes each), then cut.
The totals per source are held by every task: a few dozen bytes for each source.

Defined cases: a null text is an empty one; an empty document has its end id alone; a null source is a queue of its own;
repeated rows are packed once each; extra columns are left out, as a packed row holds its ids. An empty table gives no rows.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablebridge.llm.common import kept, portions

LETTER = "a-zA-ZªµºÀ-ÖØ-öø-įı-ſ"
# Words made of these alone are cut into the tokenizer's own pre-tokens here; all others go to it as they are.
PLAIN = re.compile(rf"[{LETTER}0-9!-&(-/:;=?@\[-`{{}}~]+").fullmatch
PARTS = re.compile(rf"[{LETTER}]+|[0-9]|[^{LETTER}0-9]+").findall
# Most words are letters and, at most, signs behind them: two parts.
USUAL = re.compile(rf"([{LETTER}]+)([!-&(-/:;=?@\[-`{{}}~]*)").fullmatch
# What a Python worker keeps of words seen before, bytes of words and their ids and entries by part; a full table starts afresh.
KEPT, CACHED = 1 << 24, 100_000
COPIED = 1 << 17  # words whose ids are copied at a time
# Byte-level vocabularies print a byte as this character: printable ones as themselves, the rest from U+0100 on.
PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
SHOWN = [chr(b if b in PRINTED else 256 + sum(x not in PRINTED for x in range(b))) for b in range(256)]


class Parts(dict):
    """Ids of a part of a word, found when first asked for."""

    def __init__(self, tokenizer) -> None:
        super().__init__()
        self.tokenize = tokenizer.model.tokenize

    def __missing__(self, part: str) -> bytes:
        lower = part.lower()
        if lower != part:
            return self[lower]
        shown = part if part.isascii() else "".join([SHOWN[byte] for byte in part.encode()])
        self[part] = ids = array("H", [token.id for token in self.tokenize(shown)]).tobytes()
        return ids


class WordIds:
    """Ids of texts, by a tokenizer that treats every word between white space on its own.

    Most words have been seen before, so ids are kept by word, and by part of a word (letters, a digit, other signs). Words
    are kept in columns, as a table of Python objects takes ten times the memory: a corpus brings a million of them.
    """

    def __init__(self, path: str, end_id: int) -> None:
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.parts = Parts(self.tokenizer)
        self.words = self.ids = pa.array([], pa.binary())
        self.end = end_id

    def ids_of(self, word: bytes) -> bytes:
        """Ids of a word between white space."""
        text = word.decode()
        if usual := USUAL(text):
            head, tail = usual.groups()
            return self.parts[head] + self.parts[tail] if tail else self.parts[head]
        if PLAIN(text):
            return b"".join(map(self.parts.__getitem__, PARTS(text)))
        return array("H", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def looked_up(self, words: pa.Array) -> pa.Array:
        """Ids of distinct words; those that were not known are kept, and a table that is full starts afresh with these."""
        if len(self.parts) > CACHED:
            self.parts.clear()
        place = pc.index_in(words, value_set=self.words)
        new = words.filter(place.is_null())
        seen, ids = pa.concat_arrays([self.words, new]), pa.concat_arrays([self.ids, pa.array(map(self.ids_of, new.to_pylist()), pa.binary())])
        at = place.fill_null(-1).to_numpy().copy()
        at[at < 0] = np.arange(len(self.words), len(seen))
        found = ids.take(pa.array(at))
        if seen.nbytes + ids.nbytes > KEPT:
            seen, ids = (words, found) if words.nbytes + found.nbytes <= KEPT else (words[:0], found[:0])
        self.words, self.ids = seen, ids
        return found

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, ids of each text), 16 bits an id, the end id last in each text.

        The distinct words of the column are looked up; where each occurs, its ids are copied by their offsets.
        """
        split = pc.ascii_split_whitespace(texts.fill_null(""))
        words = split.flatten().dictionary_encode()
        found = self.looked_up(words.dictionary.cast(pa.binary()))
        sizes = pc.binary_length(found).to_numpy(zero_copy_only=False).astype(np.int64) // 2
        begins = np.cumsum(sizes) - sizes
        known = np.frombuffer(found.buffers()[2] or b"", np.uint16)  # just taken, so it starts at 0
        word = words.indices.to_numpy(zero_copy_only=False)
        per_text = split.value_lengths().to_numpy(zero_copy_only=False)
        ends = np.concatenate([[0], np.cumsum(sizes[word])])
        counts = np.diff(ends[np.concatenate([[0], np.cumsum(per_text, dtype=np.int64)])])
        text = np.repeat(np.arange(len(texts), dtype=np.int32), per_text)
        ids = np.full(ends[-1] + len(texts), self.end, np.uint16)
        for at in range(0, len(word), COPIED):
            some = word[at : at + COPIED]
            many = sizes[some]
            to = np.arange(ends[at], ends[at + len(some)])
            # Where the word's ids lie among the known, and one place further for every text that ended before.
            of = to + np.repeat(begins[some] - ends[at : at + len(some)], many)
            ids[to + np.repeat(text[at : at + COPIED], many)] = known[of]
        return ids, counts + 1

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as 16-bit numbers, the end id last."""
        ids, counts = self.encode_column(pa.array([(text or "").encode("utf-8", "replace").decode() for text in texts], pa.string()))
        return [part.tobytes() for part in np.split(ids, np.cumsum(counts)[:-1])] if texts else []


_ENCODERS: dict[tuple[str, int], WordIds] = {}


def binaries(numbers: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Consecutive runs of ``numbers`` as binary values, without a copy of them."""
    ends = np.concatenate([[0], np.cumsum(counts) * numbers.itemsize]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(numbers))])


def tokenise(docs: DataFrame, tokenizer: str, end_id: int, id_column: str, text_column: str, source_column: str) -> DataFrame:
    """(part, queue, doc_id, source, start, n, ids): each document's ids and its start among those of its part and queue."""
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.col(source_column).cast("string").alias("source"),
        F.col(text_column).cast("string").alias("text"),
    )
    schema = "part int, queue string, doc_id long, source string, start long, n long, ids binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = (tokenizer, end_id)
        encoder = _ENCODERS.get(key) or _ENCODERS.setdefault(key, WordIds(*key))
        part = TaskContext.get().partitionId()
        so_far: dict[str, int] = {}
        for whole in batches:
            for batch in portions(whole, 2, rows=4000, volume=1 << 22):
                ids, counts = encoder.encode_column(batch.column(2))
                sources = batch.column(1).to_pylist()
                queues = ["" if source is None else f"={source}" for source in sources]
                starts = []
                for queue, n in zip(queues, counts.tolist()):
                    starts.append(so_far.get(queue, 0))
                    so_far[queue] = starts[-1] + n
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(queues), part), pa.int32()),
                        pa.array(queues, pa.string()),
                        batch.column(0),
                        pa.array(sources, pa.string()),
                        pa.array(starts, pa.int64()),
                        pa.array(counts, pa.int64()),
                        binaries(ids, counts),
                    ],
                    names=["part", "queue", "doc_id", "source", "start", "n", "ids"],
                )

    return rows.mapInArrow(run, schema)


def places(block: np.ndarray, queue: np.ndarray, totals: np.ndarray, weights: np.ndarray, quantum: int) -> np.ndarray:
    """Tokens due before the given quantum of the given queue, over all queues.

    The b-th quantum of a queue of weight w is due at (2b + 1) / w; ties go to the queue that comes first. Whole numbers
    only, so any two tasks agree.
    """
    out = np.empty(len(block), np.int64)
    step = max(1, 250_000 // len(totals))
    order = np.arange(len(totals))
    for at in range(0, len(block), step):
        b, q = block[at : at + step, None], queue[at : at + step, None]
        due = (2 * b + 1) * weights[None, :] - (order[None, :] >= q)
        before = (due // weights[q] + 1) // 2
        out[at : at + step] = np.minimum(totals[None, :], before * quantum).sum(axis=1)
    return out


def cut(start: np.ndarray, n: np.ndarray, queue: np.ndarray, totals: np.ndarray, weights: np.ndarray, quantum: int, window: int):
    """Pieces of documents: (document, start in it, length, place in the corpus), cut where quanta or windows end."""
    first, last = start // quantum, (start + n - 1) // quantum
    many = last - first + 1
    doc = np.repeat(np.arange(len(n)), many)
    block = first[doc] + np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many)
    low = np.maximum(block * quantum, start[doc])
    high = np.minimum((block + 1) * quantum, (start + n)[doc])
    place = places(block, queue[doc], totals, weights, quantum) + low - block * quantum
    # A quantum that follows the one before it in the window goes on the same piece.
    goes_on = np.zeros(len(doc), bool)
    goes_on[1:] = (doc[1:] == doc[:-1]) & (place[1:] == (place + high - low)[:-1])
    begins = np.flatnonzero(~goes_on)
    ends = np.append(begins[1:], len(doc)) - 1
    doc, low, high, place = doc[begins], low[begins], high[ends], place[begins]
    length = high - low
    many = (place + length - 1) // window - place // window + 1
    of = np.repeat(np.arange(len(doc)), many)
    number = place[of] // window + np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many)
    begin = np.maximum(place[of], number * window)
    end = np.minimum((place + length)[of], (number + 1) * window)
    return doc[of], (low - start[doc])[of] + begin - place[of], end - begin, begin


def pack(
    docs: DataFrame,
    tokenizer: str,
    window: int = 2048,
    quantum: int = 128,
    end_id: int = 1,
    weights: dict[str | None, float] | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
) -> DataFrame:
    """One row per piece: doc_id, source, start, length, doc_tokens, sequence_id, offset and its ``ids``.

    ``ids`` are little-endian unsigned 32-bit numbers. ``weights`` are target token shares by source; without them a
    source's share is its share of all tokens, so that all queues end together. When a queue ends early the others share
    what it leaves in proportion. A source without a weight counts as 1.
    """
    spark = docs.sparkSession
    encoded = kept(tokenise(docs, tokenizer, end_id, id_column, text_column, source_column), "packing-ids")
    sums = kept(encoded.groupBy("part", "queue", "source").agg(F.sum("n").alias("n")), "packing-sums")
    by_source = sums.groupBy("queue", "source").agg(F.sum("n").alias("n")).orderBy("queue").collect()
    earlier = Window.partitionBy("queue").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("part", "queue", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    index = {row.queue: i for i, row in enumerate(by_source)}
    totals = np.array([row.n for row in by_source], np.int64)
    share = totals.astype(float) if weights is None else np.array([weights.get(row.source, 1.0) for row in by_source], float)
    # Shares as whole numbers of at most 20 bits: products with a quantum's number stay below 2 ** 63.
    scaled = np.maximum(1, np.round(share / max(share.max(initial=0), 1e-300) * 2**20)).astype(np.int64)
    schema = "doc_id long, source string, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
    names = ["doc_id", "source", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
    shared = spark.sparkContext.broadcast((index, totals, scaled))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, totals, scaled = shared.value
        for whole in batches:
            for batch in portions(whole, 5, volume=1 << 21):
                doc_id, source, queue, start, n, ids = (batch.column(i) for i in range(6))
                start, n = (x.to_numpy(zero_copy_only=False).astype(np.int64) for x in (start, n))
                queue = np.array([index[x] for x in queue.to_pylist()], np.int64)
                doc, begin, length, place = cut(start, n, queue, totals, scaled, quantum, window)
                # The pieces of a document follow each other, so their ids are those of the batch in order.
                taken = np.frombuffer(b"".join(ids.to_pylist()), np.uint16).astype("<u4")
                rows = pa.array(doc)
                yield pa.RecordBatch.from_arrays(
                    [
                        doc_id.take(rows),
                        source.take(rows),
                        pa.array(begin),
                        pa.array(length),
                        pa.array(n[doc]),
                        pa.array(place // window),
                        pa.array(place % window),
                        binaries(taken, length),
                    ],
                    names=names,
                )

    placed = encoded.join(bases, ["part", "queue"]).select(
        "doc_id", "source", "queue", (F.col("start") + F.col("base")).alias("start"), "n", "ids"
    )
    return placed.mapInArrow(run, schema)
