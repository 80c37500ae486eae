"""What runs inside the tasks of the bulk sink: cutting rows into payloads and posting them.

The module is pickled by value, so executors need no copy of the package.
"""

from __future__ import annotations

import json
import sys
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

PAYLOAD_SCHEMA = "shape string, stmt string, n_rows bigint, payload string"
_ARROW = pa.schema([("shape", pa.string()), ("stmt", pa.string()), ("n_rows", pa.int64()), ("payload", pa.string())])


def identifier(name: str) -> str:
    """A name for a statement, always in quotes: keys come from the data and may be reserved words."""
    return '"' + name.replace('"', '""') + '"'


def insert_statement(schema: str, table: str, columns: list[str], ignore_conflicts: bool = False) -> str:
    """The statement with one ``?`` per column.

    ``ignore_conflicts`` lets a repeated payload skip rows whose primary key exists.
    """
    marks = ",".join("?" for _ in columns)
    tail = " ON CONFLICT DO NOTHING" if ignore_conflicts else ""
    return f"INSERT INTO {identifier(schema)}.{identifier(table)} ({','.join(map(identifier, columns))}) VALUES ({marks}){tail}"


def chunker(schema: str, table: str, size: int, ignore_conflicts: bool, max_bytes: int) -> Callable:
    """Cuts ``(keys, args)`` rows that come sorted by keys into payloads; one is open at a time.

    Rows ``(keys, args, batch)`` come sorted by keys and batch, and no payload holds rows of two batches.
    """

    def payload(keys: str, rows: list[str]) -> pa.RecordBatch:
        stmt = insert_statement(schema, table, json.loads(keys), ignore_conflicts)
        body = f'{{"stmt":{json.dumps(stmt, ensure_ascii=False)},"bulk_args":[{",".join(rows)}]}}'
        columns = [pa.array([value], kind.type) for value, kind in zip((keys, stmt, len(rows), body), _ARROW)]
        return pa.RecordBatch.from_arrays(columns, schema=_ARROW)

    def chunk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_keys, open_batch, rows, held = None, None, [], 0
        for batch in batches:
            keys, args = batch.column(0), batch.column(1)
            numbers = batch.column(2).to_numpy(zero_copy_only=False) if batch.num_columns > 2 else np.zeros(len(args), np.int64)
            sizes = np.cumsum(pc.binary_length(args).to_numpy(zero_copy_only=False).astype(np.int64))
            runs = pc.run_end_encode(keys)
            ends = np.union1d(runs.run_ends.to_numpy(), np.append(np.flatnonzero(np.diff(numbers)) + 1, len(args)))
            at = 0
            for end in ends[ends > 0].tolist():
                value, number = keys[at].as_py(), int(numbers[at])
                if rows and (value != open_keys or number != open_batch):
                    yield payload(open_keys, rows)
                    rows, held = [], 0
                open_keys, open_batch = value, number
                while at < end:
                    before = sizes[at - 1] if at else 0
                    fits = int(np.searchsorted(sizes[at:end], before + max_bytes - held, side="right"))
                    take = min(size - len(rows), fits)
                    if not take and not rows:
                        take = 1  # a document longer than a payload goes alone
                    if take:
                        rows += args.slice(at, take).to_pylist()
                        held += int(sizes[at + take - 1] - before)
                        at += take
                    if len(rows) == size or at < end:
                        yield payload(open_keys, rows)
                        rows, held = [], 0
        if rows:
            yield payload(open_keys, rows)

    return chunk


class DeliveryError(RuntimeError):
    """The endpoint refused a payload, or rows of it."""


def post(url: str, payload: str, timeout: float) -> dict:
    request = urllib.request.Request(
        url, payload.encode("utf-8"), {"Content-Type": "application/json"}, method="POST"
    )
    try:
        with urllib.request.urlopen(request, timeout=timeout) as response:
            return json.loads(response.read() or b"{}")
    except urllib.error.HTTPError as error:
        raise DeliveryError(f"HTTP {error.code}: {error.read()!r}") from error
    except urllib.error.URLError as error:
        raise DeliveryError(str(error.reason)) from error


@dataclass
class Delivered(WriterCommitMessage):
    payloads: int
    rows: int


class BulkWriter(DataSourceWriter):
    """Posts every payload of a task. A refused payload or row fails the task, so Spark tries it again."""

    def __init__(self, url: str, timeout: float, send: Callable[[str, str, float], dict] = post):
        self.url = url
        self.timeout = timeout
        self.send = send

    def write(self, iterator: Iterator) -> Delivered:
        payloads = rows = 0
        for row in iterator:
            answer = self.send(self.url, row["payload"], self.timeout)
            # The endpoint answers 200 and marks each failed row with a negative count.
            failed = [i for i, result in enumerate(answer.get("results", [])) if result.get("rowcount", 1) < 0]
            if failed:
                raise DeliveryError(f"{len(failed)} of {row['n_rows']} rows refused, first at {failed[0]}")
            payloads += 1
            rows += row["n_rows"]
        return Delivered(payloads, rows)


class BulkDataSource(DataSource):
    """``df.write.format("bulk_http").option("url", ...)`` for a frame of payloads."""

    @classmethod
    def name(cls) -> str:
        return "bulk_http"

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        if "url" not in self.options:
            raise ValueError("bulk_http needs the option url")
        return BulkWriter(self.options["url"], float(self.options.get("timeout", "30")))


cloudpickle.register_pickle_by_value(sys.modules[__name__])
