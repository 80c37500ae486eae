import json
import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parent), str(Path(__file__).resolve().parent.parent)]

from pyspark.sql import functions as F  # noqa: E402

from tablebridge.session import local_session  # noqa: E402

# Two ragged columns: titles that are text, a number, lists, objects or null, and quantities that are numbers or text.
DIRTY = """{"id":1,"title":"plum","qty":10}
{"id":2,"title":41,"qty":"11"}
{"id":3,"title":["fig","kiwi"],"qty":12,"note":"ripe"}
{"id":4,"qty":"+13"}
{"id":5,"title":{"a":[1,{"b":null}],"c":2.5}}
{"id":6,"title":null,"qty":14}
{"id":7,"title":[true,7,"x",[8]],"qty":15}
{"id":8,"title":"pear","qty":"16"}
{"id":9,"title":{"c":"d"},"stock":3,"qty":17}
{"id":10,"title":"lime","qty":{"$numberInt":"18"}}""".split("\n")


@pytest.fixture(scope="session")
def spark():
    return local_session(4, shuffle_partitions=4, memory="4g", **{"spark.sql.adaptive.coalescePartitions.enabled": "true"})


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from Python values or JSON texts, with a row id ``r``."""

    def make(items):
        texts = [x if isinstance(x, str) else json.dumps(x) for x in items]
        rows = spark.createDataFrame(list(enumerate(texts)), "r int, t string")
        return rows.select("r", F.parse_json("t").alias("doc"))

    return make


@pytest.fixture(scope="session")
def dirty(make_docs):
    return make_docs(DIRTY)


def values(df, *, by="id", drop=()):
    """Rows as dicts in order of ``by``, variants as JSON text."""
    shown = df.select(
        *[F.to_json(c).alias(c) if kind.startswith("variant") else F.col(c) for c, kind in df.dtypes if c not in drop]
    )
    return sorted((row.asDict(recursive=True) for row in shown.collect()), key=lambda row: (row[by] is None, row[by]))


def column(df, name, by="id"):
    return [row[name] for row in values(df, by=by)]
