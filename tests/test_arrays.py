import json
import random

import pytest
from pyspark.sql import functions as F

from tablebridge.sources.arrays import _effects, _fragments, read_json_arrays

ODD = ['{"a":"x,y"}', '{"a":"[{,"}', '{"b":"q\\"],","c":[1,[2,{"d":"\\\\"}]]}', '{"e":"}"}', "{}", '{"f":{"g":[{},{"h":null}]}}', '{"i":"é😀, ü"}']


@pytest.fixture
def ranges(spark):
    """Byte ranges so short that most documents lie in several of them."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]

    def of(size):
        for n in names:
            spark.conf.set(n, str(size))

    yield of
    for n, v in zip(names, before):
        spark.conf.set(n, v)


def read(spark, path):
    docs, rejects = read_json_arrays(spark, str(path))
    return sorted(r[0] for r in docs.select(F.to_json("doc")).collect()), sorted((r.raw.strip(), r.reason) for r in rejects.collect())


@pytest.mark.parametrize("size", [7, 64, 1 << 20])
@pytest.mark.parametrize("indent", [None, 2])
def test_ranges_give_the_documents_of_the_whole_file(spark, tmp_path, ranges, size, indent):
    rng = random.Random(size)
    docs = [json.loads(rng.choice(ODD)) | {"n": i, "s": rng.choice([",", '"', "\\", "]", "[,", "x" * 50])} for i in range(24)]
    (tmp_path / "a.json").write_text(json.dumps(docs, indent=indent), encoding="utf-8")
    (tmp_path / "b.json").write_text("﻿ \n[\n" + ODD[2] + "\n]\n", encoding="utf-8")
    (tmp_path / "c.json").write_text(json.dumps({"single": [1, {"x": ","}], "z": docs[0]}, indent=indent), encoding="utf-8")
    (tmp_path / "d.json").write_text(" [ ] ")
    (tmp_path / "e.json").write_text("")
    ranges(size)
    want = [*docs, json.loads(ODD[2]), {"single": [1, {"x": ","}], "z": docs[0]}]
    found, rejects = read(spark, tmp_path)
    assert sorted(json.dumps(json.loads(x), sort_keys=True) for x in found) == sorted(json.dumps(x, sort_keys=True) for x in want)
    assert rejects == []


def test_what_is_no_document_is_quarantined(spark, tmp_path, ranges):
    (tmp_path / "a.json").write_text('[1, {"a":1}, "x,]", [2,3], null, {"b":tru}, , {"c":3}, {"cut": "sho')
    ranges(5)
    docs, rejects = read(spark, tmp_path)
    assert docs == ['{"a":1}', '{"c":3}']
    assert rejects == [
        ("", "malformed"), ('"x,]"', "not an object"), ("1", "not an object"), ("[2,3]", "not an object"), ("null", "not an object"),
        ('{"b":tru}', "malformed"), ('{"cut": "sho', "malformed"),
    ]


def test_a_large_array_is_read_by_many_tasks_and_equals_its_lines(spark, tmp_path, ranges):
    lines = [json.dumps({"id": i, "text": "word, [" * 40, "list": list(range(i % 50))}, separators=(",", ":")) for i in range(60_000)]
    (tmp_path / "lines.json").write_text("\n".join(lines))
    (tmp_path / "array").mkdir()
    (tmp_path / "array" / "one.json").write_text("[" + ",".join(lines) + "]")
    ranges(1 << 20)
    path = str(tmp_path / "array")
    fragments = _fragments(spark, path)
    assert _effects(fragments).count() >= 20 and fragments.rdd.getNumPartitions() >= 20
    docs, rejects = read_json_arrays(spark, path)
    hashed = F.sum(F.xxhash64(F.to_json("doc")).cast("decimal(38,0)"))
    want = spark.read.text(str(tmp_path / "lines.json")).select(F.parse_json("value").alias("doc")).agg(F.count("*"), hashed).first()
    assert docs.agg(F.count("*"), hashed).first() == want and rejects.isEmpty()


def test_no_task_sorts_the_fragments_of_its_range(spark, tmp_path):
    """What a task holds does not grow with its byte range."""
    (tmp_path / "a.json").write_text(json.dumps([{"k": i} for i in range(1000)]))
    plan = read_json_arrays(spark, str(tmp_path)).docs._jdf.queryExecution().executedPlan().toString()
    before = [line for line in plan.splitlines() if "nth" in line]
    assert "BroadcastHashJoin" in plan and not before and "SortMergeJoin" not in plan
