import json
import random

import pytest
from pyspark.sql import functions as F

from conftest import DIRTY
from tablebridge.operators.discover import profile
from tablebridge.operators.profile_store import merge_profiles, read_profile, sketch_profile, stored_profile, update_profile
from tablebridge.sinks.shredded import read_keys, write_shredded


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_profile_of_parts_merged_is_that_of_the_whole(dirty, make_docs):
    rng = random.Random(5)
    docs = make_docs([{"n": rng.choice([rng.gauss(0, 1e3), rng.randrange(-9, 9), str(rng.random())]), "m": None} for _ in range(400)])
    parts = [sketch_profile(docs.where(F.col("r") % 3 == k)) for k in range(3)]
    assert rows(merge_profiles(*parts)) == rows(sketch_profile(docs))
    assert rows(merge_profiles(parts[2], merge_profiles(parts[1], parts[0]))) == rows(sketch_profile(docs))


def test_counts_equal_the_plain_profile(dirty):
    read = read_profile(sketch_profile(dirty))
    assert rows(read.select("key", "tag", "n")) == rows(profile(dirty))
    assert rows(sketch_profile(dirty.limit(0))) == [] and rows(read_profile(sketch_profile(dirty.limit(0)))) == []


def test_estimates_are_near(make_docs):
    rng = random.Random(6)
    numbers = [rng.lognormvariate(0, 4) * rng.choice([-1, 1, 1]) for _ in range(3000)]
    few = [{"x": x, "t": f"t{i % 37}", "z": 0, "d": {"$numberLong": str(10**12 + i)}} for i, x in enumerate(numbers)]
    got = {(r.key, r.tag): r for r in read_profile(sketch_profile(make_docs(few))).collect()}
    ordered = sorted(numbers)
    for share, name in ((0.5, "p50"), (0.95, "p95"), (0.99, "p99")):
        true = ordered[-int(-share * len(ordered) // 1) - 1]
        assert got["x", "Double64"][name] == pytest.approx(true, rel=0.009)
    assert got["x", "Double64"].n_distinct == pytest.approx(3000, rel=0.1)
    assert got["t", "String"].n_distinct in (36, 37, 38) and got["t", "String"].p50 is None
    assert got["z", "I32"].p50 == 0.0 and got["z", "I32"].n_distinct == 1
    assert got["d", "I64"].p50 == pytest.approx(1e12, rel=0.009)


def test_only_new_files_are_read(spark, tmp_path):
    source, store = tmp_path / "in", str(tmp_path / "store")
    source.mkdir()
    (source / "a.json").write_text("\n".join(DIRTY[:4]) + "\nnot a document\n")
    assert rows(stored_profile(spark, store)) == []
    assert update_profile(spark, str(source), store) == 1
    (source / "b.json").write_text("\n".join(DIRTY[4:]) + "\n")
    assert [update_profile(spark, str(source), store) for _ in range(2)] == [1, 0]
    whole = spark.createDataFrame([(t,) for t in DIRTY], "t string").select(F.parse_json("t").alias("doc"))
    assert rows(stored_profile(spark, store)) == rows(sketch_profile(whole))
    # What a lost run wrote without noting its files counts nothing.
    sketch_profile(whole).write.parquet(f"{store}/sketches/run=lost")
    assert rows(stored_profile(spark, store)) == rows(sketch_profile(whole))


def test_shredded_documents_come_back_and_scans_are_pruned(spark, make_docs, tmp_path):
    path = str(tmp_path / "shredded")
    items = [{"a": i, "b": "x" * 50 + str(i), "c": i if i % 2 else f"t{i}", "d": {"e": [i, None]}} for i in range(500)]
    odd = [{}, {"a": None}, {"a": "text", 'q"': 1}, {"a": 2**40, "b": [1]}, {"rare": True}, *[json.loads(t) for t in DIRTY]]
    docs = make_docs(items + odd)
    write_shredded(docs, path)
    back = spark.read.parquet(path)
    text = F.to_json("doc").alias("t")
    assert rows(back.select("r", text)) == rows(docs.select("r", text))
    scan = read_keys(spark, path, "doc", {"a": "bigint", "c": "string"}, carry=("r",))
    plain = docs.selectExpr("r", "try_variant_get(doc, '$.a', 'bigint') AS a", "try_variant_get(doc, '$.c', 'string') AS c")
    assert rows(scan) == rows(plain)
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<r:int,doc:struct<0:bigint,1:string>>" in plan
    with pytest.raises(ValueError):
        read_keys(spark, path, "doc", {"both\"'": "int"})
