import json

import pytest
from conftest import DIRTY, column, values
from pyspark.sql import functions as F

from tablebridge.functions.cells import HOMOGENISE, normalise_columns, rfc3339, safe_decode
from tablebridge.functions.tags import with_tags
from tablebridge.operators.align import align, normalise, split_mixed
from tablebridge.operators.columns import ignore_keys
from tablebridge.operators.discover import batch_plan, discover_keys, merge_known, profile, schema_report, shape_groups, with_spec
from tablebridge.sources.documents import parse_documents, read_documents, read_json_files


def tagged(spark, text):
    return with_tags(spark.createDataFrame([(text,)], "t string").select(F.parse_json("t").alias("v")), {"v": "tag"}).first().tag


@pytest.mark.parametrize(
    "text, expected",
    [
        ("1", "I32"), ("2147483648", "I64"), ("-2147483649", "I64"), ("28.0", "Double64"), ("1e3", "Double64"),
        ("123456789012345678901234567890", "Double64"), ('"a"', "String"), ("true", "Bool"), ("null", "None"),
        ("[]", "VecString"), ("[[]]", "VecDyn"), ("[null]", "VecDyn"), ("{}", "Object"), ('{"a":1}', "Object"),
        ('{"$oid":"x"}', "String"), ('{"$date":"2020-01-01T00:00:00Z"}', "I64"), ('{"$numberLong":"5"}', "I64"),
        ('{"$numberInt":"5"}', "I32"), ('{"$numberDecimal":"1.5"}', "Double64"), ('{"$oid":1}', "Object"),
        ('{"$oid":"x","y":1}', "Object"), ('{"$regularExpression":{"pattern":"a","options":""}}', "String"),
    ],
)
def test_tags(spark, text, expected):
    assert tagged(spark, text) == expected


def test_profile_and_shapes(dirty):
    assert {(r.key, r.tag): r.n for r in profile(dirty).collect()} == {
        ("id", "I32"): 10, ("title", "String"): 3, ("title", "VecDyn"): 2, ("title", "Object"): 2, ("title", "I32"): 1,
        ("title", "None"): 1, ("qty", "I32"): 6, ("qty", "String"): 3, ("note", "String"): 1, ("stock", "I32"): 1,
    }
    keys = {("id", "qty", "title"): 6, ("id", "note", "qty", "title"): 1, ("id", "qty"): 1, ("id", "title"): 1, ("id", "qty", "stock", "title"): 1}
    assert {tuple(json.loads(r.shape)): r.n for r in shape_groups(dirty).collect()} == keys
    plan = {tuple(json.loads(r.shape)): (r.n, r.n_batches) for r in batch_plan(dirty.coalesce(1), 4).collect()}
    assert plan["id", "qty", "title"] == (6, 2) and sum(n for n, _ in plan.values()) == 10
    with pytest.raises(ValueError):
        batch_plan(dirty, 0)


def test_schema_report(dirty):
    spec = {"title": {"dtype": "String", "dtype_collision_strategy": "NewCol"}, "id": {"dtype": "I64", "dtype_collision_strategy": "Cast"}}
    report = {r.key: r for r in schema_report(dirty, spec).collect()}
    assert (report["title"].expected_dtype, report["title"].strategy, report["title"].n_mismatch) == ("String", "NewCol", 5)
    assert report["title"].dtypes == "I32,Object,String,VecDyn"
    assert (report["id"].expected_dtype, report["id"].n_mismatch) == ("I64", 0)
    assert (report["stock"].expected_dtype, report["stock"].strategy) == ("Unknown", "Ignore")
    marked = with_spec(align(dirty), spec)
    assert marked.schema["title"].metadata == {"expected_dtype": "String", "dtype_collision_strategy": "NewCol"}


def test_align(dirty, make_docs):
    rows = align(dirty)
    assert rows.columns == ["r", "id", "note", "qty", "stock", "title"]
    assert column(rows, "note", by="r") == [None, None, '"ripe"'] + [None] * 7
    again = align(dirty, ["title", "nowhere"])
    assert again.columns == ["r", "title", "nowhere"] and column(again, "nowhere", by="r") == [None] * 10
    nulls = align(make_docs([{"a": None}, {}]))
    assert column(nulls, "a", by="r") == [None, None]
    assert discover_keys(make_docs(["{}"])) == []
    assert ignore_keys(dirty, ["title", "zz"]).select(F.to_json("doc")).first()[0] == '{"id":1,"qty":10}'


def test_merge_known():
    assert merge_known({("a",): frozenset({"I32"})}, {("a",): frozenset({"String"})}) == {("a",): frozenset({"I32", "String"})}


def cells(make_docs, mode, items):
    done = normalise(make_docs([{"v": item} for item in items]), mode, ["v"])
    return [(r[0], r[1]) for r in done.orderBy("r").select("v.tag", F.to_json("v.value")).collect()]


LISTS = [[1, 2], [1, 2**40], [1.5, 2], [2, 1.5], [], ["a", 1, None, [1], {"k": True}], [True], [1, None], [1, "a"], [None, 1]]


def test_normalise_typed(make_docs):
    assert cells(make_docs, "typed", [1, 2**40, 1.5, "x", True, None, {"k": [1]}, {"$oid": "ab"}, {"$date": 5}]) == [
        ("I32", "1"), ("I64", str(2**40)), ("Double64", "1.5"), ("String", '"x"'), ("String", '"true"'), ("None", None),
        ("String", '"{\\"k\\":[1]}"'), ("String", '"ab"'), ("I64", "5"),
    ]
    assert cells(make_docs, "typed", LISTS) == [
        ("VecI32", "[1,2]"), ("VecI64", f"[1,{2**40}]"), ("VecF64", "[1.5,2.0]"), ("VecF64", "[2.0,1.5]"),
        ("VecString", "[]"), ("VecString", '["a","1","null","[1]","{\\"k\\":true}"]'), ("VecString", '["true"]'),
        ("VecI32", "[1,null]"), ("VecString", '["1","a"]'), ("VecI32", "[null,1]"),
    ]
    assert cells(make_docs, "typed", [[{"$numberLong": "1"}], [{"$numberInt": "1"}], [{"$oid": "a"}]]) == [
        ("VecI64", "[1]"), ("VecI32", "[1]"), ("VecString", '["a"]'),
    ]


def test_normalise_http(make_docs):
    assert cells(make_docs, "http", [1, 1.5, True, {"$date": "2020-01-02T03:04:05.120Z"}, {"$date": 1000}, {"a": 1}]) == [
        ("I32", "1"), ("String", '"1.5"'), ("String", '"true"'), ("String", '"2020-01-02T03:04:05.12Z"'),
        ("String", '"1970-01-01T00:00:01Z"'), ("String", '"{\\"a\\":1}"'),
    ]
    assert [tag for tag, _ in cells(make_docs, "http", LISTS)] == [
        "VecString", "VecString", "VecF64", "VecString", "VecString", "VecString", "VecString", "VecString", "VecString",
        "VecString",
    ]


def test_a_dollar_in_a_string_changes_nothing(make_docs):
    texts = [{"p": 28.0, "q": "$5"}, {"p": 28.0, "q": '{"$oid'}, ["$x", 3.0]]
    docs = make_docs([{"v": x} for x in texts])
    kinds = normalise(docs, "nested", ["v"]).selectExpr("r", "schema_of_variant(v.value) AS k").orderBy("r").collect()
    assert [r.k for r in kinds] == ["OBJECT<p: DECIMAL(1,0), q: STRING>"] * 2 + ["ARRAY<VARIANT>"] or all(
        "BIGINT" not in r.k for r in kinds
    )


def test_normalise_nested(make_docs):
    items = [{"a": {"$date": 3}, "b": [{"$oid": "x"}]}, [{"$numberLong": "7"}], True, 3]
    assert cells(make_docs, "nested", items) == [
        ("Object", '{"a":3,"b":["x"]}'), ("VecDyn", "[7]"), ("Bool", "true"), ("I32", "3"),
    ]


def test_rfc3339_before_the_epoch(spark):
    times = spark.sql(f"SELECT {rfc3339('-1500')} AS a, {rfc3339('253402300799999')} AS b").first()
    assert tuple(times) == ("1969-12-31T23:59:58.5Z", "9999-12-31T23:59:59.999Z")


@pytest.mark.parametrize(
    "text, expected",
    [
        ('[1,2.5,"x",null,true]', ("VecF64", "[1.0,2.5,null,null,null]")), ('["a",1,[2]]', ("VecString", '["a","1","[2]"]')),
        ("[]", ("None", None)), ("[[1]]", ("String", '"[[1]]"')), ("[true,1]", ("String", '"[true,1]"')),
        ('{"a":1}', ("String", '"{\\"a\\":1}"')), ("null", ("None", None)), (None, ("None", None)), ("[1,2]", ("VecF64", "[1.0,2.0]")),
        ("[null,1]", ("String", '"[null,1]"')),
    ],
)
def test_homogenise(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string").select(F.try_parse_json("t").alias("v"))
    assert tuple(normalise_columns(df, ["v"], HOMOGENISE).select("v.tag", F.to_json("v.value")).first()) == expected


def test_split_mixed(dirty):
    arrays = align(dirty, ["title"]).where("r = 6")
    flat = split_mixed(arrays, "title", ["I32", "String", "VecDyn", "Bool", "Object"]).drop("title").first()
    assert flat.title_i32 == [7] and flat.title_str == ["x"] and flat.title_bool == [True] and flat.title_object is None
    assert [v.toJson() for v in flat.title_vecdyn] == ["[8]"]
    deep = split_mixed(arrays, "title", ["I32", "String", "Bool"], depth=1).first()
    assert deep.title_i32 == [7, 8] and deep.title_bool == [True]


@pytest.mark.parametrize(
    "text, dtype, expected",
    [
        ("+7", "I32", 7), ("7\n", "I32", None), ("70000", "I16", None), ("70000", "I64", 70000), ("1.5e3", "Double64", 1500.0),
        (" 1", "Double64", None), ("NaN", "Double64", None), ("TRUE", "Bool", True), ("1", "Bool", None), ("x", "String", "x"),
        ("[1,2]", "VecI32", [1, 2]), ("{", "Object", None),
    ],
)
def test_safe_decode(spark, text, dtype, expected):
    assert spark.createDataFrame([(text,)], "t string").select(F.expr(safe_decode("t", dtype))).first()[0] == expected


def test_reading_lines(spark, tmp_path):
    lines = [*DIRTY, "", "{broken", "[1]", "5", '{"a":1,"a":2}', ' \t{"ok":1}']
    (tmp_path / "a.json").write_text("\n".join(lines) + "\n")
    docs, rejects = read_documents(spark, str(tmp_path))
    assert docs.count() == 11
    assert sorted((r.raw, r.reason) for r in rejects.collect()) == [
        ("", "malformed"), ("5", "not an object"), ("[1]", "not an object"), ('{"a":1,"a":2}', "malformed"),
        ("{broken", "malformed"),
    ]
    carried = parse_documents(spark.createDataFrame([(1, '{"a":1}'), (2, None)], "k int, t string"), "t")
    assert carried.docs.columns == ["k", "doc"]
    assert [tuple(r) for r in carried.rejects.collect()] == [(2, None, "malformed")]


def test_each_line_is_parsed_once(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"a":1}\n')
    plan = read_documents(spark, str(tmp_path)).docs._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") == 1


def test_reading_whole_files(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"a": 1}, {"a": "x"}], indent=1))
    (tmp_path / "b.json").write_text('{"a":\n[]}')
    assert sorted(r[0] for r in read_json_files(spark, str(tmp_path)).select(F.to_json("doc")).collect()) == [
        '{"a":"x"}', '{"a":1}', '{"a":[]}',
    ]
