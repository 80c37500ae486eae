import json

import pytest
from conftest import column, values
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tablebridge.operators.conform import REJECTS, conform, conform_with_rejects
from tablebridge.operators.discover import TooManyKeys, discover
from tablebridge.spec import SpecError, parse_spec


def spec(strategy, title="String", qty="I32"):
    return {
        "title": {"dtype": title, "dtype_collision_strategy": strategy},
        "qty": {"dtype": qty, "dtype_collision_strategy": strategy},
    }


def one(dtype, strategy, **more):
    return {"v": {"dtype": dtype, "dtype_collision_strategy": strategy, **more}}


def filled(rows, name):
    return {r["id"]: r[name] for r in rows if r[name] is not None}


def test_newcol(dirty):
    done = conform(dirty, {**spec("NewCol"), "absent": {"dtype": "Object", "dtype_collision_strategy": "Cast"}}, "r")
    assert done.rows.columns == [
        "r", "title", "title_i32", "title_object", "title_vecdyn", "qty", "qty_str", "id", "note", "stock",
    ]
    rows = values(done.rows)
    assert filled(rows, "title") == {1: "plum", 8: "pear", 10: "lime"}
    assert filled(rows, "title_i32") == {2: 41}
    assert filled(rows, "title_object") == {5: '{"a":[1,{"b":null}],"c":2.5}', 9: '{"c":"d"}'}
    assert filled(rows, "title_vecdyn") == {3: '["fig","kiwi"]', 7: '[true,7,"x",[8]]'}
    assert filled(rows, "qty") == {1: 10, 3: 12, 6: 14, 7: 15, 9: 17, 10: 18}
    assert filled(rows, "qty_str") == {2: "11", 4: "+13", 8: "16"}
    assert filled(rows, "stock") == {9: 3} and filled(rows, "note") == {3: "ripe"}
    assert done.rejects.count() == 0 and done.clashes == []


def test_cast(dirty):
    done = conform(dirty, spec("Cast"), "r")
    assert column(done.rows, "qty") == [10, 11, 12, 13, None, 14, 15, 16, 17, 18]
    assert column(done.rows, "title") == [
        "plum", "41", "fig kiwi", None, '{"a":[1,{"b":null}],"c":2.5}', None, '[true,7,"x",[8]]', "pear", '{"c":"d"}', "lime",
    ]
    assert done.rejects.count() == 0


def test_remove(dirty):
    rows = values(conform(dirty, spec("Remove"), "r").rows)
    assert list(rows[0]) == ["r", "title", "qty", "id", "note", "stock"]
    assert set(filled(rows, "title")) == {1, 8, 10} and set(filled(rows, "qty")) == {1, 3, 6, 7, 9, 10}


def test_ignore(dirty):
    rows = conform(dirty, spec("Ignore"), "r").rows
    assert dict(rows.dtypes)["title"] == dict(rows.dtypes)["qty"] == "variant"
    assert column(rows, "title")[2] == '["fig","kiwi"]' and column(rows, "qty")[1] == '"11"'
    assert dict(rows.dtypes)["id"] == "int"


BROKEN = [{"$date": "not a date"}, {"$numberInt": "3000000000"}, {"$numberLong": "9" * 20}, {"$numberDecimal": "abc"}]


@pytest.mark.parametrize(
    "dtype, strategy, lost",
    [
        ("I32", "NewCol", 4), ("I64", "NewCol", 4), ("Double64", "NewCol", 4), ("String", "NewCol", 4), ("String", "Cast", 4),
        ("I32", "Cast", 4), ("I64", "Cast", 4), ("I32", "Remove", 1), ("I64", "Remove", 2), ("Double64", "Remove", 1),
    ],
)
def test_malformed_wrappers_are_rejected(make_docs, dtype, strategy, lost):
    done = conform(make_docs([{"v": x} for x in BROKEN]), one(dtype, strategy), "r")
    assert done.rejects.count() == lost
    assert all(r.column == "v" and r.expected == dtype for r in done.rejects.collect())


def test_malformed_wrappers_under_ignore_and_inside_objects(make_docs):
    single = conform(make_docs([{"v": BROKEN[0]}, {"v": {"$date": 5}}]), one("I32", "Ignore"), "r")
    assert column(single.rows, "v", by="r") == [None, 5] and single.rejects.count() == 1
    nested = one("Object", "NewCol", sub_schema={"k": {"dtype": "I32", "dtype_collision_strategy": "new_col"}})
    inner = conform(make_docs([{"v": {"k": x}} for x in BROKEN]), nested, "r")
    assert sorted((r.r, r.column) for r in inner.rejects.collect()) == [(i, "v.k") for i in range(4)]


@pytest.mark.parametrize(
    "dtype, fits, others",
    [
        ("VecString", [["a", "b"], ["a", None], []], [[1], "a", ["a", 1]]),
        ("VecI32", [[1, -2], []], [[2**31], [1.5], ["1"]]),
        ("VecI64", [[1, 2**40], []], [[1.5], [True]]),
        ("VecF64", [[1.5, 2], [1], []], [["1.5"], [None]]),
        ("VecF32", [[1.5], []], [[1e300], "x"]),
        ("Double32", [1.5, {"$numberDouble": "2.5"}], [1e300, 1, "1.5"]),
    ],
)
def test_declared_types_that_only_a_declaration_gives(make_docs, dtype, fits, others):
    done = conform(make_docs([{"v": x} for x in [*fits, *others]]), one(dtype, "NewCol"), "r")
    got = column(done.rows, "v", by="r")
    plain = [2.5 if isinstance(x, dict) else x for x in fits]
    assert got == plain + [None] * len(others)
    spilled = sum(done.rows.where(F.col(c).isNotNull()).count() for c in done.rows.columns if c not in ("r", "v"))
    assert spilled == len(others) and done.rejects.count() == 0


def test_undeclared_keys_in_one_column(make_docs):
    docs = make_docs([{"v": 1, "a": 2, "b": None}, {"v": "x"}, {f"k{i}": i for i in range(2100)}, {}])
    done = conform(docs, one("I32", "NewCol"), "r", rest="others")
    assert done.rows.columns == ["r", "v", "v_str", "others"]
    others = column(done.rows, "others", by="r")
    assert others[0] == '{"a":2}' and others[1] is None and len(json.loads(others[2])) == 2100 and others[3] is None
    assert conform(docs, one("I32", "Cast"), "r", known={}, rest="others").rows.columns == ["r", "others"]


def test_rows_and_rejects_share_an_id(make_docs):
    docs = make_docs([{"v": "a"}, {"v": 1}]).select("doc")
    done = conform(docs, one("I32", "Cast"))
    joined = done.rejects.join(done.rows, "row_id")
    assert [(r.raw_json, r.v) for r in joined.collect()] == [('"a"', None)]


@pytest.mark.parametrize(
    "text, expected",
    [("+7", 7), (" 7 ", None), ("7.5", None), ("3000000000", None), ("", None), ("x", None), ("5\n", None), ("-0", 0)],
)
def test_cast_to_integer_is_strict(make_docs, text, expected):
    done = conform(make_docs([{"v": text}]), one("I32", "Cast"), "r")
    assert done.rows.first().v == expected
    rejected = [r.asDict() for r in done.rejects.collect()]
    if expected is None:
        assert rejected == [{"r": 0, "column": "v", "expected": "I32", "actual": "String", "raw_json": json.dumps(text)}]
    else:
        assert rejected == []


def test_cast_to_other_types_rejects(make_docs):
    done = conform(make_docs([{"v": True}, {"v": 1.5}, {"v": [1]}, {"v": None}, {}]), one("I32", "Cast"), "r")
    assert column(done.rows, "v", by="r") == [None] * 5
    assert sorted((r.r, r.actual, r.raw_json) for r in done.rejects.collect()) == [
        (0, "Bool", "true"), (1, "Double64", "1.5"), (2, "VecDyn", "[1]"),
    ]


def test_cast_to_text(make_docs):
    items = [[], ["a", "b"], ["a", None], 28.5, True, 3000000000, {"$oid": "abc"}, {"$date": {"$numberLong": "5"}}]
    done = conform(make_docs([{"v": x} for x in items]), one("String", "Cast"), "r")
    assert column(done.rows, "v", by="r") == ["", "a b", '["a",null]', "28.5", "true", "3000000000", "abc", "5"]


def test_integer_width(make_docs):
    docs = make_docs([{"v": 2147483647}, {"v": 2147483648}, {"v": -2147483648}, {"v": {"$numberLong": "5"}}])
    rows = conform(docs, one("I32", "NewCol"), "r").rows
    assert column(rows, "v", by="r") == [2147483647, None, -2147483648, None]
    assert column(rows, "v_i64", by="r") == [None, 2147483648, None, 5]
    wide = conform(docs, one("I64", "NewCol"), "r").rows
    assert wide.columns == ["r", "v"]
    assert column(wide, "v", by="r") == [2147483647, 2147483648, -2147483648, 5]
    short = conform(make_docs([{"v": 7}, {"v": 70000}]), one("I16", "NewCol"), "r").rows
    assert dict(short.dtypes) == {"r": "int", "v": "smallint", "v_i32": "int"}
    assert column(short, "v_i32", by="r") == [None, 70000]


def test_spill_name_that_exists(make_docs):
    docs = make_docs([{"v": 1, "v_i32": None}, {"v": "a", "v_i32": 7}, {"v": 2, "v_i32": 9}])
    done = conform(docs, one("String", "NewCol"), "r")
    assert column(done.rows, "v_i32", by="r") == [1, 7, 9]
    assert done.clashes == ["v -> v_i32"]
    assert [(r.r, r.column, r.raw_json) for r in done.rejects.collect()] == [(2, "v", "2")]


def test_spill_name_of_another_type(make_docs):
    done = conform(make_docs([{"v": 1}, {"v_i32": "x"}]), one("String", "NewCol"), "r")
    assert dict(done.rows.dtypes)["v_i32"] == "variant"
    assert column(done.rows, "v_i32", by="r") == ["1", '"x"']


def test_nested_spec(make_docs):
    docs = make_docs([{"v": {"k": 1, "o": "x"}}, {"v": {"k": "a"}}, {"v": "text"}, {"v": {"k": None}}, {}])
    nested = one("Object", "NewCol", sub_schema={"k": {"dtype": "I32", "dtype_collision_strategy": "new_col"}})
    rows = conform(docs, nested, "r").rows
    assert dict(rows.dtypes)["v"] == "struct<k:int,k_str:string,o:string>"
    assert column(rows, "v", by="r") == [
        {"k": 1, "k_str": None, "o": "x"}, {"k": None, "k_str": "a", "o": None}, None,
        {"k": None, "k_str": None, "o": None}, None,
    ]
    assert column(rows, "v_str", by="r") == [None, None, "text", None, None]


def test_nested_spec_of_a_spilled_object(make_docs):
    docs = make_docs([{"v": "text"}, {"v": {"k": "7"}}, {"v": {"k": "x"}}])
    nested = one("String", "NewCol", sub_schema={"k": {"dtype": "I32", "dtype_collision_strategy": "Cast"}})
    done = conform(docs, nested, "r")
    assert [v and v["k"] for v in column(done.rows, "v_object", by="r")] == [None, 7, None]
    assert [(r.r, r.column, r.raw_json) for r in done.rejects.collect()] == [(2, "v.k", '"x"')]


def test_known_that_lacks_types_and_keys_rejects_them(make_docs):
    docs = make_docs([{"v": 1}, {"v": "a"}, {"v": 2, "new": [1]}, {"v": 3, "none": None}])
    done = conform(docs, one("I32", "NewCol"), "r", known={("v",): frozenset({"I32"})})
    assert done.rows.columns == ["r", "v"]
    assert sorted((r.r, r.column, r.actual, r.raw_json) for r in done.rejects.collect()) == [
        (1, "v", "String", '"a"'), (2, "new", "VecDyn", "[1]"),
    ]


def test_stable_types_do_not_depend_on_the_data(make_docs):
    stable = conform(make_docs([{"v": 1, "w": 1}]), one("String", "NewCol"), "r", stable=True).rows
    assert dict(stable.dtypes) == {"r": "int", "v": "string", "v_i32": "int", "w": "variant"}


def test_ignored_keys_and_odd_keys(make_docs):
    docs = make_docs([{"a.b": 1, 'q"t': 2, "q\"'t": 3, "": 4, "back`tick": 5, "gone": 6, "b\\s": 7, "é]": 8}])
    row = conform(docs, None, "r", ignore=["gone"]).rows.first().asDict()
    assert row == {"r": 0, "": 4, "a.b": 1, "back`tick": 5, 'q"t': 2, "q\"'t": 3, "b\\s": 7, "é]": 8}


def test_keys_that_differ_in_case_only(make_docs):
    with pytest.raises(ValueError, match="caseSensitive"):
        conform(make_docs([{"Key": 1}, {"key": 2}]), None, "r")


def test_too_many_keys(make_docs):
    docs = make_docs([{f"k{i}": i} for i in range(30)])
    with pytest.raises(TooManyKeys):
        discover(docs, max_keys=29)
    assert len(discover(docs, max_keys=30)) == 30


def test_extended_json(make_docs):
    docs = make_docs(
        [
            {"_id": {"$oid": "65f0"}, "at": {"$date": "2020-01-01T00:00:00.5Z"}, "n": {"$numberInt": "3"}},
            {"_id": {"$oid": "65f1"}, "at": {"$date": 7}, "d": {"$numberDecimal": "1.5"}, "b": {"$binary": {"base64": ""}}},
            {"o": {"at": [{"$date": "2020-01-01T00:00:00Z"}, {"$date": 9}], "s": 'a{"$oid":"no"}'}},
        ]
    )
    row = {k: [r[k] for r in values(conform(docs, None, "r").rows, by="r")] for k in ("_id", "at", "n", "d", "b", "o")}
    assert row["_id"] == ["65f0", "65f1", None]
    assert row["at"] == [1577836800500, 7, None]
    assert row["n"] == [3, None, None] and row["d"] == [None, 1.5, None]
    assert row["b"] == [None, '{"$binary":{"base64":""}}', None]
    assert json.loads(row["o"][2]) == {"at": [1577836800000, 9], "s": 'a{"$oid":"no"}'}


def test_spec_spellings():
    text = '{"a": {"dtype": "vec_string", "dtype_collision_strategy": "NEW_COL"}, "b": {"dtype": "i32", "dtype_collision_strategy": "cast"}}'
    parsed = parse_spec(text)
    assert (parsed["a"].dtype, parsed["a"].strategy) == ("VecString", "NewCol")
    assert (parsed["b"].dtype, parsed["b"].strategy) == ("I32", "Cast")
    for bad in ("[", "[]", '{"a": 1}', '{"a": {"dtype": "String"}}', '{"a": {"dtype": "x", "dtype_collision_strategy": "Cast"}}'):
        with pytest.raises(SpecError):
            parse_spec(bad)


scalar = st.one_of(
    st.none(), st.booleans(), st.integers(-(2**40), 2**40), st.floats(-1e6, 1e6).map(lambda x: round(x, 3)), st.text("ab1 ", max_size=3)
)
value = st.one_of(scalar, st.lists(scalar, max_size=3), st.dictionaries(st.sampled_from("kl"), scalar, max_size=2))
wrapper = st.sampled_from([*BROKEN, {"$date": 7}, {"$numberInt": "5"}, {"$numberLong": "6"}, {"$numberDecimal": "1.5"}, {"$oid": "x"}])
document = st.dictionaries(st.sampled_from(["title", "qty", "other"]), st.one_of(value, wrapper), max_size=3)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(document, min_size=1, max_size=12))
def test_no_value_is_lost(make_docs, documents):
    docs = make_docs(documents)
    whole = sum(1 for d in documents for v in d.values() if v is not None)

    def accounted(strategy, **types):
        """Values in columns of any type, and rejects."""
        rows, _ = conform_with_rejects(docs, spec(strategy, **types))
        placed = rows.select(*[F.count(F.col(c)).alias(c) for c in rows.columns if c not in ("r", REJECTS)]).first()
        return sum(placed or ()) + rows.agg(F.sum(F.size(REJECTS))).first()[0]

    assert accounted("NewCol") == accounted("Cast", title="I32") == accounted("Cast") == whole


ITEM_SPEC = {
    "list": {
        "dtype": "VecDyn",
        "dtype_collision_strategy": "NewCol",
        "sub_schema": {
            "a": {"dtype": "I32", "dtype_collision_strategy": "NewCol"},
            "b": {"dtype": "I32", "dtype_collision_strategy": "Cast"},
            "o": {"dtype": "Object", "dtype_collision_strategy": "NewCol", "sub_schema": {"z": {"dtype": "String", "dtype_collision_strategy": "Remove"}}},
            "l": {"dtype": "VecDyn", "dtype_collision_strategy": "NewCol", "sub_schema": {"k": {"dtype": "Bool", "dtype_collision_strategy": "NewCol"}}},
        },
    }
}


def test_objects_in_arrays(make_docs):
    docs = make_docs([
        {"list": [{"a": 1, "b": "2"}, {"a": "x", "b": "y"}, 7, None, {"c": [1]}]}, {"list": []}, {"list": None}, {"list": "text"}, {"list": {"a": 3}},
        {"list": [{"o": {"z": "in"}}, {"o": {"z": 5}}, {"o": 6}, {}]},
        {"list": [{"l": [{"k": True}, {"k": 1}, "no", None]}, {"l": []}, {"l": 4}]}, {},
    ])
    rows, rejects, clashes = conform(docs, ITEM_SPEC, "r")
    found = values(rows, by="r")
    empty = dict.fromkeys(("a", "a_str", "b", "c", "o", "o_i32", "l", "l_i32"))
    lists = [r["list"] for r in found]
    assert lists[0] == [empty | {"a": 1, "b": 2}, empty | {"a_str": "x"}, None, None, empty | {"c": lists[0][4]["c"]}] and lists[0][4]["c"] is not None
    assert lists[1:5] == [[], None, None, None] and [r["list_str"] for r in found[1:4]] == [None, None, "text"] and found[4]["list_object"] == '{"a":3}'
    assert lists[5] == [empty | {"o": {"z": "in"}}, empty | {"o": {"z": None}}, empty | {"o_i32": 6}, empty]
    assert lists[6] == [empty | {"l": [{"k": True, "k_i32": None}, {"k": None, "k_i32": 1}, None, None]}, empty | {"l": []}, empty | {"l_i32": 4}]
    assert sorted((r.r, r.column, r.expected, r.actual, r.raw_json) for r in rejects.collect()) == [
        (0, "list[1].b", "I32", "String", '"y"'), (0, "list[2]", "Object", "I32", "7"), (6, "list[0].l[2]", "Object", "String", '"no"'),
    ]
    assert clashes == []


def test_known_elements_reject_what_they_lack(make_docs):
    """Tags and keys that a given ``known`` does not list are rejected inside arrays, too."""
    first = make_docs([{"list": [{"a": 1}]}])
    rows, rejects, _ = conform(make_docs([{"list": [{"a": 2}, {"a": "x"}]}]), ITEM_SPEC, "r", known=discover(first, ITEM_SPEC))
    assert [r.a for r in rows.first()["list"]] == [2, None]
    assert [(r.column, r.raw_json) for r in rejects.collect()] == [("list[1].a", '"x"')]
    plain = conform(make_docs([{"list": [1, 2]}]), ITEM_SPEC, "r").rows  # no object has been seen: the array stays as it is
    assert values(plain, by="r")[0]["list"] == "[1,2]"


def test_rejects_are_never_broadcast(spark):
    """They are as many as the documents, however small the plan's estimate of them is."""
    from tablebridge.registered import QUERIES

    plan = QUERIES["conform_nested_arrays"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
