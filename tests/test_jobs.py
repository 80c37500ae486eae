import json
import uuid
from collections import Counter

import pytest
from conftest import DIRTY, column, values
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tablebridge.functions.rows import encode_nested, normalise_sql
from tablebridge.operators.columns import ignore_columns, missing_columns, select_existing
from tablebridge.operators.conform import conform
from tablebridge.operators.discover import batch_plan, discover
from tablebridge.operators.locate import differing_ranges, locate_differences
from tablebridge.operators.reconcile import differences, reconcile, replicate
from tablebridge.plans.migrate import RejectedValues, export_documents, migrate_bulk, migrate_documents, migrate_table, migrate_typed
from tablebridge.registered.tables import jdbc_target
from tablebridge.sinks.append import JdbcSink, ParquetSink, SchemaChange, append, evolve
from tablebridge.sinks.once import append_once, merge, stage
from tablebridge.sinks.bulk import BulkSink, argument_rows, bulk_payloads
from tablebridge.sinks.bulk_tasks import BulkDataSource, BulkWriter, DeliveryError, chunker, insert_statement
from tablebridge.sources.tables import count_jdbc, count_table, jdbc_names, list_databases, list_tables, read_table, split_by, split_evenly, table_inventory
from tablebridge.streaming.migrate import KNOWN, read_migrated, stream_migrate, stream_report

SPEC = {
    "title": {"dtype": "String", "dtype_collision_strategy": "NewCol"},
    "qty": {"dtype": "I32", "dtype_collision_strategy": "NewCol"},
}


@pytest.fixture(scope="module")
def wide(spark):
    """One column of every type that a SQL table may have."""
    return spark.range(6).selectExpr(
        "id AS number", "concat('row ', id) AS words", "cast(id - 3 AS smallint) AS short", "cast(id AS int) AS whole",
        "cast(id / 4 AS float) AS single", "id / 8 AS twice", "id % 2 = 0 AS even", "cast(NULL AS string) AS nothing",
        "cast(id * 1.25 AS decimal(9,2)) AS price", "date'2021-02-03' AS day", "timestamp_ntz'2021-02-03 04:05:06.5' AS at",
        "timestamp'2021-02-03 04:05:06+00:00' AS moment", "array(id, id + 1) AS numbers", "array('u', NULL) AS names",
        "cast(array() AS array<double>) AS none", "array(array(id)) AS lists", "named_struct('k', id, 'n', NULL) AS pair",
        "CASE id % 3 WHEN 0 THEN '[1, 2.5]' WHEN 1 THEN '[\"s\", 4]' ELSE '{\"o\": [5]}' END AS json", "'[7]' AS only_numbers",
    )


def test_migrating_the_wide_table(spark, wide, tmp_path):
    sink = ParquetSink(str(tmp_path / "sink"))
    before = sink.read(spark)
    report = migrate_table(wide, sink, ignore=["moment", "lists", "no such"], json_columns=["json", "only_numbers", "absent"])
    back = sink.read(spark)
    assert before is None and back.count() == 6
    assert set(back.columns) == set(wide.columns) - {"moment", "lists", "json"} | {"json_vec_f64", "json_vecstring", "json_str"}
    row = back.orderBy("number").first()
    assert row.at == "2021-02-03 04:05:06.500" and row.day == "2021-02-03" and row.none == [] and row.pair == '{"k":0,"n":null}'
    assert row.json_vec_f64 == [1.0, 2.5] and row.json_vecstring is None and row.only_numbers == [7.0]
    assert column(back, "json_vecstring", by="number")[1] == ["s", "4"] and column(back, "json_str", by="number")[2] == '{"o":[5]}'
    steps = {r.step: r for r in report.collect()}
    assert steps["append"].rows == steps["total"].rows == 6
    assert steps["total"].rows_per_s is None or steps["total"].rows_per_s > 0


def test_migrating_typed_documents(spark, dirty, tmp_path):
    sink = ParquetSink(str(tmp_path / "typed"))
    migrate_typed(dirty, sink, ignore=["note"])
    rows = sink.read(spark)
    assert dict(rows.dtypes) == {
        "r": "int", "id": "int", "stock": "int", "qty_i32": "int", "qty_str": "string", "title_i32": "int",
        "title_str": "string", "title_vecstring": "array<string>",
    }
    assert column(rows, "title_vecstring")[6] == ["true", "7", "x", "[8]"] and column(rows, "qty_i32")[9] == 18


def test_normalise_sql_types(spark):
    df = spark.sql(
        "SELECT timestamp_ntz'2024-01-01 00:00:00' AS a, timestamp_ntz'2024-01-01 00:00:00.5' AS b, "
        "date'2024-01-02' AS c, cast(1.5 AS decimal(5,2)) AS d, named_struct('x', 1, 'y', NULL) AS e, X'41' AS f, 5L AS g"
    )
    assert normalise_sql(df).first().asDict() == {
        "a": "2024-01-01 00:00:00", "b": "2024-01-01 00:00:00.500", "c": "2024-01-02", "d": df.first().d,
        "e": '{"x":1,"y":null}', "f": "A", "g": 5,
    }
    assert encode_nested(df.select("e", F.array("g").alias("l")), arrays=False).dtypes == [("e", "string"), ("l", "array<bigint>")]


def test_choosing_columns(spark):
    df = spark.range(1).selectExpr("id", "1 AS `a.b`", "2 AS c")
    assert ignore_columns(df, ["c", "nope"]).columns == ["id", "a.b"]
    assert ignore_columns(df, []).columns == df.columns
    assert select_existing(df, ["c", "nope", "a.b"]).columns == ["c", "a.b"]
    assert missing_columns(df, df.drop("c")) == ["c"]


def test_counting(spark):
    assert count_table(spark, "no_such_table").first().n == 0
    assert count_table(spark, spark.range(7)).first().n == 7
    assert {r.name: r.n for r in table_inventory({"a": spark.range(3), "b": spark.range(0)}).collect()} == {"a": 3, "b": 0}
    assert "default" in list_databases(spark)
    assert list_tables(spark, "no_such_database") == []


def test_jdbc(spark, dirty):
    url, properties = jdbc_target(spark)
    name = f"T{uuid.uuid4().hex}".upper()
    sink = JdbcSink(url, name, properties=properties, max_connections=2)
    rows = conform(dirty, SPEC, "r").rows
    sink.write(rows)
    assert sink.count(spark) == count_jdbc(spark, url, name, properties) == 10
    assert name in {r.name for r in jdbc_names(spark, url, "tables", "APP", properties).collect()}
    append(rows, sink, key=["r"])
    assert sink.count(spark) == 10
    bounds = split_by(spark, url, name, "r", 3, properties)
    assert (bounds.lower, bounds.upper) == (0, 9)
    back = read_table(spark, url, name, bounds, columns=["r", "title_vecdyn"], properties=properties)
    assert back.rdd.getNumPartitions() == 3
    assert column(back, "title_vecdyn", by="r")[2] == '["fig","kiwi"]'
    split = JdbcSink(url, name, properties=properties, partition=bounds)
    append(rows, split, key=["r"])
    assert split.read(spark).rdd.getNumPartitions() == 3 and split.count(spark) == 10
    with pytest.raises(SchemaChange, match="no columns w"):
        append(rows.withColumn("w", F.lit(1)), sink)
    assert count_jdbc(spark, url, "NO_SUCH_TABLE", properties) == 0
    with pytest.raises((PySparkException, Py4JJavaError)):
        count_jdbc(spark, url, "a table, badly written(", properties)
    cut = read_table(spark, url, name, predicates=['"r" < 5', '"r" >= 5'], properties=properties)
    assert reconcile(encode_nested(rows), cut, ["r"]).first().matches
    with pytest.raises(ValueError):
        jdbc_names(spark, "jdbc:sqlite:x", "tables")


def test_an_empty_folder_is_no_table(spark, tmp_path):
    sink = ParquetSink(str(tmp_path))
    assert sink.read(spark) is None
    append(spark.range(2), sink)
    assert sink.read(spark).count() == 2


def test_appending_files(spark, tmp_path):
    sink, df = ParquetSink(str(tmp_path / "p")), spark.range(3).selectExpr("id", "id AS v")
    append(df, sink)
    append(spark.range(5).selectExpr("id", "id AS v"), sink, key=["id"])
    assert column(sink.read(spark), "v") == [0, 1, 2, 3, 4]
    with pytest.raises(SchemaChange, match="no columns w"):
        append(df.withColumn("w", F.lit(1)), sink)
    with pytest.raises(SchemaChange, match="change type"):
        append(df.withColumn("v", F.lit("x")), sink)
    growing = ParquetSink(str(tmp_path / "p"), evolve=True)
    append(spark.range(9, 10).selectExpr("id", "id AS v", "'new' AS w"), growing)
    assert column(growing.read(spark), "w") == [None] * 5 + ["new"]
    assert column(evolve([df, spark.range(7, 8).selectExpr("id", "'x' AS w")]), "w") == [None, None, None, "x"]


def test_types_widen_over_appends(spark, tmp_path):
    sink = ParquetSink(str(tmp_path / "w"), evolve=True)

    def add(*columns):
        append(spark.range(1).selectExpr(*columns), sink)

    add("1 AS id", "cast(7 AS smallint) AS n", "cast(0.5 AS float) AS x", "array(1) AS l", "named_struct('a', 1) AS s")
    assert sink.schema(spark) is None
    add("2 AS id", "8 AS n", "0.25D AS x", "array(2L) AS l", "named_struct('a', 2L, 'b', 'new') AS s")
    add("3 AS id", "5000000000 AS n", "cast(0.5 AS float) AS x", "array(3) AS l", "named_struct('a', 3) AS s")
    add("4 AS id", "cast(9 AS tinyint) AS n", "'late' AS w")
    back = sink.read(spark)
    assert back.schema.simpleString() == "struct<id:int,n:bigint,x:double,l:array<bigint>,s:struct<a:bigint,b:string>,w:string>"
    assert column(back, "n") == [7, 8, 5_000_000_000, 9] and column(back, "x") == [0.5, 0.25, 0.5, None] and column(back, "l") == [[1], [2], [3], None]
    assert column(back, "s") == [{"a": 1, "b": None}, {"a": 2, "b": "new"}, {"a": 3, "b": None}, None] and column(back, "w") == [None] * 3 + ["late"]
    for wrong in ("'x' AS n", "1.5D AS n", "array('x') AS l", "named_struct('a', 'x') AS s"):
        with pytest.raises(SchemaChange, match="change type"):
            add("5 AS id", wrong)
    parts = [spark.sql("SELECT 1 AS id, 2 AS v"), spark.sql("SELECT 2 AS id, 3L AS v"), spark.sql("SELECT 3 AS id")]
    assert evolve(parts).dtypes == [("id", "int"), ("v", "bigint")] and column(evolve(parts), "v") == [2, 3, None]


def test_even_parts_of_a_hot_key(spark):
    url, properties = jdbc_target(spark)
    name = f"T{uuid.uuid4().hex}".upper()
    rows = spark.range(1200).selectExpr(
        "CASE WHEN id % 2 = 0 THEN 40 WHEN id % 100 = 1 THEN NULL ELSE id END AS k", "CASE WHEN id % 50 = 0 THEN NULL ELSE id END AS t",
        "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, id % 7) AS at", "id",
    )
    JdbcSink(url, name, properties=properties).write(rows)
    for column_, tie, most in (("k", "t", 300), ("at", "id", 300), ("id", None, 300), ("k", None, 700)):
        for sample in (1.0, 0.5):
            parts = split_evenly(spark, url, name, column_, 8, tie, sample, properties=properties)
            back = read_table(spark, url, name, predicates=parts, properties=properties)
            sizes = [r["count"] for r in back.groupBy(F.spark_partition_id()).count().collect()]
            assert sorted(r.id for r in back.select("id").collect()) == list(range(1200)) and max(sizes) <= most
    assert split_evenly(spark, url, name, "k", 1, properties=properties) == ["1 = 1"]


def test_reconcile(spark):
    a = spark.createDataFrame([(1, "a", None), (1, "a", None), (2, None, "a"), (3, "c", "c")], "k int, x string, y string")
    b = spark.createDataFrame([(1, "a", None), (2, "a", None), (4, "d", "d")], "k int, x string, y string")
    found = {"n_a": 4, "n_b": 3, "missing": 3, "extra": 2, "missing_columns": "", "extra_columns": "", "matches": False}
    assert reconcile(a, b, ["k"]).first().asDict() == found
    assert {(r.k, r.n_a, r.n_b) for r in differences(a, b, ["k"]).collect()} == {(1, 2, 1), (2, 1, 0), (2, 0, 1), (3, 1, 0), (4, 0, 1)}
    assert reconcile(a, a.repartition(3), ["k"]).first().matches
    assert reconcile(a.where("false"), a.where("false"), ["k"]).first().asDict()["n_a"] == 0


@pytest.mark.parametrize(
    "one, other",
    [
        ("array(1, NULL)", "array(NULL, 1)"), ("array(1, NULL)", "array(1)"), ("named_struct('x', 1, 'y', NULL)", "named_struct('x', NULL, 'y', 1)"),
        ("array(named_struct('x', 1, 'y', NULL))", "array(named_struct('x', NULL, 'y', 1))"), ("map('a', NULL)", "map('b', NULL)"),
        ("cast(NULL AS array<int>)", "cast(array() AS array<int>)"),
    ],
)
def test_reconcile_sees_nulls_in_nested_values(spark, one, other):
    a, b = spark.sql(f"SELECT 1 AS k, {one} AS v"), spark.sql(f"SELECT 1 AS k, {other} AS v")
    assert not reconcile(a, b, ["k"]).first().matches and reconcile(a, a, ["k"]).first().matches


MICROS = "timestamp_ntz'2024-05-06 07:08:09.00000{0}'"


@pytest.mark.parametrize("kind", ["{0}", "array({0})", "named_struct('t', {0}, 'y', NULL)", "map('k', array(named_struct('t', {0})))", "array(array({0}))"])
@pytest.mark.parametrize("value", [MICROS, MICROS.replace("_ntz", ""), "cast({0} AS float) / 8", "X'0{0}'", "date'2024-05-0{0}'", "1.2{0}BD", "cast({0} AS tinyint)"])
def test_reconcile_tells_nested_values_apart(spark, kind, value):
    one, same, other = (spark.sql(f"SELECT 1 AS k, {kind.format(value.format(i))} AS v") for i in (1, 1, 2))
    assert reconcile(one, same, ["k"]).first().matches and not reconcile(one, other, ["k"]).first().matches


@pytest.mark.parametrize(
    "one, other, equal",
    [
        ("map('a', 1, 'b', 2)", "map('b', 2, 'a', 1)", True), ("map('a', 1, 'b', 2)", "map('a', 2, 'b', 1)", False), ("1", "1L", True),
        ("array(1S)", "array(1L)", True), ("1.5F", "1.5D", True), ("1.50BD", "1.5BD", True), ("100BD", "1BD", False), ("'1'", "1", False),
        ("array(array(1), array(2))", "array(array(1, 2))", False), ("array(array(1), array())", "array(array(), array(1))", False),
        ("named_struct('x', 1)", "named_struct('y', 1)", False), ("parse_json('[1,2]')", "parse_json('[1, 2]')", True), ("parse_json('1')", "parse_json('2')", False),
        ("cast(NULL AS int)", "0", False), ("date'2024-01-01'", "timestamp_ntz'2024-01-01 00:00:00'", False),
    ],
)
def test_reconcile_compares_by_value_within_a_family(spark, one, other, equal):
    a, b = spark.sql(f"SELECT 1 AS k, {one} AS v"), spark.sql(f"SELECT 1 AS k, {other} AS v")
    assert reconcile(a, b, ["k"]).first().matches == equal


@pytest.mark.parametrize("kind", ["array({0})", "named_struct('t', {0}, 'y', NULL)", "map('k', {0})"])
def test_json_text_keeps_microseconds_and_nulls(spark, kind, tmp_path):
    df = spark.sql(f"SELECT {kind.format(MICROS.format(3))} AS v, {MICROS.format(4)} AS t")
    export_documents(df, str(tmp_path / "out"))
    line = spark.read.text(str(tmp_path / "out")).first().value
    for text in (encode_nested(df).first().v, normalise_sql(df).first().v if "array" not in kind else json.dumps(json.loads(line)["v"]), line):
        assert "2024-05-06T07:08:09.000003" in text and ("y" not in kind or '"y":null' in text.replace(" ", "") or "array" in kind or "map" in kind)
    assert "09.000004" in line and normalise_sql(df).first().t == "2024-05-06 07:08:09.000004"


def rows_of_two(spark, n=20000):
    a = spark.range(n).selectExpr("id * 3 AS k", "id % 7 AS l", "concat('v', id) AS v", "array(id, NULL) AS w")
    changed = a.selectExpr("k", "l", "CASE WHEN k = 30000 THEN 'x' ELSE v END AS v", "CASE WHEN k = 45 THEN array(id_, 1L) ELSE w END AS w".replace("id_", "l"))
    b = changed.where("k <> 59997").unionByName(spark.sql("SELECT 7L AS k, 0L AS l, 'new' AS v, cast(NULL AS array<bigint>) AS w"))
    return a, b


def test_differences_are_located_by_ranges(spark, tmp_path):
    a, b = rows_of_two(spark)
    for name, df in (("a", a), ("b", b)):
        df.repartitionByRange(40, "k").write.parquet(str(tmp_path / name))
    a, b = (spark.read.parquet(str(tmp_path / name)) for name in "ab")
    found = {tuple(r[:-1]): r.columns for r in locate_differences(a, b, ["k", "l"], fanout=8, short=50).collect()}
    assert found == {(30000, 10000 % 7, 1, 1): ["v"], (45, 1, 1, 1): ["w"], (59997, 19999 % 7, 1, 0): [], (7, 0, 0, 1): []}
    ranges = differing_ranges(a, b, ["k", "l"], fanout=8, short=50)
    read = a.where(" OR ".join(f"(k >= {r.low or 0} AND k < {r.high or 10**9})" for r in ranges)).count()
    assert len(ranges) <= 4 and read <= 200  # of 20,000 rows
    plan = locate_differences(a, b, ["k", "l"], fanout=8, short=50)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ThanOrEqual(k,") >= 2 and "PushedFilters: []" not in plan
    assert locate_differences(a, a, ["k"]).count() == 0 and differing_ranges(a, a, ["k"]) == []


def test_differences_of_odd_keys(spark):
    rows = [(None, "a", 1), (None, "a", 2), ("x", "a", 1), ("x", "b", 2), ("y", "c", None), ("z", "d", 4)]
    a = spark.createDataFrame(rows * 50, "k string, v string, n int")
    b = spark.createDataFrame((rows * 50)[1:-1] + [("x", "b", 1), ("y", "c", 0), (None, None, None)], "k string, v string, n int")
    found = {r.k: (r.n_a, r.n_b, r.columns) for r in locate_differences(a, b, ["k"], fanout=4, short=10).collect()}
    assert found == {None: (100, 100, ["v", "n"]), "x": (100, 101, ["v", "n"]), "y": (50, 51, ["v", "n"]), "z": (50, 49, ["v", "n"])}
    # Columns that agree one by one, but not together.
    a, b = (spark.createDataFrame(r, "k int, v int, w int") for r in ([(1, 1, 2), (1, 3, 4)], [(1, 1, 4), (1, 3, 2)]))
    assert [tuple(r) for r in locate_differences(a, b, ["k"]).collect()] == [(1, 2, 2, ["v", "w"])]
    one = spark.range(3).selectExpr("cast(id AS int) AS k", "id AS v")
    assert locate_differences(one, one.selectExpr("cast(k AS bigint) AS k", "v"), ["k"]).count() == 0
    assert [r.k for r in locate_differences(one, one.limit(0), ["k"]).orderBy("k").collect()] == [0, 1, 2]


def test_reconcile_names_columns_of_one_side(spark):
    a, b = spark.sql("SELECT 1 AS k, 2 AS v, 3 AS w"), spark.sql("SELECT 1 AS k, 4 AS x")
    found = reconcile(a, b, ["k"]).first()
    assert (found.missing, found.extra, found.missing_columns, found.extra_columns, found.matches) == (0, 0, "v,w", "x", False)


def test_copies_spread_over_the_partitions(spark):
    copies = replicate(spark.range(3), 40 * 4096)
    filled = copies.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert sum(r["count"] for r in filled) == 3 * 40 * 4096 and len(filled) == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_keyed_append_with_nulls_and_repeats(spark, tmp_path):
    sink = ParquetSink(str(tmp_path / "keyed"))
    rows = spark.createDataFrame([(1, None, "a"), (1, None, "a"), (None, None, "b"), (1, 2, "c")], "k int, l int, v string")
    for _ in range(2):
        append(rows, sink, ["k", "l"])
    assert sorted(r.v for r in sink.read(spark).collect()) == ["a", "b", "c"]


def test_keyed_append_keeps_the_same_row_and_reports_the_others(spark, tmp_path):
    rows = [(i % 5, f"v{i % 15}", [i % 15], None) for i in range(60)] + [(9, "only", [], 1), (9, "only", [], 1)]
    df = spark.createDataFrame(rows, "k int, v string, l array<int>, n int")
    kept = []
    for i, parts in enumerate((1, 3, 7)):
        sink = ParquetSink(str(tmp_path / str(i)))
        report = {r.step: r.rows for r in migrate_table(df.repartition(parts), sink, key=["k"]).collect()}
        assert report == {"append": 6, "repeated": 55, "total": 6}
        kept.append(sorted((r.k, r.v, tuple(r.l)) for r in sink.read(spark).collect()))
    assert kept[0] == kept[1] == kept[2] and len(kept[0]) == 6


def test_append_once_survives_a_part_that_fails_half_way(spark):
    url, properties = jdbc_target(spark)
    sink, run = JdbcSink(url, f"T{uuid.uuid4().hex}".upper(), properties=properties, batch_size=10), uuid.uuid4().hex
    rows = spark.range(0, 400, 1, 4).selectExpr("id", "concat('v', id) AS v", "array(id) AS l")
    append_once(rows.where("id < 0"), sink)
    broken = rows.withColumn("v", F.expr("CASE WHEN id = 250 THEN raise_error('half way') ELSE v END"))
    with pytest.raises((PySparkException, Py4JJavaError)):
        append_once(broken, sink, run)
    assert sink.count(spark) == 0  # whatever the other parts had staged
    assert append_once(rows, sink, run) == 400 and append_once(rows, sink, run) == 0
    assert sorted(r.id for r in sink.read(spark).select("id").collect()) == list(range(400))
    assert append_once(rows.selectExpr("id + 400 AS id", "v", "l"), sink) == 400 and sink.count(spark) == 800
    with pytest.raises(SchemaChange):
        append_once(rows.withColumn("w", F.lit(1)), sink)
    with pytest.raises(ValueError):
        append_once(rows, sink, "x; drop")
    left = {r.name for r in jdbc_names(spark, url, "tables", "APP", properties).collect() if r.name.startswith(sink.table)}
    assert left == {sink.table, f"{sink.table}_RUNS"}


def test_of_several_attempts_at_a_part_one_counts(spark):
    url, properties = jdbc_target(spark)
    sink, run = JdbcSink(url, f"T{uuid.uuid4().hex}".upper(), properties=properties), uuid.uuid4().hex
    rows = spark.range(0, 90, 1, 3).selectExpr("id", "id % 2 AS `odd \"name\"`")
    append_once(rows.limit(0), sink)
    for tried in (rows.where("id % 4 = 0"), rows, rows):  # cut short, whole, and whole again
        stage(tried, sink, run)
    assert merge(spark, sink, run, rows.columns) == 90 and merge(spark, sink, run, rows.columns) == 0
    assert sorted(r.id for r in sink.read(spark).collect()) == list(range(90))


@pytest.mark.parametrize("n", [0, 1, 3, 4096, 4097, 10000])
def test_replicate(spark, n):
    copies = replicate(spark.range(2), n)
    assert copies.count() == 2 * n
    assert copies.distinct().count() == 2 * n
    if n:
        assert copies.agg(F.max("copy"), F.min("copy")).first()[:] == (n - 1, 0)


def test_rejects_do_not_work_the_documents_out_twice(spark, tmp_path):
    """A filter on the rejects array would be moved to the source, with a copy of every expression."""
    from tablebridge.sources.documents import read_documents

    (tmp_path / "a.json").write_text("\n".join(DIRTY))
    docs = read_documents(spark, str(tmp_path)).docs
    cast = {"title": {"dtype": "I32", "dtype_collision_strategy": "Cast"}}
    plan = conform(docs, cast).rejects._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") == 1
    # One kind per key; qty is mixed and undeclared, so it is never rejected and is pruned.
    assert plan.count("schemaOfVariant") == 4


def test_documents_through_files(spark, tmp_path):
    rows = spark.createDataFrame([(1, None, [1]), (2, 'q"\n', [])], "a int, b string, c array<int>")
    export_documents(rows, str(tmp_path / "out"))
    lines = sorted(r.value for r in spark.read.text(str(tmp_path / "out")).collect())
    assert [json.loads(line) for line in lines] == [{"a": 1, "b": None, "c": [1]}, {"a": 2, "b": 'q"\n', "c": []}]


def test_migrating_documents(spark, dirty, tmp_path):
    rows, rejects = ParquetSink(str(tmp_path / "rows")), ParquetSink(str(tmp_path / "rejects"))
    cast = {"title": {"dtype": "I32", "dtype_collision_strategy": "Cast"}}
    report = migrate_documents(dirty, rows, cast, ignore=["note"], row_id="r", rejects=rejects)
    assert [r.step for r in report.collect()] == ["discover", "append", "rejects", "total"]
    assert column(rows.read(spark), "title")[1] == 41 and "note" not in rows.read(spark).columns
    assert sorted(r.r for r in rejects.read(spark).collect()) == [0, 2, 4, 6, 7, 8, 9]
    with pytest.raises(RejectedValues, match="7 values"):
        migrate_documents(dirty, ParquetSink(str(tmp_path / "other")), cast)


def test_migrating_documents_without_keys(spark, make_docs, tmp_path):
    sink = ParquetSink(str(tmp_path / "empty"))
    report = migrate_documents(make_docs([{}, {}]).select("doc"), sink)
    assert sink.read(spark).count() == 2 and {r.rows for r in report.collect() if r.step == "append"} == {2}


def unpack(payloads):
    for payload in payloads:
        body = json.loads(payload.payload)
        assert body["stmt"] == payload.stmt and len(body["bulk_args"]) == payload.n_rows
        columns = json.loads("[" + payload.stmt[payload.stmt.index("(") + 1 : payload.stmt.index(")")] + "]")
        assert columns == json.loads(payload.shape)
        for args in body["bulk_args"]:
            yield dict(zip(columns, args, strict=True))


def test_bulk_payloads(dirty):
    payloads = bulk_payloads(dirty.coalesce(1), "doc", "t", size=4).collect()
    assert sorted(p.n_rows for p in payloads if p.shape == '["id","qty","title"]') == [2, 4]
    assert {p.stmt for p in payloads if p.shape == '["id","title"]'} == {'INSERT INTO "doc"."t" ("id","title") VALUES (?,?)'}
    sent = sorted(unpack(payloads), key=lambda d: d["id"])
    assert sent[2] == {"id": 3, "title": ["fig", "kiwi"], "qty": 12, "note": "ripe"}
    assert sent[4] == {"id": 5, "title": '{"a":[1,{"b":null}],"c":2.5}'}
    assert sent[6] == {"id": 7, "title": ["true", "7", "x", "[8]"], "qty": 15} and sent[9]["qty"] == 18
    planned = {r.shape: r.n_batches for r in batch_plan(dirty.coalesce(1), 4).collect()}
    assert planned == Counter(p.shape for p in payloads)
    assert bulk_payloads(dirty.limit(0), "doc", "t").count() == 0
    assert [set(d) for d in sent] == [set(json.loads(d)) for d in DIRTY]


@pytest.mark.parametrize("tasks", [1, 3, 8])
def test_full_batches_on_any_partitioning(make_docs, tasks):
    docs = make_docs([{"i": i, **({"a": "x" * (i % 7)} if i % 3 else {"b": None})} for i in range(200)] + [{}]).repartition(tasks, "r")
    payloads = bulk_payloads(docs, "s", "t", size=30, full=True).collect()
    sizes = {}
    for p in payloads:
        sizes.setdefault(p.shape, []).append(p.n_rows)
    assert {k: sorted(v) for k, v in sizes.items()} == {'["a","i"]': [13, 30, 30, 30, 30], '["b","i"]': [7, 30, 30]}
    assert {r.shape: r.n_batches for r in batch_plan(docs.where("r < 200"), 30, full=True).collect()} == {k: len(v) for k, v in sizes.items()}
    assert sorted(d["i"] for d in unpack(payloads)) == list(range(200))
    small = bulk_payloads(docs, "s", "t", size=30, max_bytes=50, full=True).collect()
    assert sorted(d["i"] for d in unpack(small)) == list(range(200)) and max(p.n_rows for p in small) < 30


def test_bulk_arguments_equal_the_http_normaliser(make_docs):
    from tablebridge.operators.align import normalise

    items = [None, 1, 2**40, 1.5, 28.0, True, "x", 'q"', [], [1.5, 2], [1, "a"], {"a": 1}, {"$oid": "z"}, {"$date": 1}, {"$numberDecimal": "2.5"}, {"b": {"$oid": "y"}}, [{"$oid": "x"}]]
    docs = make_docs([{"v": item} for item in items])
    cells = normalise(docs, "http", ["v"]).orderBy("r").select(F.coalesce(F.to_json("v.value"), F.lit("null"))).collect()
    assert [r.args for r in argument_rows(docs).orderBy("r").collect()] == [f"[{c[0]}]" for c in cells]


def test_documents_without_keys_have_no_statement(make_docs):
    payloads = bulk_payloads(make_docs([{}, {"order": 1, "index": 2}]).coalesce(1), "doc", "t").collect()
    assert [p.stmt for p in payloads] == ['INSERT INTO "doc"."t" ("index","order") VALUES (?,?)']


@pytest.mark.parametrize("max_bytes", [10**9, 25, 1])
def test_chunks_are_bounded_and_whole_for_many_shapes(max_bytes):
    import pyarrow as pa

    keys = sorted(f'["k{i % 50 if i % 3 else 0}"]' for i in range(5000))
    batches = [
        pa.RecordBatch.from_arrays([pa.array(keys[i : i + 700]), pa.array([f"[{j}]" for j in range(i, min(i + 700, 5000))])], names=["keys", "args"])
        for i in range(0, 5000, 700)
    ]
    out = [row for batch in chunker("s", "t", 7, False, max_bytes)(iter(batches)) for row in batch.to_pylist()]
    got = [(row["shape"], args[0]) for row in out for args in json.loads(row["payload"])["bulk_args"]]
    assert got == [(k, i) for i, k in enumerate(keys)]
    lists = [[len(json.dumps(args)) for args in json.loads(row["payload"])["bulk_args"]] for row in out]
    assert all(len(x) <= 7 and (sum(x) <= max_bytes or len(x) == 1) for x in lists)
    if max_bytes == 10**9:
        shapes = Counter(keys)
        assert len(out) == sum(-(-n // 7) for n in shapes.values())


def test_statements():
    assert insert_statement("s", "t", ["a", "B c", 'x"y'], True) == 'INSERT INTO "s"."t" ("a","B c","x""y") VALUES (?,?,?) ON CONFLICT DO NOTHING'


def test_delivery(spark, dirty, tmp_path):
    class FolderSource(BulkDataSource):
        """Writes every payload to a file of the folder named as url."""

        @classmethod
        def name(cls):
            return "bulk_folder"

        def writer(self, schema, overwrite):
            def send(url, payload, timeout):
                import pathlib
                import uuid

                pathlib.Path(url, uuid.uuid4().hex).write_text(payload)
                return {"results": [{"rowcount": 1}]}

            return BulkWriter(self.options["url"], 1.0, send)

    report = migrate_bulk(dirty, BulkSink(str(tmp_path), "doc", "t", 3, source=FolderSource), ignore=["note"])
    bodies = [json.loads(p.read_text()) for p in tmp_path.iterdir()]
    assert sum(len(b["bulk_args"]) for b in bodies) == 10 and max(len(b["bulk_args"]) for b in bodies) <= 3
    assert not any("note" in b["stmt"] for b in bodies)
    assert {r.step: r.rows for r in report.collect()} == {"append": 10, "total": 10}


def test_refused_rows_fail_the_task(spark, dirty):
    row = {"payload": "{}", "n_rows": 2}
    with pytest.raises(DeliveryError, match="1 of 2 rows refused, first at 1"):
        BulkWriter("u", 1.0, lambda *_: {"results": [{"rowcount": 1}, {"rowcount": -2}]}).write(iter([row]))
    done = BulkWriter("u", 1.0, lambda *_: {"results": [{"rowcount": 1}] * 2}).write(iter([row, row]))
    assert (done.payloads, done.rows) == (2, 4)
    with pytest.raises(PySparkException):
        migrate_bulk(dirty, BulkSink("http://127.0.0.1:1/_sql", "doc", "t"))


def test_stream_equals_batch(spark, dirty, tmp_path):
    inbox, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    inbox.mkdir()
    for i in range(0, len(DIRTY), 4):
        (inbox / f"{i}.json").write_text("\n".join(DIRTY[i : i + 4]) + "\n")
    (inbox / "bad.json").write_text("{oops\n")
    (inbox / "empty.json").write_text("{}\n{}\n")

    def run(**more):
        stream_migrate(spark, str(inbox), out, SPEC, state, max_files_per_trigger=1, **more).awaitTermination()

    run()
    batch = conform(dirty, SPEC, "r", stable=True).rows
    rows = read_migrated(spark, out)
    assert rows.where("id IS NULL").count() == 2 and rows.where("row_id IS NULL").count() == 0
    shown = values(rows.where("id IS NOT NULL"), drop=["batch_id", "row_id"])
    assert shown == values(batch.select(*[c for c in batch.columns if c != "r"]))
    assert [r.raw for r in read_migrated(spark, out, "malformed").collect()] == ["{oops"]
    assert read_migrated(spark, out, "rejects") is None
    (inbox / "late.json").write_text('{"id":99,"title":1.5}\n')
    run()
    late = read_migrated(spark, out)
    assert late.count() == 13 and column(late.where("id::int = 99"), "title_f64") == [1.5]


def test_stream_with_fixed_keys_rejects_what_they_lack(spark, tmp_path):
    inbox, out = tmp_path / "in", str(tmp_path / "out")
    inbox.mkdir()
    (inbox / "a.json").write_text('{"title":"a"}\n{"title":5}\n{"title":"b","odd":true}\n')
    known = {("title",): frozenset({"String"})}
    stream_migrate(spark, str(inbox), out, SPEC, str(tmp_path / "state"), known=known).awaitTermination()
    assert column(read_migrated(spark, out), "title", by="title") == ["a", "b", None]
    assert sorted((r.column, r.raw_json) for r in read_migrated(spark, out, "rejects").collect()) == [("odd", "true"), ("title", "5")]


def test_a_stream_keeps_what_it_knows(spark, tmp_path, monkeypatch):
    """Only batches with new keys or tags are searched; the state outlives the query, and a batch that runs again finds its own."""
    import tablebridge.streaming.migrate as module

    searched = []
    monkeypatch.setattr(module, "discover", lambda docs, *a, **k: searched.append(1) or discover(docs, *a, **k))
    inbox, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    inbox.mkdir()

    def run(name, *lines):
        (inbox / name).write_text("\n".join(lines) + "\n")
        stream_migrate(spark, str(inbox), out, SPEC, state, max_files_per_trigger=1).awaitTermination()
        return len(searched)

    assert run("a.json", '{"title":"a","qty":1}') == 1
    assert run("b.json", '{"title":"b"}', '{"qty":2}', "{oops") == 1
    assert run("c.json", '{"title":5,"extra":{"x":1}}') == 2  # a new tag and a new key
    assert run("d.json", '{"title":6,"extra":[1]}', '{"title":"d"}') == 2
    rows = read_migrated(spark, out)
    assert read_migrated(spark, out, "rejects") is None
    assert sorted((r.title, r.title_i32) for r in rows.collect() if r.title) == [("a", None), ("b", None), ("d", None)]
    assert sorted(r.title_i32 for r in rows.where("title_i32 IS NOT NULL").collect()) == [5, 6] and rows.where("extra IS NOT NULL").count() == 2
    assert sorted(p.name for p in (tmp_path / "state" / KNOWN).iterdir() if p.is_dir()) == ["batch_id=0", "batch_id=2"]
    found = {(r.batch_id, r.step): r.rows for r in stream_report(spark, out).collect()}
    assert found == {(0, "append"): 1, (1, "append"): 2, (1, "malformed"): 1, (2, "append"): 1, (3, "append"): 2}
    assert stream_report(spark, str(tmp_path / "none")).count() == 0


def test_rejects_of_a_known_tag_are_no_reason_to_search(spark, tmp_path, monkeypatch):
    import tablebridge.streaming.migrate as module

    searched = []
    monkeypatch.setattr(module, "discover", lambda docs, *a, **k: searched.append(1) or discover(docs, *a, **k))
    inbox, out = tmp_path / "in", str(tmp_path / "out")
    inbox.mkdir()
    cast = {"title": {"dtype": "I32", "dtype_collision_strategy": "Cast"}}
    for name, line in (("a", '{"title":"x"}'), ("b", '{"title":"y"}'), ("c", '{"title":7,"w":1}')):
        (inbox / name).write_text(line + "\n")
        stream_migrate(spark, str(inbox), out, cast, str(tmp_path / "state"), rest="rest").awaitTermination()
    rows = read_migrated(spark, out)
    assert len(searched) == 1 and sorted((r.title, r.rest) for r in rows.where("title = 7").collect()) == [(7, '{"w":1}')]
    assert sorted(r.raw_json for r in read_migrated(spark, out, "rejects").collect()) == ['"x"', '"y"']


def test_undeclared_keys_stay_together(spark, make_docs, tmp_path):
    docs = make_docs([{"a": 1, "b": [1, None], "c": None}, {"a": "x"}, {"b": {"k": 2}, "d": 4}, {}])
    sink = ParquetSink(str(tmp_path / "typed"))
    migrate_typed(docs, sink, keys=["a"], rest="more", ignore=["d"])
    rows = sink.read(spark)
    assert column(rows, "more", by="r") == ['{"b":[1,null]}', None, '{"b":{"k":2}}', None] and set(rows.columns) == {"r", "a_i32", "a_str", "more"}
    with pytest.raises(ValueError, match="name the keys"):
        migrate_typed(docs, sink, rest="more")
