"""Queries over ragged documents."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from tablebridge.functions.cells import HOMOGENISE, normalise_columns, safe_decode, text_of
from tablebridge.functions.paths import field
from tablebridge.functions.tags import with_tags
from tablebridge.operators.align import align, normalise, split_mixed
from tablebridge.operators.conform import conform
from tablebridge.operators.discover import batch_plan, profile, schema_report, shape_groups
from tablebridge.registered.derived import (
    ARRAYS,
    DECLARED,
    MALFORMED,
    WIDE,
    BROKEN,
    CELLS,
    DIRTY,
    EXTENDED,
    ITEMS,
    MIXED,
    NESTED,
    ORACLE_MILLIS,
    dealt,
    dealt_dirty,
    dirty,
    documents,
    extended,
    table,
)
from tablebridge.sinks.bulk import bulk_payloads
from tablebridge.sources.documents import parse_documents

D = f"WITH d AS (SELECT event_id, {DIRTY} AS doc FROM events)"

# The tag of a JSON value in the oracle's SQL.
JSON_TAG = """CASE WHEN json_type({0}) IS NULL OR json_type({0}) = 'NULL' THEN 'None'
    WHEN json_type({0}) = 'VARCHAR' THEN 'String'
    WHEN json_type({0}) IN ('UBIGINT', 'BIGINT') THEN
      CASE WHEN CAST({0} AS BIGINT) BETWEEN -2147483648 AND 2147483647 THEN 'I32' ELSE 'I64' END
    WHEN json_type({0}) = 'DOUBLE' THEN 'Double64'
    WHEN json_type({0}) = 'BOOLEAN' THEN 'Bool'
    WHEN json_type({0}) = 'ARRAY' THEN CASE WHEN json_array_length({0}) = 0 THEN 'VecString' ELSE 'VecDyn' END
    ELSE 'Object' END"""

# The parts of ``d`` that the oracles read.
CELLS_OF_D = f"""{D}, c AS (SELECT event_id, json_extract(doc, '$.name') AS n, json_extract(doc, '$.ref') AS s,
    json_extract_string(doc, '$.name') AS nt, json_extract_string(doc, '$.ref') AS st FROM d),
  t AS (SELECT *, {JSON_TAG.format('n')} AS ntag, {JSON_TAG.format('s')} AS stag FROM c)"""


def spec(strategy: str, name: str = "String", ref: str = "I32") -> dict:
    return {
        "name": {"dtype": name, "dtype_collision_strategy": strategy},
        "ref": {"dtype": ref, "dtype_collision_strategy": strategy},
    }


def name_and_ref(cells: DataFrame, *others: str) -> DataFrame:
    """Tags and texts of the two ragged columns."""
    tagged = with_tags(cells, {"name": "name_tag", "ref": "ref_tag"})
    texts = [f"{text_of(c, f'{c}_tag')} AS {c}" for c in ("name", "ref")]
    return tagged.selectExpr(*others, "name_tag", "ref_tag", *texts)


def align_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = align(dirty(spark, sf_dir))
    return name_and_ref(aligned, "event_id", "try_variant_get(id, '$', 'bigint') AS id").drop("name_tag", "ref_tag")


def type_tag(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = dirty(spark, sf_dir).selectExpr(
        "event_id", f"{field('doc', 'name')} AS name", f"{field('doc', 'ref')} AS ref"
    )
    return with_tags(cells, {"name": "name_tag", "ref": "ref_tag"}).drop("name", "ref")


def type_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile(dirty(spark, sf_dir))


def schema_report_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schema_report(dirty(spark, sf_dir), spec("NewCol"))


def conform_newcol(spark: SparkSession, sf_dir: str) -> DataFrame:
    return newcol_columns(conform(dealt_dirty(spark, sf_dir), spec("NewCol"), "event_id").rows)


def newcol_columns(rows: DataFrame) -> DataFrame:
    return rows.select(
        "event_id",
        F.col("id").cast("bigint").alias("id"),
        "name",
        "name_bool",
        "name_f64",
        "name_i32",
        F.to_json("name_object").alias("name_object"),
        F.to_json("name_vecdyn").alias("name_vecdyn"),
        "ref",
        "ref_str",
    )


NEWCOL = f"""{CELLS_OF_D} SELECT event_id, event_id AS id,
    CASE WHEN ntag = 'String' THEN nt END AS name,
    CASE WHEN ntag = 'Bool' THEN CAST(nt AS BOOLEAN) END AS name_bool,
    CASE WHEN ntag = 'Double64' THEN CAST(nt AS DOUBLE) END AS name_f64,
    CASE WHEN ntag = 'I32' THEN CAST(nt AS INTEGER) END AS name_i32,
    CASE WHEN ntag = 'Object' THEN nt END AS name_object,
    CASE WHEN ntag = 'VecDyn' THEN nt END AS name_vecdyn,
    CASE WHEN stag = 'I32' THEN CAST(st AS INTEGER) END AS ref,
    CASE WHEN stag = 'String' THEN st END AS ref_str FROM t"""


def conform_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(dealt_dirty(spark, sf_dir), spec("Cast"), "event_id").rows.select("event_id", F.col("id").cast("bigint").alias("id"), "name", "ref")


def conform_cast_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(dealt_dirty(spark, sf_dir), spec("Cast", name="I32"), "event_id").rejects


def conform_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conform(dealt_dirty(spark, sf_dir), spec("Ignore"), "event_id").rows
    return name_and_ref(rows, "event_id", "cast(id AS bigint) AS id")


def conform_remove(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(dealt_dirty(spark, sf_dir), spec("Remove"), "event_id").rows.select("event_id", F.col("id").cast("bigint").alias("id"), "name", "ref")


def conform_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wrappers that hold no value of their type are rejected, whatever the strategy; the others are placed."""
    docs = documents(table(spark, sf_dir, "events"), MALFORMED, "event_id")
    done = {
        strategy: conform(docs, {"v": {"dtype": "I32", "dtype_collision_strategy": strategy}}, "event_id")
        for strategy in ("NewCol", "Cast", "Remove")
    }
    parts = [
        found.rejects.select(F.lit(strategy).alias("strategy"), "event_id", "column", "expected", "actual", "raw_json")
        for strategy, found in done.items()
    ]
    placed = done["NewCol"].rows.select(
        F.lit("placed").alias("strategy"),
        "event_id",
        F.lit("v").alias("column"),
        F.col("v").cast("string").alias("expected"),
        F.col("v_i64").cast("string").alias("actual"),
        F.col("v_str").alias("raw_json"),
    )
    return reduce(DataFrame.unionAll, parts, placed)


def conform_declared_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(table(spark, sf_dir, "events"), DECLARED, "event_id")
    declared = {
        "list": {"dtype": "VecI32", "dtype_collision_strategy": "NewCol"},
        "ratio": {"dtype": "Double32", "dtype_collision_strategy": "Remove"},
    }
    rows = conform(docs, declared, "event_id").rows
    return rows.select(
        "event_id",
        F.to_json("list").alias("list"),
        "list_str",
        F.to_json("list_vecdyn").alias("list_vecdyn"),
        F.col("ratio").cast("double").alias("ratio"),
    )


def conform_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Thousands of keys that nobody declared stay together in one column."""
    docs = documents(table(spark, sf_dir, "events"), WIDE, "event_id")
    return conform(docs, {"id": {"dtype": "I64", "dtype_collision_strategy": "Cast"}}, "event_id", rest="others").rows


def conform_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = dealt(table(spark, sf_dir, "orders"), NESTED, "o_orderkey")
    nested_spec = {
        "customer": {
            "dtype": "Object",
            "dtype_collision_strategy": "NewCol",
            "sub_schema": {
                "key": {"dtype": "I64", "dtype_collision_strategy": "NewCol"},
                "priority": {"dtype": "String", "dtype_collision_strategy": "Cast"},
            },
        }
    }
    return conform(docs, nested_spec, "o_orderkey").rows.select(
        "o_orderkey",
        F.col("customer.key").alias("customer_key"),
        F.col("customer.key_str").alias("customer_key_str"),
        F.col("customer.priority").alias("customer_priority"),
        F.col("customer.closed").alias("customer_closed"),
        "customer_str",
    )


def conform_nested_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects inside arrays, and inside arrays within these, conformed element by element, beside what was rejected."""
    docs = dealt(table(spark, sf_dir, "orders"), ITEMS, "o_orderkey")
    parts = {"n": {"dtype": "I64", "dtype_collision_strategy": "NewCol"}}
    item = {
        "sku": {"dtype": "I64", "dtype_collision_strategy": "NewCol"},
        "qty": {"dtype": "I32", "dtype_collision_strategy": "Cast"},
        "parts": {"dtype": "VecDyn", "dtype_collision_strategy": "NewCol", "sub_schema": parts},
    }
    items = {"items": {"dtype": "VecDyn", "dtype_collision_strategy": "NewCol", "sub_schema": item}}
    rows, rejects, _ = conform(docs, items, "o_orderkey")
    refused = rejects.groupBy("o_orderkey").agg(
        F.array_join(F.sort_array(F.collect_list(F.concat_ws(" ", "column", "expected", "actual", "raw_json"))), "; ").alias("refused")
    )
    # Spark takes rejects, which a generator makes of wide rows, for a small table whatever their number: no broadcast of them.
    return rows.join(refused.hint("merge"), "o_orderkey", "left").select("o_orderkey", F.to_json("items").alias("items"), "items_str", "refused")


def split_mixed_array(spark: SparkSession, sf_dir: str, depth: int = 0) -> DataFrame:
    tags = ["I32", "String", "Bool", "VecDyn", "Object"]
    arrays = table(spark, sf_dir, "events").select("event_id", F.parse_json(F.expr(MIXED)).alias("a"))
    parts = split_mixed(arrays, "a", tags, depth).drop("a")
    return parts.select("event_id", *[F.to_json(c).alias(c) for c in parts.columns[1:]])


def split_mixed_array_deep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_mixed_array(spark, sf_dir, depth=1)


def _normalised(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    cells = normalise(extended(spark, sf_dir), mode)
    columns = ["_id", "at", "n", "ok", "list", "obj"]
    out = [F.col(f"{c}.tag").alias(f"{c}_tag") for c in columns]
    out += [F.to_json(f"{c}.value").alias(f"{c}_json") for c in columns]
    return cells.select(
        "event_id",
        *out,
        F.col("amount.tag").alias("amount_tag"),
        F.try_variant_get("amount.value", "$", "double").alias("amount"),
    )


def normalise_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _normalised(spark, sf_dir, "typed")


def normalise_http(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _normalised(spark, sf_dir, "http")


def normalise_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _normalised(spark, sf_dir, "nested")


def homogenise_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    arrays = table(spark, sf_dir, "events").select("event_id", F.try_parse_json(F.expr(ARRAYS)).alias("c"))
    cells = normalise_columns(arrays, ["c"], HOMOGENISE)
    return cells.select("event_id", F.col("c.tag").alias("tag"), F.to_json("c.value").alias("value"))


def safe_decode_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = table(spark, sf_dir, "events").select("event_id", F.expr(CELLS).alias("cell"))
    return cells.selectExpr(
        "event_id",
        f"{safe_decode('cell', 'I32')} AS as_i32",
        f"{safe_decode('cell', 'I64')} AS as_i64",
        f"{safe_decode('cell', 'Double64')} AS as_f64",
        f"{safe_decode('cell', 'Bool')} AS as_bool",
        f"to_json({safe_decode('cell', 'Object')}) AS as_object",
        f"to_json({safe_decode('cell', 'VecDyn')}) AS as_array",
    )


def quarantine_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "events").select("event_id", F.expr(BROKEN).alias("value"))
    docs, rejects = parse_documents(lines)
    return docs.select("event_id", F.lit(None).cast("string").alias("raw"), F.lit("document").alias("reason")).unionAll(
        rejects
    )


def shape_groups_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape_groups(dirty(spark, sf_dir)).select("shape", F.col("n_keys").cast("bigint").alias("n_keys"), "n")


def batch_plan_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batch_plan(dirty(spark, sf_dir), 1000)


def bulk_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every argument list, taken out of the payloads again."""
    payloads = bulk_payloads(dirty(spark, sf_dir), "doc", "events", size=1000)
    lists = F.try_variant_get(F.parse_json("payload"), "$.bulk_args", "array<variant>")
    return payloads.select("shape", "stmt", F.explode(lists).alias("a")).select(
        "shape", "stmt", F.to_json("a").alias("args")
    )


def bulk_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batches that were planned against those that are made, per shape."""
    docs = dirty(spark, sf_dir)
    made = bulk_payloads(docs, "doc", "events", size=100).groupBy("shape").agg(
        F.sum("n_rows").alias("n_made"), F.count("*").alias("batches_made"), F.max("n_rows").alias("largest")
    )
    planned = batch_plan(docs, 100).withColumnRenamed("n", "n_planned")
    return planned.join(made, "shape").select(
        "shape",
        F.col("n_planned").alias("n"),
        (F.col("n_planned") == F.col("n_made")).alias("same_rows"),
        (F.col("n_batches") == F.col("batches_made")).alias("same_batches"),
        (F.col("largest") <= 100).alias("within_size"),
    )


def bulk_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    payloads = bulk_payloads(dirty(spark, sf_dir), "doc", "events", size=1000)
    return payloads.groupBy("shape", "stmt").agg(
        F.sum("n_rows").alias("n"), (F.max("n_rows") <= 1000).alias("within_size")
    )


def bulk_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads over documents dealt to seven tasks: per shape, all batches but one are full."""
    docs = dirty(spark, sf_dir).repartition(7, "event_id")
    made = bulk_payloads(docs, "doc", "events", size=100, full=True).groupBy("shape").agg(
        F.sum("n_rows").alias("n"), F.count("*").alias("n_batches"), F.count_if(F.col("n_rows") < 100).alias("n_short")
    )
    planned = batch_plan(docs, 100, full=True).select("shape", F.col("n_batches").alias("planned"))
    return made.join(planned, "shape").select("shape", "n", "n_batches", "n_short", (F.col("planned") == F.col("n_batches")).alias("as_planned"))


QUERIES = {
    "align_documents": align_documents,
    "type_tag": type_tag,
    "type_profile": type_profile,
    "schema_report": schema_report_query,
    "conform_newcol": conform_newcol,
    "conform_cast": conform_cast,
    "conform_cast_rejects": conform_cast_rejects,
    "conform_ignore": conform_ignore,
    "conform_remove": conform_remove,
    "conform_nested": conform_nested,
    "conform_nested_arrays": conform_nested_arrays,
    "split_mixed_array": split_mixed_array,
    "split_mixed_array_deep": split_mixed_array_deep,
    "normalise_typed": normalise_typed,
    "normalise_http": normalise_http,
    "normalise_nested": normalise_nested,
    "homogenise_arrays": homogenise_arrays,
    "safe_decode": safe_decode_query,
    "quarantine_rows": quarantine_rows,
    "shape_groups": shape_groups_query,
    "batch_plan": batch_plan_query,
    "bulk_payloads": bulk_rows,
    "bulk_batches": bulk_batches,
    "bulk_plan": bulk_plan,
    "bulk_full": bulk_full,
    "conform_malformed": conform_malformed,
    "conform_declared_arrays": conform_declared_arrays,
    "conform_wide": conform_wide,
}

_SHAPES = f"""{D}, k AS (SELECT event_id, list_sort(json_keys(doc)) AS keys FROM d),
  g AS (SELECT CAST(to_json(keys) AS VARCHAR) AS shape, list_transform(keys, lambda k: concat('"', k, '"')) AS names, len(keys) AS n_keys, count(*) AS n FROM k GROUP BY ALL)"""

_X = f"""WITH x AS (SELECT event_id, event_type, user_id, value, ts, {ORACLE_MILLIS} AS ms,
    lpad(cast(event_id AS varchar), 24, '0') AS oid FROM events)"""
# The fraction of a second without trailing zeros, and without the point when nothing is left.
_RFC3339 = "concat(regexp_replace(strftime(ts, '%Y-%m-%dT%H:%M:%S.%g'), '\\.?0+$', ''), 'Z')"
_OBJ = """concat('{{"d":', ms, ',"i":["', event_type, '"]}}')""".replace("{{", "{").replace("}}", "}")

_JOINED = ", ".join(
    f"CASE WHEN len({c}) > 0 THEN concat('[', array_to_string({c}, ','), ']') END AS a_{name}"
    for c, name in zip("isbvo", ("i32", "str", "bool", "vecdyn", "object"))
)

_CELL_OF_STMT = {
    "String": "to_json(nt)",
    "Bool": "to_json(nt)",
    "Double64": "to_json(nt)",
    "Object": "to_json(nt)",
    "I32": "nt",
    "VecDyn": "nt",
    "None": "'null'",
}

ORACLES = {
    "align_documents": f"{CELLS_OF_D} SELECT event_id, event_id AS id, nt AS name, st AS ref FROM t",
    "type_tag": f"{CELLS_OF_D} SELECT event_id, ntag AS name_tag, stag AS ref_tag FROM t",
    "type_profile": f"""{CELLS_OF_D}, e AS (
        SELECT 'id' AS key, 'I32' AS tag FROM t UNION ALL SELECT 'name', ntag FROM t
        UNION ALL SELECT 'ref', stag FROM t WHERE s IS NOT NULL)
        SELECT key, tag, CAST(count(*) AS BIGINT) AS n FROM e GROUP BY key, tag""",
    "schema_report": f"""{CELLS_OF_D}, e AS (
        SELECT 'id' AS key, 'I32' AS tag, 'Unknown' AS expected_dtype, 'Ignore' AS strategy FROM t
        UNION ALL SELECT 'name', ntag, 'String', 'NewCol' FROM t
        UNION ALL SELECT 'ref', stag, 'I32', 'NewCol' FROM t WHERE s IS NOT NULL)
        SELECT key, expected_dtype, strategy,
          array_to_string(list_sort(list(DISTINCT tag) FILTER (tag <> 'None')), ',') AS dtypes,
          CAST(count(*) FILTER (tag <> 'None') AS BIGINT) AS n_values,
          CAST(count(*) FILTER (tag <> 'None' AND expected_dtype <> 'Unknown' AND tag <> expected_dtype) AS BIGINT)
            AS n_mismatch
        FROM e GROUP BY key, expected_dtype, strategy""",
    "conform_newcol": NEWCOL,
    "conform_cast": f"""{CELLS_OF_D} SELECT event_id, event_id AS id,
        CASE WHEN ntag = 'VecDyn' THEN array_to_string(CAST(n AS VARCHAR[]), ' ') ELSE nt END AS name,
        CASE WHEN regexp_matches(st, '^[+-]?[0-9]+$') THEN TRY_CAST(st AS INTEGER) END AS ref FROM t""",
    "conform_cast_rejects": f"""{CELLS_OF_D} SELECT event_id, 'name' AS "column", 'I32' AS expected, ntag AS actual,
        CASE ntag WHEN 'Double64' THEN regexp_replace(CAST(n AS VARCHAR), '\\.0$', '')
          ELSE CAST(n AS VARCHAR) END AS raw_json FROM t
        WHERE ntag NOT IN ('None', 'I32') AND NOT (ntag = 'String' AND regexp_matches(nt, '^[+-]?[0-9]+$'))""",
    "conform_ignore": f"""{CELLS_OF_D} SELECT event_id, event_id AS id, ntag AS name_tag, nt AS name, stag AS ref_tag,
        st AS ref FROM t""",
    "conform_remove": f"""{CELLS_OF_D} SELECT event_id, event_id AS id, CASE WHEN ntag = 'String' THEN nt END AS name,
        CASE WHEN stag = 'I32' THEN CAST(st AS INTEGER) END AS ref FROM t""",
    "conform_nested": f"""WITH d AS (SELECT o_orderkey, {NESTED} AS doc FROM orders),
        c AS (SELECT o_orderkey, json_extract(doc, '$.customer') AS c FROM d),
        f AS (SELECT o_orderkey, c, json_extract(c, '$.key') AS k, json_extract_string(c, '$.key') AS kt,
          json_extract_string(c, '$.priority') AS p, json_extract_string(c, '$.closed') AS closed FROM c)
        SELECT o_orderkey,
          CASE WHEN json_type(k) IN ('UBIGINT', 'BIGINT') THEN CAST(kt AS BIGINT) END AS customer_key,
          CASE WHEN json_type(k) = 'VARCHAR' THEN kt END AS customer_key_str,
          p AS customer_priority, CAST(closed AS BOOLEAN) AS customer_closed,
          CASE WHEN json_type(c) = 'VARCHAR' THEN json_extract_string(c, '$') END AS customer_str FROM f""",
    "conform_nested_arrays": """SELECT o_orderkey,
        CASE WHEN o_orderkey % 11 = 0 THEN '[]' WHEN o_orderkey % 7 <> 0 THEN
          concat('[{"sku":', o_custkey, ',"qty":', o_orderkey % 9, '},', CASE WHEN o_orderkey % 3 = 0 THEN 'null' ELSE
            concat('{"sku_str":"', o_orderstatus, '","qty":', o_custkey, ',"tag":true}') END,
            ',null,{"parts":[{"n":', o_orderkey, '},{"n_str":"', o_orderstatus, '"}]}]') END AS items,
        CASE WHEN o_orderkey % 11 <> 0 AND o_orderkey % 7 = 0 THEN 'none' END AS items_str,
        CASE WHEN o_orderkey % 11 <> 0 AND o_orderkey % 7 <> 0 THEN
          concat(CASE WHEN o_orderkey % 3 = 0 THEN concat('items[1] Object I32 ', o_custkey, '; ') ELSE '' END,
            'items[3].qty I32 String "', o_orderstatus, '"') END AS refused FROM orders""",
    "split_mixed_array": f"""WITH m AS (SELECT event_id, json_extract({MIXED}, '$[*]') AS a FROM events),
        p AS (SELECT event_id, list_filter(a, lambda e: json_type(e) IN ('UBIGINT', 'BIGINT')) AS i,
          list_filter(a, lambda e: json_type(e) = 'VARCHAR') AS s,
          list_filter(a, lambda e: json_type(e) = 'BOOLEAN') AS b,
          list_filter(a, lambda e: json_type(e) = 'ARRAY') AS v,
          list_filter(a, lambda e: json_type(e) = 'OBJECT') AS o FROM m)
        SELECT event_id, {_JOINED} FROM p""",
    "split_mixed_array_deep": """SELECT event_id,
        concat('[', event_id, ',', user_id, ',', user_id, ']') AS a_i32,
        concat('["', event_type, '","', event_type, '"]') AS a_str,
        CASE WHEN event_id % 2 = 0 THEN '[true,false]' ELSE '[true]' END AS a_bool,
        CAST(NULL AS VARCHAR) AS a_vecdyn, concat('[{"k":', user_id, '}]') AS a_object FROM events""",
    "normalise_typed": f"""{_X} SELECT event_id, 'String' AS _id_tag, concat('"', oid, '"') AS _id_json,
        'I64' AS at_tag, ms AS at_json, 'I64' AS n_tag, CAST(user_id AS VARCHAR) AS n_json,
        'Double64' AS amount_tag, value AS amount, 'String' AS ok_tag, '"true"' AS ok_json,
        CASE event_id % 5 WHEN 0 THEN 'VecI32' WHEN 3 THEN 'VecF64' ELSE 'VecString' END AS list_tag,
        CASE event_id % 5 WHEN 0 THEN concat('[', user_id, ',2,3]')
          WHEN 1 THEN concat('["', event_type, '","', user_id, '","null"]') WHEN 2 THEN '[]'
          WHEN 3 THEN concat('[', CAST(value + 0.5 AS VARCHAR), ',', user_id, '.0]')
          ELSE concat('["true","', user_id, '"]') END AS list_json,
        'String' AS obj_tag, to_json({_OBJ}) AS obj_json FROM x""",
    "normalise_http": f"""{_X} SELECT event_id, 'String' AS _id_tag, concat('"', oid, '"') AS _id_json,
        'String' AS at_tag, concat('"', {_RFC3339}, '"') AS at_json, 'I64' AS n_tag,
        CAST(user_id AS VARCHAR) AS n_json, 'String' AS amount_tag, value AS amount,
        'String' AS ok_tag, '"true"' AS ok_json,
        CASE event_id % 5 WHEN 3 THEN 'VecF64' ELSE 'VecString' END AS list_tag,
        CASE event_id % 5 WHEN 0 THEN concat('["', user_id, '","2","3"]')
          WHEN 1 THEN concat('["', event_type, '","', user_id, '","null"]') WHEN 2 THEN '[]'
          WHEN 3 THEN concat('[', CAST(value + 0.5 AS VARCHAR), ',', user_id, '.0]')
          ELSE concat('["true","', user_id, '"]') END AS list_json,
        'String' AS obj_tag, to_json({_OBJ}) AS obj_json FROM x""",
    "normalise_nested": f"""{_X} SELECT event_id, 'String' AS _id_tag, concat('"', oid, '"') AS _id_json,
        'I64' AS at_tag, ms AS at_json, 'I64' AS n_tag, CAST(user_id AS VARCHAR) AS n_json,
        'Double64' AS amount_tag, value AS amount, 'Bool' AS ok_tag, 'true' AS ok_json,
        CASE event_id % 5 WHEN 2 THEN 'VecString' ELSE 'VecDyn' END AS list_tag,
        CASE event_id % 5 WHEN 0 THEN concat('[', user_id, ',2,3]')
          WHEN 1 THEN concat('["', event_type, '",', user_id, ',null]') WHEN 2 THEN '[]'
          WHEN 3 THEN concat('[', regexp_replace(CAST(value + 0.5 AS VARCHAR), '\\.0$', ''), ',', user_id, ']')
          ELSE concat('[true,', user_id, ']') END AS list_json,
        'Object' AS obj_tag, {_OBJ} AS obj_json FROM x""",
    "homogenise_arrays": """SELECT event_id,
        CASE event_id % 7 WHEN 0 THEN 'VecF64' WHEN 1 THEN 'VecString' WHEN 2 THEN 'None' WHEN 5 THEN 'None'
          WHEN 6 THEN 'VecF64' ELSE 'String' END AS tag,
        CASE event_id % 7 WHEN 0 THEN to_json([CAST(user_id AS DOUBLE), CAST(event_id AS DOUBLE), NULL, NULL])
          WHEN 1 THEN concat('["', event_type, '","', user_id, '","null","[1,', user_id, ']"]')
          WHEN 3 THEN concat('"[true,', user_id, ']"')
          WHEN 4 THEN to_json(CAST(CAST(props AS JSON) -> '$' AS VARCHAR))
          WHEN 6 THEN to_json([value + 0.25, CAST(user_id AS DOUBLE)]) END AS value FROM events""",
    "safe_decode": f"""WITH c AS (SELECT event_id, {CELLS} AS cell FROM events),
        j AS (SELECT *, TRY_CAST(cell AS JSON) AS j FROM c)
        SELECT event_id,
          CASE WHEN regexp_matches(cell, '^[+-]?[0-9]+$') THEN TRY_CAST(cell AS INTEGER) END AS as_i32,
          CASE WHEN regexp_matches(cell, '^[+-]?[0-9]+$') THEN TRY_CAST(cell AS BIGINT) END AS as_i64,
          CASE WHEN regexp_matches(cell, '^[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?$')
            THEN TRY_CAST(cell AS DOUBLE) END AS as_f64,
          CASE WHEN lower(cell) IN ('true', 'false') THEN lower(cell) = 'true' END AS as_bool,
          CASE WHEN cell LIKE '{{%' THEN CAST(j -> '$' AS VARCHAR) END AS as_object,
          CASE WHEN cell LIKE '[%' THEN CAST(j -> '$' AS VARCHAR) END AS as_array FROM j""",
    "quarantine_rows": f"""WITH b AS (SELECT event_id, {BROKEN} AS raw FROM events)
        SELECT event_id, CASE WHEN json_valid(raw) AND raw LIKE '{{%' THEN NULL ELSE raw END AS raw,
          CASE WHEN NOT json_valid(raw) THEN 'malformed' WHEN raw LIKE '{{%' THEN 'document'
            ELSE 'not an object' END AS reason FROM b""",
    "shape_groups": f"""{_SHAPES} SELECT shape, CAST(n_keys AS BIGINT) AS n_keys, CAST(n AS BIGINT) AS n FROM g""",
    "batch_plan": f"""{_SHAPES} SELECT shape, CAST(n AS BIGINT) AS n,
        CAST(ceil(n / 1000.0) AS BIGINT) AS n_batches FROM g""",
    "bulk_payloads": f"""{CELLS_OF_D}, a AS (SELECT s IS NULL AS short, concat('[', event_id, ',', CASE ntag
        {' '.join(f"WHEN '{k}' THEN {v}" for k, v in _CELL_OF_STMT.items())} END,
        CASE WHEN s IS NULL THEN '' ELSE concat(',', CAST(s AS VARCHAR)) END, ']') AS args FROM t)
        SELECT CASE WHEN short THEN '["id","name"]' ELSE '["id","name","ref"]' END AS shape,
          CASE WHEN short THEN 'INSERT INTO "doc"."events" ("id","name") VALUES (?,?)'
            ELSE 'INSERT INTO "doc"."events" ("id","name","ref") VALUES (?,?,?)' END AS stmt, args FROM a""",
    "bulk_batches": f"""{_SHAPES} SELECT shape,
        concat('INSERT INTO "doc"."events" (', array_to_string(names, ','), ') VALUES (', CASE n_keys WHEN 2 THEN '?,?' ELSE '?,?,?' END, ')')
          AS stmt, CAST(n AS BIGINT) AS n, true AS within_size FROM g""",
    "bulk_plan": f"""{_SHAPES} SELECT shape, CAST(n AS BIGINT) AS n, true AS same_rows, true AS same_batches,
        true AS within_size FROM g""",
    "bulk_full": f"""{_SHAPES} SELECT shape, CAST(n AS BIGINT) AS n, CAST(ceil(n / 100.0) AS BIGINT) AS n_batches,
        CAST(n % 100 > 0 AS BIGINT) AS n_short, true AS as_planned FROM g""",
    "conform_malformed": f"""WITH d AS (SELECT event_id, event_type, user_id,
          CAST(json_extract({MALFORMED}, '$.v') AS VARCHAR) AS raw FROM events),
        t AS (SELECT *, CASE event_id % 8 WHEN 1 THEN 'I32' WHEN 4 THEN 'I32' WHEN 7 THEN 'I32' WHEN 3 THEN 'Double64'
          WHEN 6 THEN 'String' ELSE 'I64' END AS tag FROM d)
        SELECT 'placed' AS strategy, event_id, 'v' AS "column",
          CASE WHEN event_id % 8 IN (4, 7) THEN CAST(user_id AS VARCHAR) END AS expected,
          CASE WHEN event_id % 8 = 5 THEN CAST(event_id AS VARCHAR) END AS actual,
          CASE WHEN event_id % 8 = 6 THEN event_type END AS raw_json FROM t
        UNION ALL SELECT 'NewCol', event_id, 'v', 'I32', tag, raw FROM t WHERE event_id % 8 < 4
        UNION ALL SELECT 'Cast', event_id, 'v', 'I32', tag, raw FROM t WHERE event_id % 8 NOT IN (4, 7)
        UNION ALL SELECT 'Remove', event_id, 'v', 'I32', tag, raw FROM t WHERE event_id % 8 = 1""",
    "conform_declared_arrays": """SELECT event_id,
        CASE event_id % 5 WHEN 0 THEN concat('[', user_id, ',2]') WHEN 2 THEN '[]' END AS list,
        CASE event_id % 5 WHEN 4 THEN event_type END AS list_str,
        CASE event_id % 5 WHEN 1 THEN concat('["', event_type, '"]') WHEN 3 THEN concat('[', user_id, ',3000000000]') END
          AS list_vecdyn,
        CASE event_id % 3 WHEN 0 THEN 0.5::DOUBLE WHEN 1 THEN 1.25::DOUBLE END AS ratio FROM events""",
    "conform_wide": """SELECT event_id, event_id AS id, concat('{"k', event_id % 2500, '":', user_id, '}') AS others
        FROM events""",
}
