"""Queries over typed tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from tablebridge.functions.rows import encode_nested, normalise_sql
from tablebridge.operators.columns import ignore_columns, select_existing
from tablebridge.operators.locate import locate_differences
from tablebridge.operators.reconcile import reconcile, replicate
from tablebridge.registered.derived import table
from tablebridge.session import is_local
from tablebridge.sinks.append import JdbcSink
from tablebridge.sources.tables import count_table, read_table, split_by, split_evenly, table_inventory

TABLES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
)

JDBC_URL = "spark.tablebridge.jdbc.url"
JDBC_DRIVER = "spark.tablebridge.jdbc.driver"


def jdbc_target(spark: SparkSession) -> tuple[str, dict[str, str]]:
    """Where the JDBC queries write and read: the database named by ``spark.tablebridge.jdbc.url``.

    Without that setting an in-process, in-memory database is used. Only its own
    process sees it, so that works in local mode alone.
    """
    url = spark.conf.get(JDBC_URL, None)
    if url:
        driver = spark.conf.get(JDBC_DRIVER, None)
        return url, {"driver": driver} if driver else {}
    if not is_local(spark):
        raise RuntimeError(f"set {JDBC_URL} to a database that all executors reach")
    return "jdbc:derby:memory:tablebridge;create=true", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


def load_orders(spark: SparkSession, sf_dir: str) -> tuple[str, str, dict[str, str]]:
    url, properties = jdbc_target(spark)
    name = f"orders_{uuid.uuid4().hex}"
    JdbcSink(url, name, properties=properties).write(table(spark, sf_dir, "orders"))
    return url, name, properties


def scan_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def scan_jdbc(spark: SparkSession, sf_dir: str) -> DataFrame:
    url, name, properties = load_orders(spark, sf_dir)
    parts = split_by(spark, url, name, "o_orderkey", 8, properties)
    return read_table(spark, url, name, parts, properties=properties)


def scan_jdbc_evenly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders under a key that half of them share, read in eight parts and more; rows, and whether no part is twice the mean."""
    url, properties = jdbc_target(spark)
    name = f"hot_{uuid.uuid4().hex}"
    key = F.when(F.col("o_orderkey") % 2 == 0, 7).otherwise(F.col("o_custkey")).alias("k")
    JdbcSink(url, name, properties=properties).write(table(spark, sf_dir, "orders").select(key, "o_orderkey", "o_totalprice"))
    parts = split_evenly(spark, url, name, "k", 8, tie="o_orderkey", properties=properties)
    back = read_table(spark, url, name, predicates=parts, properties=properties)
    sizes = back.groupBy(F.spark_partition_id().alias("part")).agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("keys"))
    return sizes.agg(F.sum("n").alias("n"), F.sum("keys").alias("keys"), (F.max("n") * 8 <= F.sum("n") * 2).alias("even"))


def jdbc_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What differs between the orders and their copy in the database."""
    url, name, properties = load_orders(spark, sf_dir)
    parts = split_by(spark, url, name, "o_orderkey", 8, properties)
    back = read_table(spark, url, name, parts, properties=properties)
    return reconcile(table(spark, sf_dir, "orders"), back, ["o_orderkey"])


def count_table_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_table(spark, table(spark, sf_dir, "lineitem"))


def table_inventory_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table_inventory({name: table(spark, sf_dir, name) for name in TABLES})


def ignore_columns_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ignore_columns(table(spark, sf_dir, "customer"), ["c_acctbal", "c_mktsegment", "no_such_column"])


def select_existing_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select_existing(table(spark, sf_dir, "lineitem"), ["l_shipmode", "l_orderkey", "l_linenumber", "l_quantity"])


def normalise_sql_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events: timestamps become text, the JSON text column is homogenised."""
    rows = normalise_sql(table(spark, sf_dir, "events"), json_columns=["props"])
    return rows.select(
        "event_id",
        "ts",
        "user_id",
        "event_type",
        "value",
        F.col("props.tag").alias("props_tag"),
        F.to_json("props.value").alias("props_json"),
    )


def normalise_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalise_sql(table(spark, sf_dir, "lineitem"))


def encode_nested_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = table(spark, sf_dir, "embeddings").select(
        "vec_id",
        F.struct("vec_id", F.col("label").alias("label")).alias("s"),
        F.array("label", F.col("label") + 1, F.lit(None).cast("int")).alias("a"),
        F.create_map(F.lit("dims"), F.size("embedding")).alias("m"),
        # Whole numbers, as engines print floating ones differently.
        F.struct(F.transform("embedding", lambda x: F.floor(x.cast("double") * 1000000)).alias("e"), F.lit(None).cast("int").alias("z")).alias("v"),
    )
    return encode_nested(nested)


def reconcile_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items against a copy that lost the returned ones and holds the open ones twice."""
    items = table(spark, sf_dir, "lineitem")
    kept = items.where(F.col("l_returnflag") != "R")
    return reconcile(items, kept.unionAll(items.where(F.col("l_linestatus") == "O")), ["l_orderkey", "l_linenumber"])


def reconcile_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A copy whose nested values lost or moved a NULL in three rows of four, and that lacks a column."""
    key, turn = ["l_orderkey", "l_linenumber"], F.col("l_orderkey") % 4
    none = F.lit(None).cast("bigint")
    items = table(spark, sf_dir, "lineitem").select(
        *key, "l_tax", F.array("l_suppkey", none).alias("list"), F.struct(F.col("l_partkey").alias("x"), none.alias("y")).alias("pair")
    )
    first = F.col("list")[0]
    moved = F.when(turn == 0, F.array(none, first)).when(turn == 1, F.array(first)).otherwise(F.col("list"))
    swapped = F.struct(none.alias("x"), F.col("pair.x").alias("y"))
    copy = items.select(*key, moved.alias("list"), F.when(turn == 2, swapped).otherwise(F.col("pair")).alias("pair"))
    return reconcile(items, copy, key)


def reconcile_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events whose times lie in nested values; a copy has them a microsecond later, or its maps in another order."""
    ts, at = F.col("ts"), F.col("event_id") % 3
    later = ts + F.expr("INTERVAL '0.000001' SECOND")

    def shaped(t, first, second) -> DataFrame:
        pairs = {"u": F.col("user_id"), "e": F.col("event_id")}
        ordered = F.create_map(*[x for k in (first, second) for x in (F.lit(k), pairs[k])])
        return table(spark, sf_dir, "events").select("event_id", F.array(F.struct(t.alias("t"), F.lit(None).cast("int").alias("n"))).alias("l"), ordered.alias("m"))

    return reconcile(shaped(ts, "u", "e"), shaped(F.when(at == 0, later).otherwise(ts), "e", "u"), ["event_id"])


def locate_differences_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items against a copy in which a quantity and flags changed, and one key is gone."""
    items = table(spark, sf_dir, "lineitem")
    low, high = items.agg(F.min("l_orderkey"), F.max("l_orderkey")).first()
    key, one = F.col("l_orderkey"), F.col("l_linenumber") == 1
    copy = items.where(~((key == high) & one)).withColumns(
        {
            "l_quantity": F.when((key == low) & one, F.col("l_quantity") + 1).otherwise(F.col("l_quantity")),
            "l_returnflag": F.when((key == low) & ~one, "changed").otherwise(F.col("l_returnflag")),
        }
    )
    found = locate_differences(items, copy, ["l_orderkey", "l_linenumber"])
    return found.withColumn("columns", F.array_join("columns", ","))


def replicate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replicate(table(spark, sf_dir, "customer"), 10)


QUERIES = {
    "scan_parquet": scan_parquet,
    "scan_jdbc": scan_jdbc,
    "scan_jdbc_evenly": scan_jdbc_evenly,
    "jdbc_roundtrip": jdbc_roundtrip,
    "count_table": count_table_query,
    "table_inventory": table_inventory_query,
    "ignore_columns": ignore_columns_query,
    "select_existing": select_existing_query,
    "normalise_sql": normalise_sql_query,
    "normalise_lineitem": normalise_lineitem,
    "encode_nested": encode_nested_query,
    "reconcile": reconcile_query,
    "reconcile_nested": reconcile_nested,
    "reconcile_times": reconcile_times,
    "locate_differences": locate_differences_query,
    "replicate_rows": replicate_rows,
}

_TS_TEXT = """CASE WHEN date_part('microseconds', {0}) % 1000000 = 0 THEN strftime({0}, '%Y-%m-%d %H:%M:%S')
    WHEN date_part('microseconds', {0}) % 1000 = 0 THEN strftime({0}, '%Y-%m-%d %H:%M:%S.%g')
    ELSE strftime({0}, '%Y-%m-%d %H:%M:%S.%f') END"""

ORACLES = {
    "scan_parquet": "SELECT * FROM events",
    "scan_jdbc": "SELECT * FROM orders",
    "scan_jdbc_evenly": "SELECT CAST(count(*) AS BIGINT) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys, true AS even FROM orders",
    "jdbc_roundtrip": """SELECT CAST(count(*) AS BIGINT) AS n_a, CAST(count(*) AS BIGINT) AS n_b,
        CAST(0 AS BIGINT) AS missing, CAST(0 AS BIGINT) AS extra, '' AS missing_columns,
        '' AS extra_columns, true AS matches FROM orders""",
    "count_table": "SELECT CAST(count(*) AS BIGINT) AS n FROM lineitem",
    "table_inventory": " UNION ALL ".join(
        f"SELECT '{name}' AS name, CAST(count(*) AS BIGINT) AS n FROM {name}" for name in TABLES
    ),
    "ignore_columns": "SELECT c_custkey, c_name, c_nationkey FROM customer",
    "select_existing": "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem",
    "normalise_sql": f"""SELECT event_id, {_TS_TEXT.format('ts')} AS ts, user_id, event_type, value,
        'String' AS props_tag, to_json(CAST(CAST(props AS JSON) -> '$' AS VARCHAR)) AS props_json FROM events""",
    "normalise_lineitem": f"SELECT * REPLACE ({_TS_TEXT.format('l_shipdate')} AS l_shipdate) FROM lineitem",
    "encode_nested": """SELECT vec_id, concat('{"vec_id":', vec_id, ',"label":', label, '}') AS s,
        concat('[', label, ',', label + 1, ',null]') AS a, concat('{"dims":', len(embedding), '}') AS m,
        concat('{"e":[', array_to_string(list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 1000000) AS BIGINT)), ','),
          '],"z":null}') AS v FROM embeddings""",
    "reconcile": """WITH r AS (SELECT l_orderkey, l_linenumber,
          1 AS in_a, CAST(l_returnflag <> 'R' AS INTEGER) + CAST(l_linestatus = 'O' AS INTEGER) AS in_b FROM lineitem)
        SELECT CAST(sum(in_a) AS BIGINT) AS n_a, CAST(sum(in_b) AS BIGINT) AS n_b,
          CAST(sum(greatest(in_a - in_b, 0)) AS BIGINT) AS missing,
          CAST(sum(greatest(in_b - in_a, 0)) AS BIGINT) AS extra,
          '' AS missing_columns, '' AS extra_columns, sum(abs(in_a - in_b)) = 0 AS matches FROM r""",
    "reconcile_nested": """WITH r AS (SELECT CAST(l_orderkey % 4 < 3 AS INTEGER) AS differs FROM lineitem)
        SELECT CAST(count(*) AS BIGINT) AS n_a, CAST(count(*) AS BIGINT) AS n_b, CAST(sum(differs) AS BIGINT) AS missing,
          CAST(sum(differs) AS BIGINT) AS extra, 'l_tax' AS missing_columns, '' AS extra_columns, false AS matches FROM r""",
    "reconcile_times": """WITH r AS (SELECT CAST(event_id % 3 = 0 AS INTEGER) AS differs FROM events)
        SELECT CAST(count(*) AS BIGINT) AS n_a, CAST(count(*) AS BIGINT) AS n_b, CAST(sum(differs) AS BIGINT) AS missing,
          CAST(sum(differs) AS BIGINT) AS extra, '' AS missing_columns, '' AS extra_columns, sum(differs) = 0 AS matches FROM r""",
    "locate_differences": """WITH ends AS (SELECT min(l_orderkey) AS low, max(l_orderkey) AS high FROM lineitem),
        changed AS (SELECT l_orderkey, l_linenumber, count(*) AS n,
            CASE WHEN l_orderkey = high AND l_linenumber = 1 THEN 'gone' WHEN l_linenumber = 1 THEN 'l_quantity' ELSE 'l_returnflag' END AS what
          FROM lineitem, ends WHERE l_orderkey = low OR (l_orderkey = high AND l_linenumber = 1) GROUP BY ALL)
        SELECT l_orderkey, l_linenumber, CAST(n AS BIGINT) AS n_a, CAST(CASE WHEN what = 'gone' THEN 0 ELSE n END AS BIGINT) AS n_b,
          CASE WHEN what = 'gone' THEN '' ELSE what END AS columns FROM changed""",
    "replicate_rows": "SELECT customer.*, CAST(range AS BIGINT) AS copy FROM customer CROSS JOIN range(10)",
}
