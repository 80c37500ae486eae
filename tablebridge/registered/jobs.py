"""Queries that run whole jobs: write to the shared scratch folder, then read the result back."""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tablebridge.functions.paths import field
from tablebridge.operators.conform import conform
from tablebridge.operators.profile_store import read_profile, stored_profile, update_profile
from tablebridge.operators.reconcile import reconcile
from tablebridge.plans.migrate import export_documents, migrate_documents, migrate_table, migrate_typed
from tablebridge.registered.derived import ARRAYS, DIRTY, SPARSE, WIDE, dirty, documents, table
from tablebridge.registered.documents import CELLS_OF_D, NEWCOL, name_and_ref, newcol_columns, spec
from tablebridge.registered.tables import _TS_TEXT, jdbc_target
from tablebridge.session import scratch_path
from tablebridge.sinks.append import JdbcSink, ParquetSink, append
from tablebridge.sinks.once import append_once, merge, stage
from tablebridge.sinks.shredded import read_keys, write_shredded
from tablebridge.sources.arrays import read_json_arrays
from tablebridge.sources.documents import read_documents
from tablebridge.streaming.migrate import read_migrated, stream_migrate, stream_report


def write_lines(spark: SparkSession, sf_dir: str) -> str:
    """The dirty documents as JSON-lines files, four at least."""
    return write_text(table(spark, sf_dir, "events").select(F.expr(DIRTY).alias("value")))


def write_text(lines: DataFrame) -> str:
    path = scratch_path(lines.sparkSession, "lines")
    lines.repartition(max(4, lines.sparkSession.sparkContext.defaultParallelism)).write.text(path)
    return path


def scan_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, write_lines(spark, sf_dir)).docs
    cells = docs.selectExpr(
        "try_variant_get(doc, '$.id', 'bigint') AS id",
        f"{field('doc', 'name')} AS name",
        f"{field('doc', 'ref')} AS ref",
    )
    return name_and_ref(cells, "id").drop("name_tag", "ref_tag")


def write_arrays(lines: DataFrame) -> str:
    """The lines of each partition as one file that holds one JSON array."""

    def bracketed(batches):
        yield pa.RecordBatch.from_pydict({"value": ["["]})
        between = ""
        for batch in batches:
            texts = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_pydict({"value": [between + texts[0], *("," + text for text in texts[1:])]} if texts else {"value": [""]})
            between = "," if texts else between
        yield pa.RecordBatch.from_pydict({"value": ["]"]})

    path = scratch_path(lines.sparkSession, "arrays")
    lines.repartition(2).mapInArrow(bracketed, "value string").write.text(path)
    return path


def scan_json_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dirty documents out of two files, each one array."""
    docs = read_json_arrays(spark, write_arrays(table(spark, sf_dir, "events").select(F.expr(DIRTY).alias("value")))).docs
    cells = docs.selectExpr(
        "try_variant_get(doc, '$.id', 'bigint') AS id", f"{field('doc', 'name')} AS name", f"{field('doc', 'ref')} AS ref"
    )
    return name_and_ref(cells, "id").drop("name_tag", "ref_tag")


def migrate_table_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    sink = ParquetSink(scratch_path(spark, "orders"))
    migrate_table(table(spark, sf_dir, "orders"), sink, ignore=["o_orderpriority", "no_such_column"])
    return sink.read(spark)


def migration_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    sink = ParquetSink(scratch_path(spark, "items"))
    report = migrate_table(table(spark, sf_dir, "lineitem"), sink)
    return report.select("step", "rows", (F.col("rows_per_s") > 0).alias("has_rate"))


def migrate_documents_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    sink = ParquetSink(scratch_path(spark, "docs"))
    migrate_documents(dirty(spark, sf_dir), sink, spec("NewCol"))
    return newcol_columns(sink.read(spark))


def migrate_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and rejects of a migration whose casts mostly fail, reconciled per tag."""
    rows = ParquetSink(scratch_path(spark, "rows"))
    rejects = ParquetSink(scratch_path(spark, "rejects"))
    migrate_documents(
        dirty(spark, sf_dir), rows, spec("Cast", name="I32"), row_id="event_id", rejects=rejects
    )
    placed = rows.read(spark).where(F.col("name").isNotNull())
    placed = placed.select(F.lit("placed").alias("outcome"))
    refused = rejects.read(spark).where("column = 'name'").select(F.col("actual").alias("outcome"))
    return placed.unionAll(refused).groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


def migrate_reconciled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table migrated twice under a key is there once, with one row for each key."""
    items = table(spark, sf_dir, "lineitem")
    sink = ParquetSink(scratch_path(spark, "twice"))
    key = ["l_orderkey", "l_linenumber"]
    append(items, sink, key)
    append(items, sink, key)
    return reconcile(items, sink.read(spark), key)


def evolve_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without ``ref`` first, the others after: the sink gains columns."""
    sink = ParquetSink(scratch_path(spark, "evolve"), evolve=True)
    docs = dirty(spark, sf_dir)
    short = F.expr(field("doc", "ref")).isNull()
    for part in (docs.where(short), docs.where(~short)):
        append(conform(part, spec("NewCol"), "event_id").rows, sink)
    return newcol_columns(sink.read(spark))


def export_documents_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "export")
    export_documents(table(spark, sf_dir, "conversations"), path)
    return spark.read.text(path)


def stream_migrate_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "stream")
    query = stream_migrate(
        spark, write_lines(spark, sf_dir), out, spec("NewCol"), scratch_path(spark, "checkpoint"), max_files_per_trigger=2
    )
    query.awaitTermination()
    rows = read_migrated(spark, out)
    ids = rows.withColumn("id", F.try_variant_get("id", "$", "bigint")).withColumn("event_id", F.col("id"))
    return newcol_columns(ids)


def stream_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream in which lines are broken and documents empty: every line is a row, or malformed."""
    lines = write_text(table(spark, sf_dir, "events").select(F.expr(SPARSE).alias("value")))
    out = scratch_path(spark, "stream")
    stream_migrate(
        spark, lines, out, spec("NewCol"), scratch_path(spark, "checkpoint"), max_files_per_trigger=1
    ).awaitTermination()
    rows, malformed = read_migrated(spark, out), read_migrated(spark, out, "malformed")
    counted = rows.select(F.when(F.col("id").isNull(), "empty").otherwise("document").alias("kind"))
    return counted.unionAll(malformed.select(F.lit("malformed"))).groupBy("kind").agg(F.count("*").alias("n"))


def stream_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream of 2,500 keys over four batches and more: one is declared, the others stay together."""
    lines = write_text(table(spark, sf_dir, "events").select(F.expr(WIDE).alias("value")))
    out = scratch_path(spark, "stream")
    declared = {"id": {"dtype": "I32", "dtype_collision_strategy": "NewCol"}}
    files = spark.read.text(lines).select(F.col("_metadata.file_path")).distinct().count()
    stream_migrate(
        spark, lines, out, declared, scratch_path(spark, "checkpoint"), max_files_per_trigger=-(-files // 4), rest="rest"
    ).awaitTermination()
    return read_migrated(spark, out).select(F.col("id").cast("bigint").alias("id"), "rest")


def stream_report_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a stream with broken lines reports, over all of its batches."""
    lines = write_text(table(spark, sf_dir, "events").select(F.expr(SPARSE).alias("value")))
    out = scratch_path(spark, "stream")
    stream_migrate(
        spark, lines, out, spec("Cast", name="I32"), scratch_path(spark, "checkpoint"), max_files_per_trigger=2
    ).awaitTermination()
    return stream_report(spark, out).groupBy("step").agg(F.sum("rows").alias("rows"))


def migrate_typed_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of 2,500 keys, one of them a typed column."""
    sink = ParquetSink(scratch_path(spark, "typed"))
    migrate_typed(documents(table(spark, sf_dir, "events"), WIDE, "event_id"), sink, keys=["id"], rest="rest")
    return sink.read(spark).select("event_id", F.col("id").cast("bigint").alias("id"), "rest")


def migrate_typed_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    sink = ParquetSink(scratch_path(spark, "typed"))
    migrate_typed(dirty(spark, sf_dir), sink)
    return sink.read(spark).select(
        "event_id",
        F.col("id").cast("bigint").alias("id"),
        "name_f64",
        F.col("name_i32").cast("bigint").alias("name_i32"),
        "name_str",
        F.to_json("name_vecstring").alias("name_vecstring"),
        F.col("ref_i32").cast("bigint").alias("ref_i32"),
        "ref_str",
    )


def migrate_json_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    sink = ParquetSink(scratch_path(spark, "json"))
    migrate_table(table(spark, sf_dir, "events").select("event_id", F.expr(ARRAYS).alias("c")), sink, json_columns=["c"])
    return sink.read(spark).select(
        "event_id", F.to_json("c_vec_f64").alias("numbers"), F.to_json("c_vecstring").alias("texts"), F.col("c_str").alias("other")
    )


def evolve_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole and floating numbers that get wider, and narrower again, from append to append."""
    sink = ParquetSink(scratch_path(spark, "wider"), evolve=True)
    events = table(spark, sf_dir, "events")
    for part, (whole, floating) in enumerate((("smallint", "float"), ("bigint", "float"), ("int", "double"))):
        rows = events.where(F.col("event_id") % 3 == part).select(
            "event_id",
            (F.col("event_id") % 100).cast(whole).alias("n"),
            (F.col("event_id") % 64 / 8).cast(floating).alias("x"),
            F.array((F.col("event_id") % 10).cast(whole)).alias("l"),
        )
        append(rows, sink)
    return sink.read(spark).withColumn("l", F.to_json("l"))


def append_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with NULL in their key, repeated in a batch and from batch to batch, are there once."""
    status = F.when(F.col("o_orderstatus") != "O", F.col("o_orderstatus")).alias("status")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", status, "o_totalprice")
    sink = ParquetSink(scratch_path(spark, "keyed"))
    for _ in range(2):
        append(orders.unionAll(orders), sink, ["o_orderkey", "status"])
    return sink.read(spark)


def append_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders under a key that many of them share: one row for each key, the others in the report."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus")
    sink = ParquetSink(scratch_path(spark, "repeated"))
    report = migrate_table(orders, sink, key=["o_custkey"])
    return report.where("step <> 'total'").select("step", "rows")


def append_once_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders whose parts were each written twice and a half, merged twice: they are there once."""
    url, properties = jdbc_target(spark)
    sink = JdbcSink(url, f"once_{uuid.uuid4().hex}", properties=properties)
    orders, run = table(spark, sf_dir, "orders"), uuid.uuid4().hex
    append_once(orders.limit(0), sink)
    for part in (orders, orders, orders.where("o_orderkey % 2 = 0")):
        stage(part, sink, run)
    for _ in range(2):
        merge(spark, sink, run, orders.columns)
        append_once(orders, sink, run)
    return sink.read(spark)


def profile_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A profile kept over three runs: some of the files, then all of them, of which only the new ones are read."""
    lines, store = write_lines(spark, sf_dir), scratch_path(spark, "profile")
    files = sorted(spark.read.text(lines).inputFiles())
    read = [update_profile(spark, wanted, store) for wanted in (files[: len(files) // 2], lines, lines)]
    assert sum(read) == len(files) and read[-1] == 0
    return read_profile(stored_profile(spark, store))


def shredded_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two keys of stored documents; the scan leaves the columns of the others alone."""
    path = scratch_path(spark, "shredded")
    write_shredded(dirty(spark, sf_dir), path)
    return read_keys(spark, path, "doc", {"id": "bigint", "ref": "string"}, carry=("event_id",))


QUERIES = {
    "scan_documents": scan_documents,
    "scan_json_array": scan_json_array,
    "migrate_table": migrate_table_query,
    "migration_report": migration_report,
    "migrate_documents": migrate_documents_query,
    "migrate_rejects": migrate_rejects,
    "migrate_reconciled": migrate_reconciled,
    "evolve_append": evolve_append,
    "export_documents": export_documents_query,
    "stream_migrate": stream_migrate_query,
    "stream_sparse": stream_sparse,
    "stream_wide": stream_wide,
    "stream_report": stream_report_query,
    "migrate_typed_wide": migrate_typed_wide,
    "migrate_typed": migrate_typed_query,
    "migrate_json_columns": migrate_json_columns,
    "evolve_types": evolve_types,
    "append_keyed": append_keyed,
    "append_repeated": append_repeated,
    "append_once": append_once_query,
    "profile_stored": profile_stored,
    "shredded_scan": shredded_scan,
}

# Sketch rows in plain SQL, and what is read off them.
PROFILE = f"""{CELLS_OF_D},
  v AS (SELECT 'id' AS key, 'I32' AS tag, CAST(event_id AS VARCHAR) AS j, CAST(event_id AS VARCHAR) AS x FROM d
    UNION ALL SELECT 'name', ntag, CAST(n AS VARCHAR), nt FROM t
    UNION ALL SELECT 'ref', stag, CAST(s AS VARCHAR), st FROM t WHERE event_id % 3 < 2),
  h AS (SELECT key, tag, CASE WHEN tag IN ('I32', 'I64', 'Double64') THEN CAST(x AS DOUBLE) END AS number,
    CASE WHEN tag <> 'None' THEN md5(CASE WHEN tag = 'Double64' THEN regexp_replace(j, '[.]0$', '') ELSE j END) END AS hash FROM v),
  p AS (SELECT key, tag, number, floor(log2(CASE WHEN number <> 0 THEN abs(number) END)) AS e,
    CAST('0x' || substr(hash, 1, 3) AS BIGINT) % 1024 AS register, CAST('0x' || substr(hash, 4, 13) AS BIGINT) AS bits FROM h),
  b AS (SELECT key, tag, CASE WHEN number = 0 THEN 0
      ELSE sign(number) * (100000 + e * 64 + floor((abs(number) / pow(2, e) - 1) * 64)) END AS slot, count(*) AS n FROM p GROUP BY ALL),
  a AS (SELECT key, tag, CAST(sum(n) AS BIGINT) AS n FROM b GROUP BY ALL),
  r AS (SELECT key, tag, register, max(CASE WHEN bits = 0 THEN 53 ELSE 53 - length(bin(bits)) END) AS run
    FROM p WHERE bits IS NOT NULL GROUP BY ALL),
  l AS (SELECT key, tag, 1024 - count(*) AS empty, sum(pow(2.0, -run)) + 1024 - count(*) AS harmonic FROM r GROUP BY ALL),
  w AS (SELECT *, 0.7213 / (1 + CAST(1.079 AS DOUBLE) / 1024) * 1024 * 1024 / harmonic AS raw FROM l),
  k AS (SELECT key, tag, CAST(round(CASE WHEN raw <= 2560 AND empty > 0 THEN 1024 * ln(CAST(1024 AS DOUBLE) / nullif(empty, 0)) ELSE raw END) AS BIGINT)
    AS n_distinct FROM w),
  o AS (SELECT key, tag, slot, sum(n) OVER (PARTITION BY key, tag ORDER BY slot) AS up_to, sum(n) OVER (PARTITION BY key, tag) AS numbers
    FROM b WHERE slot IS NOT NULL),
  g AS (SELECT key, tag, q, min(slot) AS slot FROM o, (VALUES (CAST(0.5 AS DOUBLE)), (0.95), (0.99)) AS s(q) WHERE up_to >= ceil(numbers * q) GROUP BY ALL),
  f AS (SELECT key, tag, q, slot, floor((abs(slot) - 100000) / 64) AS e, abs(slot) - 100000 AS place FROM g),
  m AS (SELECT key, tag, q, CASE WHEN slot = 0 THEN 0.0 ELSE sign(slot) * pow(2.0, e) * (1 + (place - e * 64 + 0.5) / CAST(64 AS DOUBLE)) END AS middle FROM f)
  SELECT key, tag, a.n, n_distinct, CAST(max(middle) FILTER (WHERE q = 0.5) AS DOUBLE) AS p50,
    CAST(max(middle) FILTER (WHERE q = 0.95) AS DOUBLE) AS p95, CAST(max(middle) FILTER (WHERE q = 0.99) AS DOUBLE) AS p99
  FROM a LEFT JOIN k USING (key, tag) LEFT JOIN m USING (key, tag) GROUP BY key, tag, a.n, n_distinct"""

ORACLES = {
    "scan_documents": f"{CELLS_OF_D} SELECT event_id AS id, nt AS name, st AS ref FROM t",
    "scan_json_array": f"{CELLS_OF_D} SELECT event_id AS id, nt AS name, st AS ref FROM t",
    "migrate_table": f"""SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
        {_TS_TEXT.format('o_orderdate')} AS o_orderdate FROM orders""",
    "migration_report": """SELECT 'append' AS step, CAST(count(*) AS BIGINT) AS rows, true AS has_rate FROM lineitem
        UNION ALL SELECT 'total', CAST(count(*) AS BIGINT), true FROM lineitem""",
    "migrate_documents": NEWCOL,
    "migrate_rejects": f"""{CELLS_OF_D}, o AS (SELECT CASE WHEN ntag = 'I32' THEN 'placed' ELSE ntag END AS outcome
        FROM t WHERE ntag <> 'None') SELECT outcome, CAST(count(*) AS BIGINT) AS n FROM o GROUP BY outcome""",
    "migrate_reconciled": """WITH k AS (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)
        SELECT CAST(sum(n) AS BIGINT) AS n_a, CAST(count(*) AS BIGINT) AS n_b, CAST(sum(n) - count(*) AS BIGINT) AS missing,
          CAST(0 AS BIGINT) AS extra, '' AS missing_columns, '' AS extra_columns, sum(n) = count(*) AS matches FROM k""",
    "evolve_append": NEWCOL,
    "export_documents": """SELECT CAST(to_json({'conv_id': conv_id, 'turn': turn, 'role': role, 'text': text})
        AS VARCHAR) AS value FROM conversations""",
    "stream_migrate": NEWCOL,
    "stream_sparse": """SELECT CASE WHEN event_id % 5 = 0 THEN 'empty' WHEN event_id % 7 = 0 THEN 'malformed'
        ELSE 'document' END AS kind, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY ALL""",
    "stream_wide": """SELECT event_id AS id, concat('{"k', event_id % 2500, '":', user_id, '}') AS rest FROM events""",
    "stream_report": f"""{CELLS_OF_D}, r AS (SELECT event_id % 5 <> 0 AND event_id % 7 <> 0 AS whole, event_id % 5 <> 0 AND event_id % 7 = 0 AS broken,
          event_id, ntag FROM t)
        SELECT 'append' AS step, CAST(count(*) - sum(CAST(broken AS INT)) AS BIGINT) AS rows FROM r
        UNION ALL SELECT 'malformed', CAST(count(*) AS BIGINT) FROM r WHERE broken
        UNION ALL SELECT 'rejects', CAST(count(*) AS BIGINT) FROM r WHERE whole AND ntag NOT IN ('None', 'I32')""",
    "migrate_typed_wide": """SELECT event_id, event_id AS id, concat('{"k', event_id % 2500, '":', user_id, '}') AS rest FROM events""",
    "migrate_typed": f"""{CELLS_OF_D} SELECT event_id, event_id AS id,
        CASE WHEN ntag = 'Double64' THEN CAST(nt AS DOUBLE) END AS name_f64,
        CASE WHEN ntag = 'I32' THEN CAST(nt AS BIGINT) END AS name_i32,
        CASE WHEN ntag IN ('String', 'Bool', 'Object') THEN nt END AS name_str,
        CASE WHEN ntag = 'VecDyn' THEN nt END AS name_vecstring,
        CASE WHEN stag = 'I32' THEN CAST(st AS BIGINT) END AS ref_i32,
        CASE WHEN stag = 'String' THEN st END AS ref_str FROM t""",
    "migrate_json_columns": """SELECT event_id,
        CASE event_id % 7 WHEN 0 THEN to_json([CAST(user_id AS DOUBLE), CAST(event_id AS DOUBLE), NULL, NULL])
          WHEN 6 THEN to_json([value + 0.25, CAST(user_id AS DOUBLE)]) END AS numbers,
        CASE event_id % 7 WHEN 1 THEN concat('["', event_type, '","', user_id, '","null","[1,', user_id, ']"]') END AS texts,
        CASE event_id % 7 WHEN 3 THEN concat('[true,', user_id, ']')
          WHEN 4 THEN CAST(CAST(props AS JSON) -> '$' AS VARCHAR) END AS other FROM events""",
    "evolve_types": """SELECT event_id, event_id % 100 AS n, CAST(event_id % 64 / 8.0 AS DOUBLE) AS x, concat('[', event_id % 10, ']') AS l FROM events""",
    "append_keyed": """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'O' THEN o_orderstatus END AS status, o_totalprice
        FROM orders""",
    "append_repeated": """WITH k AS (SELECT o_custkey, count(*) AS n, count(DISTINCT coalesce(o_orderstatus, '')) AS kinds FROM orders GROUP BY 1)
        SELECT 'append' AS step, CAST(count(*) AS BIGINT) AS rows FROM k
        UNION ALL SELECT 'repeated', CAST(sum(CASE WHEN kinds > 1 THEN n - 1 ELSE 0 END) AS BIGINT) FROM k HAVING max(kinds) > 1""",
    "append_once": "SELECT * FROM orders",
    "profile_stored": PROFILE,
    "shredded_scan": f"{CELLS_OF_D} SELECT event_id, event_id AS id, st AS ref FROM t",
}
