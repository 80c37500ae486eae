"""Inputs that Spark derives from the driver tables. Each text is valid in Spark SQL and in the oracle's SQL alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tablebridge.sources.documents import parse_documents, spread

# One ragged document per event: ``name`` takes seven types in turn, ``ref`` is a number, a text or missing.
DIRTY = """concat('{"id":', event_id, ',"name":',
  CASE event_id % 7
    WHEN 0 THEN concat('"', event_type, '"')
    WHEN 1 THEN cast(event_id AS varchar(20))
    WHEN 2 THEN concat('["', event_type, '","x"]')
    WHEN 3 THEN props
    WHEN 4 THEN 'null'
    WHEN 5 THEN 'true'
    ELSE cast(value AS varchar(40)) END,
  CASE WHEN event_id % 3 = 0 THEN concat(',"ref":"', user_id, '"')
       WHEN event_id % 3 = 1 THEN concat(',"ref":', user_id) ELSE '' END, '}')"""

# One document per order with an object in it, whose own fields change type as well.
NESTED = """concat('{"id":', o_orderkey, ',"customer":',
  CASE WHEN o_orderkey % 5 = 0 THEN concat('"', o_custkey, '"')
       ELSE concat('{"key":',
         CASE WHEN o_custkey % 3 = 0 THEN concat('"', o_custkey, '"') ELSE cast(o_custkey AS varchar(20)) END,
         ',"priority":', CASE WHEN o_custkey % 4 = 0 THEN cast(o_custkey AS varchar(20))
                              ELSE concat('"', o_orderpriority, '"') END,
         CASE WHEN o_orderstatus = 'F' THEN ',"closed":true' ELSE '' END, '}') END, '}')"""

# One document per order with an array of objects, whose fields change type; some elements are no objects.
ITEMS = """concat('{"id":', o_orderkey, ',"items":', CASE WHEN o_orderkey % 11 = 0 THEN '[]' WHEN o_orderkey % 7 = 0 THEN '"none"' ELSE
  concat('[{"sku":', o_custkey, ',"qty":"', o_orderkey % 9, '"},',
    CASE WHEN o_orderkey % 3 = 0 THEN cast(o_custkey AS varchar(20)) ELSE concat('{"sku":"', o_orderstatus, '","qty":', o_custkey, ',"tag":true}') END,
    ',null,{"qty":"', o_orderstatus, '","parts":[{"n":', o_orderkey, '},{"n":"', o_orderstatus, '"}]}]') END, '}')"""

# One mixed array per event.
MIXED = """concat('[', event_id, ',"', event_type, '",', user_id, ',[', user_id, ',"', event_type, '",true],',
  CASE WHEN event_id % 2 = 0 THEN 'false' ELSE 'null' END, ',{"k":', user_id, '}]')"""

# One Extended-JSON document per event; ``{millis}`` stands for the engine's epoch milliseconds of ``ts``.
EXTENDED = """concat('{{"_id":{{"$oid":"', lpad(cast(event_id AS varchar(24)), 24, '0'), '"}},"at":{{"$date":{{"$numberLong":"', {millis},
  '"}}}},"n":{{"$numberLong":"', user_id, '"}},"amount":{{"$numberDecimal":"', cast(value AS varchar(40)), '"}},"ok":true,"list":',
  CASE event_id % 5
    WHEN 0 THEN concat('[', user_id, ',2,3]')
    WHEN 1 THEN concat('["', event_type, '",', user_id, ',null]')
    WHEN 2 THEN '[]'
    WHEN 3 THEN concat('[', cast(value + 0.5 AS varchar(40)), ',', user_id, ']')
    ELSE concat('[true,{{"$numberInt":"', user_id, '"}}]') END,
  ',"obj":{{"d":{{"$date":{{"$numberLong":"', {millis}, '"}}}},"i":[{{"$oid":"', event_type, '"}}]}}}}')"""
SPARK_MILLIS = "cast(unix_millis(cast(concat(cast(ts AS string), 'Z') AS timestamp)) AS varchar(20))"
ORACLE_MILLIS = "cast(epoch_us(ts) // 1000 AS varchar(20))"

# One Extended-JSON value per event under a declared integer; the first half of them are no values of their type.
MALFORMED = """concat('{"v":', CASE event_id % 8
    WHEN 0 THEN '{"$date":"not a date"}'
    WHEN 1 THEN concat('{"$numberInt":"', 3000000000 + event_id, '"}')
    WHEN 2 THEN concat('{"$numberLong":"9999999999999999999', user_id, '"}')
    WHEN 3 THEN concat('{"$numberDecimal":"', event_type, '"}')
    WHEN 4 THEN concat('{"$numberInt":"', user_id, '"}')
    WHEN 5 THEN concat('{"$numberLong":"', event_id, '"}')
    WHEN 6 THEN concat('{"$oid":"', event_type, '"}')
    ELSE cast(user_id AS varchar(20)) END, '}')"""

# Arrays and numbers for declared types: whole numbers, text, nothing, numbers too wide, numbers with a fraction.
DECLARED = """concat('{"list":', CASE event_id % 5
    WHEN 0 THEN concat('[', user_id, ',2]')
    WHEN 1 THEN concat('["', event_type, '"]')
    WHEN 2 THEN '[]'
    WHEN 3 THEN concat('[', user_id, ',3000000000]')
    ELSE concat('"', event_type, '"') END,
  ',"ratio":', CASE event_id % 3 WHEN 0 THEN '0.5' WHEN 1 THEN '1.25' ELSE concat('"', event_type, '"') END, '}')"""

# One key of 2,500 in turn, beside an id.
WIDE = """concat('{"id":', event_id, ',"k', event_id % 2500, '":', user_id, '}')"""

# Every fifth line is an empty document, every seventh of the others is cut short.
SPARSE = f"""CASE WHEN event_id % 5 = 0 THEN '{{}}'
    WHEN event_id % 7 = 0 THEN substr({DIRTY}, 1, 12) ELSE {DIRTY} END"""

# One JSON value per event for homogenising.
ARRAYS = """CASE event_id % 7
    WHEN 0 THEN concat('[', user_id, ',', event_id, ',"', event_type, '",true]')
    WHEN 1 THEN concat('["', event_type, '",', user_id, ',null,[1,', user_id, ']]')
    WHEN 2 THEN '[]'
    WHEN 3 THEN concat('[true,', user_id, ']')
    WHEN 4 THEN props
    WHEN 5 THEN 'null'
    ELSE concat('[', cast(value + 0.25 AS varchar(40)), ',', user_id, ']') END"""

# One text cell per event for decoding.
CELLS = """CASE event_id % 11
    WHEN 0 THEN cast(event_id AS varchar(20))
    WHEN 1 THEN concat('+', user_id)
    WHEN 2 THEN concat(' ', user_id, ' ')
    WHEN 3 THEN concat(user_id, '.5')
    WHEN 4 THEN concat('3000000', event_id)
    WHEN 5 THEN ''
    WHEN 6 THEN event_type
    WHEN 7 THEN 'true'
    WHEN 8 THEN props
    WHEN 9 THEN concat('[', user_id, ',2]')
    ELSE concat('-', event_id) END"""

# Every tenth line is cut short, every eleventh is an array, every thirteenth is empty.
BROKEN = f"""CASE WHEN event_id % 10 = 0 THEN substr({DIRTY}, 1, 12)
    WHEN event_id % 11 = 0 THEN concat('[', event_id, ']')
    WHEN event_id % 13 = 0 THEN '' ELSE {DIRTY} END"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(df: DataFrame, text: str, carry: str) -> DataFrame:
    """``(carry, doc)``: the documents that ``text`` spells."""
    return parse_documents(df.select(carry, F.expr(text).alias("value"))).docs


def dealt(df: DataFrame, text: str, carry: str) -> DataFrame:
    """:func:`documents`, dealt out over all cores before they are parsed."""
    return parse_documents(spread(df.select(carry, F.expr(text).alias("value")))).docs


def dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(table(spark, sf_dir, "events"), DIRTY, "event_id")


def dealt_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dealt(table(spark, sf_dir, "events"), DIRTY, "event_id")


def extended(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dealt(table(spark, sf_dir, "events"), EXTENDED.format(millis=SPARK_MILLIS), "event_id")
