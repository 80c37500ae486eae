"""Moving tables and ragged documents between stores with Spark, types kept honest."""

from tablebridge.functions.cells import (
    HOMOGENISE,
    HTTP,
    NESTED,
    TYPED,
    json_text,
    normalise_columns,
    safe_decode,
)
from tablebridge.functions.rows import encode_nested, normalise_sql
from tablebridge.functions.tags import with_tags
from tablebridge.operators.align import align, normalise, split_mixed
from tablebridge.operators.columns import ignore_columns, ignore_keys, missing_columns, select_existing
from tablebridge.operators.conform import Conformed, conform, conform_with_rejects, split_rejects
from tablebridge.operators.discover import (
    batch_plan,
    discover,
    discover_keys,
    profile,
    schema_report,
    shape_groups,
    with_spec,
)
from tablebridge.operators.locate import differing_ranges, locate_differences
from tablebridge.operators.profile_store import merge_profiles, read_profile, sketch_profile, stored_profile, update_profile
from tablebridge.operators.reconcile import differences, reconcile, replicate
from tablebridge.plans.migrate import (
    export_documents,
    load_collection,
    migrate_bulk,
    migrate_documents,
    migrate_table,
)
from tablebridge.sinks.append import JdbcSink, ParquetSink, append, evolve
from tablebridge.sinks.once import append_once
from tablebridge.sinks.bulk import BulkDataSource, BulkSink, bulk_payloads
from tablebridge.sinks.shredded import read_keys, write_shredded
from tablebridge.sources.arrays import read_json_arrays
from tablebridge.sources.documents import parse_documents, read_collection, read_documents, read_json_files, spread
from tablebridge.sources.tables import (
    Partitioning,
    count_jdbc,
    count_table,
    jdbc_names,
    list_databases,
    list_tables,
    read_parquet,
    read_table,
    split_by,
    split_evenly,
    table_inventory,
)
from tablebridge.spec import ColumnSpec, parse_spec
from tablebridge.streaming.migrate import read_migrated, stream_migrate, stream_report

__all__ = [name for name in dir() if not name.startswith("_")]
