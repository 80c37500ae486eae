"""Queries over the driver tables, each beside the SQL that states its result."""

from tablebridge.registered import documents, jobs, tables

QUERIES = {**tables.QUERIES, **documents.QUERIES, **jobs.QUERIES}
ORACLES = {**tables.ORACLES, **documents.ORACLES, **jobs.ORACLES}
