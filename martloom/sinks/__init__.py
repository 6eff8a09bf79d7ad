"""Audit stamps, table writes, upserts into tables, quarantine, views."""

from martloom.sinks.audit import add_audit, stamp
from martloom.sinks.keyed import files_of, load_bucketed, load_history, load_indexed, old_partitions
from martloom.sinks.quarantine import error_rows, quarantine, split_once
from martloom.sinks.tables import drop_old_versions, future_view, load, load_where, replace, save, upsert_table

__all__ = [
    "add_audit",
    "drop_old_versions",
    "error_rows",
    "files_of",
    "future_view",
    "load",
    "load_bucketed",
    "load_history",
    "load_indexed",
    "load_where",
    "old_partitions",
    "quarantine",
    "replace",
    "save",
    "split_once",
    "stamp",
    "upsert_table",
]
