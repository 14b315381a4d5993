"""Sources (CSV / Parquet tables) and sinks (report frames, parquet)."""

from tessera.sources.sinks import predictions_sample, preview, schema_report, write_report, write_run_report
from tessera.sources.tables import Quarantine, load_tables, read_quarantined, read_table, string_schema

__all__ = [
    "Quarantine",
    "load_tables",
    "predictions_sample",
    "preview",
    "read_quarantined",
    "read_table",
    "schema_report",
    "string_schema",
    "write_report",
    "write_run_report",
]
