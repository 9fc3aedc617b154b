"""Sinks (SNK-*): tidy parquet with provenance, contract JSON documents, manifest
upsert, catalog tables, run log, CSV export, versioned snapshots."""

from judicata.sinks.manifest import upsert  # noqa: F401
from judicata.sinks.writers import (  # noqa: F401
    append_run_log, contract_document, document_text, export_csv, formatted, latest_snapshot, load_table, olap_load, present, presented, run_log, to_year_map,
    write_jdbc, write_snapshot, write_tidy,
)
