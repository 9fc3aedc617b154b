"""Scans (SRC-*).  Every reader returns a lazy DataFrame; planning that needs
file heads (encoding, separator, header) touches only the first bytes of each
file through the Hadoop FileSystem API, never the data itself."""

from judicata.sources.catalogue import csv_resources, landed_files, latest_snapshots  # noqa: F401
from judicata.sources.csv import read_csv_smart  # noqa: F401
from judicata.sources.files import read_json_docs, read_parquet_merged  # noqa: F401
from judicata.sources.registry import source_registry  # noqa: F401
from judicata.sources.sheet import find_header_row, profile_headers, sheet_to_long  # noqa: F401
from judicata.sources.text import read_latin1_lines, read_zip_lines  # noqa: F401
from judicata.sources.xlsx import read_xlsx_rows  # noqa: F401
