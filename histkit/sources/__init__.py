"""Raw tables in, history tables out."""

from .catalog import SOURCES, Source, read_source
from .profiles import compare_columns, profile_periods, stored_profile
from .scans import scan_attributes, scan_cdc, scan_files, scan_json, store_documents
from .tables import BucketedTable, HistoryTable, merge_into, remove_staged, shared_folder, stage, upsert

__all__ = [
    "BucketedTable",
    "HistoryTable",
    "SOURCES",
    "Source",
    "compare_columns",
    "merge_into",
    "profile_periods",
    "read_source",
    "remove_staged",
    "scan_attributes",
    "scan_cdc",
    "scan_files",
    "scan_json",
    "shared_folder",
    "stage",
    "store_documents",
    "stored_profile",
    "upsert",
]
