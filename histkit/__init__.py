"""Raw landing tables to clean, versioned tables, as Spark jobs."""

from .plans import (
    MODELS,
    AttributeSpec,
    CdcSpec,
    SnapshotSpec,
    attribute_pivot,
    cdc_history,
    json_history,
    load,
    read_history,
)
from .sources import HistoryTable, read_source

__all__ = [
    "AttributeSpec",
    "CdcSpec",
    "HistoryTable",
    "MODELS",
    "SnapshotSpec",
    "attribute_pivot",
    "cdc_history",
    "json_history",
    "load",
    "read_history",
    "read_source",
]
