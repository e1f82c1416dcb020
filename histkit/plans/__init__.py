"""Pipelines from raw tables to histories and wide rows, and their descriptions."""

from .attributes import attribute_pivot, infer_spec
from .cdc import cdc_history, cdc_rows
from .history import CONSISTENT, REFERENCE, history_of, replace_keys
from .load import load, read_history
from .models import MODELS
from .snapshots import json_history, snapshot_rows
from .specs import AttributeSpec, CdcSpec, ChildColumns, Column, SnapshotSpec, columns, fields

__all__ = [
    "AttributeSpec",
    "CONSISTENT",
    "CdcSpec",
    "ChildColumns",
    "Column",
    "MODELS",
    "REFERENCE",
    "SnapshotSpec",
    "attribute_pivot",
    "cdc_history",
    "cdc_rows",
    "columns",
    "fields",
    "history_of",
    "infer_spec",
    "json_history",
    "load",
    "read_history",
    "replace_keys",
    "snapshot_rows",
]
