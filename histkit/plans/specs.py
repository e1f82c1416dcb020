"""Table descriptions for the three pipelines."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace

from ..functions.casts import FAIL


@dataclass(frozen=True)
class Column:
    """An output column: its name, its type and the input it comes from.

    ``source`` is an input column, for documents a JSON path, and
    ``column:path`` reads a path of an input column that holds JSON text.
    Untracked columns do not take part in change detection.
    """

    name: str
    type: str
    source: str
    tracked: bool = True


def columns(text: str, path: bool = False) -> tuple[Column, ...]:
    """Columns from lines of ``name type [source]``.

    The source defaults to the name; with ``path`` it is read as a path below
    the document root.
    """
    out = []
    for line in text.strip().splitlines():
        name, kind, *source = line.split()
        at = source[0] if source else name
        out.append(Column(name, kind, f"$.{at}" if path else at))
    return tuple(out)


def fields(text: str) -> dict[str, str]:
    """Attribute kinds from words of the form ``name:kind``."""
    return dict(word.split(":") for word in text.split())


@dataclass(frozen=True)
class CdcSpec:
    """A change log to keep as a history.

    ``loaded_day`` names a partition column of the raw table that holds the day
    of the load time, as a date or as text; batches then read its directories only.
    """

    name: str
    source: tuple[str, str]
    unique_key: str
    columns: tuple[Column, ...]
    key: str = "id"
    loaded: str = "_h2_sf_inserted"
    loaded_day: str | None = None
    deleted: str = "_h2_is_deleted"
    effective: str = "_h2_binlog_ts_ms"
    time_type: str = "timestamp"
    track_deletes: bool = False
    on_error: str = FAIL

    def with_(self, **changes) -> CdcSpec:
        return replace(self, **changes)


@dataclass(frozen=True)
class ChildColumns:
    """Columns made from a typed child list of a document (C4)."""

    path: str
    id_field: str
    type_field: str
    types: Mapping[str, str]
    after: str


@dataclass(frozen=True)
class SnapshotSpec:
    """JSON snapshots to keep as a history."""

    name: str
    source: tuple[str, str]
    unique_key: str
    columns: tuple[Column, ...]
    key: str
    effective: Column
    children: ChildColumns | None = None
    require_not_null: tuple[str, ...] = ()
    payload: str = "raw_data"
    loaded: str = "raw_inserted_timestamp"
    loaded_day: str | None = None
    time_type: str = "timestamp"
    on_error: str = FAIL

    def with_(self, **changes) -> SnapshotSpec:
        return replace(self, **changes)


@dataclass(frozen=True)
class AttributeSpec:
    """Attribute-list documents to turn into wide rows."""

    name: str
    source: tuple[str, str]
    fields: Mapping[str, str] = field(default_factory=dict)
    payload: str = "raw_data"
    loaded: str = "raw_inserted_timestamp"
    loaded_day: str | None = None
    time_type: str = "timestamp"
    timestamp_format: str | None = None
    on_error: str = FAIL

    def with_(self, **changes) -> AttributeSpec:
        return replace(self, **changes)
