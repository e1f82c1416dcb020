"""Change-log rows to a typed, deduplicated, change-compacted history."""

from __future__ import annotations

from pyspark.sql import Column as SparkColumn
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.casts import cast_to, effective_time
from ..functions.documents import as_document, canonical_json, json_get
from ..functions.hashing import row_hash, surrogate_key
from ..operators.skew import sampled, task_limit
from ..operators.watermark import current_watermark, watermark_filter
from ..sources.scans import scan_cdc
from ..sources.tables import stage
from .history import CHANGED, HASH, LOADED, REFERENCE, TIME, changes
from .specs import CdcSpec, Column

DELETED = "is_deleted_in_source"


def _input(column: Column) -> str:
    return column.source.split(":")[0]


def cdc_rows(spec: CdcSpec, source: DataFrame) -> DataFrame:
    """Typed and renamed columns with their row hash; copies still included."""
    scan = scan_cdc(source, [*map(_input, spec.columns), spec.loaded, spec.deleted, spec.effective])
    types = {f.name.lower(): f.dataType for f in scan.schema.fields}

    def typed(column: Column) -> SparkColumn:
        name, _, path = column.source.partition(":")
        col, kind = F.col(f"`{name}`"), types[name.lower()]
        if path:
            return json_get(as_document(col, kind, spec.on_error), f"$.{path}", column.type, spec.time_type, spec.on_error)
        if column.type == "json":
            return canonical_json(as_document(col, kind, spec.on_error))
        target = spec.time_type if column.type == "timestamp" else column.type
        return cast_to(col, target, kind, spec.on_error)

    effective = effective_time(F.col(spec.effective), types[spec.effective.lower()], spec.time_type, spec.on_error)
    rows = scan.select(
        *[typed(c).alias(c.name) for c in spec.columns],
        F.col(spec.loaded).cast(spec.time_type).alias(LOADED),
        cast_to(F.col(spec.deleted), "boolean").alias(DELETED),
        effective.alias(TIME),
    )
    tracked = [c.name for c in spec.columns if c.tracked]
    return rows.withColumn(HASH, row_hash(rows, tracked + [DELETED] * spec.track_deletes))


def finish_cdc(spec: CdcSpec, rows: DataFrame) -> DataFrame:
    """Surrogate key and column order."""
    names = [f"`{c.name}`" for c in spec.columns]
    kept = [c for c in (CHANGED,) if c in rows.columns]
    key = surrogate_key(rows, spec.key, TIME).alias(spec.unique_key)
    return rows.select(key, *names, LOADED, DELETED, TIME, HASH, *kept)


def cdc_history(
    spec: CdcSpec,
    source: DataFrame,
    target: DataFrame | None = None,
    mode: str = REFERENCE,
    watermark: str | None = None,
    task_rows: int | None = None,
) -> DataFrame:
    """History rows of a change log, or with ``target`` the rows to upsert into it.

    With a target only rows loaded since the day of its newest row are read;
    ``watermark`` gives that day if the caller knows it. An empty target counts
    as none. In ``consistent`` mode the result is all versions of each key in the
    batch, with ``is_change``, and takes the place of that key's stored rows
    (``load`` does the same from the first new version of a key on);
    ``history_of`` takes the history out of it.
    """
    if target is not None and watermark is None:
        watermark = current_watermark(target, LOADED)
    source = watermark_filter(source, spec.loaded, watermark, spec.loaded_day)
    rows = cdc_rows(spec, source)
    if watermark is None or target is None:
        # the source is read once in full, and a few of its rows for the cuts
        limit = task_rows or task_limit(rows)
        sample = cdc_rows(spec, sampled(source, limit))
        return finish_cdc(spec, changes(rows, spec.key, LOADED, mode=mode, sample=sample, task_rows=limit))
    return finish_cdc(spec, changes(stage(rows), spec.key, LOADED, target, mode, task_rows=task_rows))
