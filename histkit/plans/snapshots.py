"""JSON snapshot documents to a deduplicated, change-compacted history."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.documents import json_get, member_path
from ..functions.hashing import row_hash, surrogate_key
from ..operators.children import child_columns, child_list, lateral_left
from ..operators.skew import sampled, task_limit
from ..operators.versions import change_history, dedupe_versions
from ..operators.watermark import current_watermark, watermark_filter
from ..sources.scans import scan_json
from ..sources.tables import stage
from .history import CHANGED, CONSISTENT, HASH, LANDED, LOADED, REFERENCE, TIME, changes
from .specs import SnapshotSpec

IN_ROW, LATERAL = "in_row", "lateral"


def output_columns(spec: SnapshotSpec) -> list[str]:
    """Data columns in output order, child columns after the column they follow."""
    names = []
    for c in spec.columns:
        names.append(c.name)
        if spec.children and spec.children.after == c.name:
            names.extend(spec.children.types.values())
    return names


def _parsed(spec: SnapshotSpec, source: DataFrame) -> DataFrame:
    """Document paths as typed columns, the child list, load time."""
    paths = [c.source for c in (*spec.columns, spec.effective)] + ([spec.children.path] if spec.children else [])
    members = {member_path(p)[0]: "variant" for p in paths}
    scan = scan_json(source, members, spec.payload, spec.loaded, spec.on_error)

    def at(path):
        name, rest = member_path(path)
        return F.col("document")[name], rest

    def read(column):
        return json_get(*at(column.source), column.type, spec.time_type, spec.on_error)

    cols = [read(c).alias(c.name) for c in spec.columns]
    cols.append(read(spec.effective).alias(TIME))
    if spec.children:
        ch = spec.children
        cols.append(child_list(*at(ch.path), ch.id_field, ch.type_field, spec.on_error).alias("_children"))
    rows = scan.select(*cols, F.col(spec.loaded).alias(LANDED))
    for name in spec.require_not_null:
        rows = rows.where(F.col(name).isNotNull())
    return rows


def _hashed(spec: SnapshotSpec, rows: DataFrame) -> DataFrame:
    untracked = {c.name for c in spec.columns if not c.tracked}
    return rows.withColumn(HASH, row_hash(rows, [c for c in output_columns(spec) if c not in untracked]))


def snapshot_rows(spec: SnapshotSpec, source: DataFrame) -> DataFrame:
    """Typed rows with child columns and row hash; copies still included."""
    rows = _parsed(spec, source)
    if spec.children:
        rows = rows.select("*", *child_columns(F.col("_children"), spec.children.types)).drop("_children")
    return _hashed(spec, rows)


def _lateral_rows(spec: SnapshotSpec, source: DataFrame) -> DataFrame:
    """Children joined on the key alone, one join per type: rows may multiply."""
    rows = _parsed(spec, source)
    order = [LANDED, F.md5(F.to_json(F.struct(*[c for c in rows.columns if c != LANDED])))]
    rows = dedupe_versions(rows, spec.key, TIME, order)
    children = rows.select(spec.key, F.explode("_children").alias("_child"))
    children = children.select(spec.key, F.col("_child.type").alias("_type"), F.col("_child.id").alias("_id"))
    # a child repeated on many dates would give equal rows, which compaction drops anyway
    children = children.distinct()
    wide = lateral_left(rows.drop("_children"), children, spec.key, "_type", "_id", spec.children.types)
    return _hashed(spec, wide)


def finish_snapshots(spec: SnapshotSpec, rows: DataFrame, run_ts: str | None) -> DataFrame:
    """Surrogate key, load time of this run, column order."""
    stamp = F.current_timestamp() if run_ts is None else F.lit(run_ts)
    kept = [LANDED, CHANGED] if CHANGED in rows.columns else []
    return rows.select(
        surrogate_key(rows, spec.key, TIME).alias(spec.unique_key),
        *output_columns(spec),
        TIME,
        HASH,
        stamp.cast(spec.time_type).alias(LOADED),
        *kept,
    )


def json_history(
    spec: SnapshotSpec,
    source: DataFrame,
    target: DataFrame | None = None,
    run_ts: str | None = None,
    mode: str = REFERENCE,
    watermark: str | None = None,
    carry_all: bool = True,
    children: str = IN_ROW,
    task_rows: int | None = None,
) -> DataFrame:
    """History rows of snapshots, or with ``target`` the rows to upsert into it.

    Rows carry the load time of the run, ``run_ts``. By default the last
    stored version of every key is returned too and so gets that load time,
    even if the batch has nothing on the key; ``carry_all=False`` leaves these
    alone and reads the target only for the keys in the batch.
    ``children="lateral"`` joins child columns on the key alone. In ``consistent``
    mode the result is all versions of each key in the batch, with ``is_change``
    and when they landed; see ``cdc_history``.
    """
    if target is not None and watermark is None:
        watermark = current_watermark(target, LOADED)
    source = watermark_filter(source, spec.loaded, watermark, spec.loaded_day)
    stored = target if watermark is not None else None
    if children == LATERAL and (stored is not None or mode == CONSISTENT):
        raise ValueError("lateral children do not keep (key, time) unique: full rebuild only")
    rows = snapshot_rows(spec, source)
    if stored is not None:
        if mode != CONSISTENT:
            # when a stored version landed is not kept
            stored = stored.withColumn(LANDED, F.lit(None).cast(rows.schema[LANDED].dataType))
            stored = stored.select(*rows.columns, *[c for c in (CHANGED,) if c in stored.columns])
        wide = changes(stage(rows), spec.key, LANDED, stored, mode, carry_all, task_rows=task_rows)
        return finish_snapshots(spec, wide, run_ts)
    # documents are parsed once, and a few of them for the cuts
    limit = task_rows or task_limit(rows)
    sample = _parsed(spec, sampled(source, limit))
    if children == LATERAL:
        wide = change_history(_lateral_rows(spec, source), spec.key, TIME, None, HASH, sample, limit)
    else:
        wide = changes(rows, spec.key, LANDED, mode=mode, sample=sample, task_rows=limit)
    return finish_snapshots(spec, wide, run_ts)
