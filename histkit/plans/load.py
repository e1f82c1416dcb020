"""Run a table description against its stored table."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame

from ..operators.checks import Checks, observed
from ..operators.watermark import watermark_filter
from ..sources.tables import HistoryTable, stage
from .attributes import attribute_pivot
from .cdc import cdc_history, cdc_rows, finish_cdc
from .history import (
    CHANGED,
    CONSISTENT,
    LANDED,
    LOADED,
    REFERENCE,
    TIME,
    earliest,
    first_versions,
    history_of,
    rebuild_tails,
)
from .snapshots import IN_ROW, finish_snapshots, json_history, snapshot_rows
from .specs import AttributeSpec, CdcSpec, SnapshotSpec

HEADER_TIME = "lastUpdated"


def read_history(table: HistoryTable, since: str | None = None) -> DataFrame:
    """The history in a stored table, whichever mode keeps it."""
    return history_of(table.rows(since))


def load(
    spec: CdcSpec | SnapshotSpec | AttributeSpec,
    source: DataFrame,
    table: HistoryTable,
    run_ts: str | None = None,
    mode: str = REFERENCE,
    full_refresh: bool = False,
    carry_all: bool = True,
    children: str = IN_ROW,
    task_rows: int | None = None,
    watermark: str | None = None,
    checks: Checks | None = None,
) -> DataFrame | None:
    """Fold new raw rows into ``table``, creating it on the first run.

    The first run, a full refresh, and a table without any load time take the
    whole source; else rows loaded since the table's newest load time are taken,
    or since ``watermark``. The changed rows are staged before the table is touched.
    ``carry_all`` and ``children`` are those of ``json_history``, ``task_rows``
    is the share of a key that one task may hold; an attribute table is cut into
    periods of ``lastUpdated`` unless ``table`` names another column.

    With ``mode="consistent"`` the table holds all versions, and ``read_history``
    gives the changes among them: in whatever steps and order rows arrive, the
    result equals a full rebuild from all of them.

    With ``checks`` the rows that the load writes are checked as they pass by (all
    rows of the table, or the batch's), and the check rows are returned.
    """
    if full_refresh or not table.exists():
        watermark = None
    elif watermark is None:
        watermark = table.watermark(day=not isinstance(spec, AttributeSpec))
    if isinstance(spec, AttributeSpec):
        return _load_attributes(spec, source, table, run_ts, watermark, checks)
    options = {"task_rows": task_rows}
    if isinstance(spec, SnapshotSpec):
        options |= {"carry_all": carry_all, "children": children, "run_ts": run_ts}
    history = cdc_history if isinstance(spec, CdcSpec) else json_history
    if watermark is None:
        return _replaced(table, history(spec, source, mode=mode, **options), checks)
    if mode == CONSISTENT:
        batch = watermark_filter(source, spec.loaded, watermark, spec.loaded_day)
        return load_rows(spec, batch, table, run_ts, task_rows, checks)
    stored = table.rows()
    if CHANGED in stored.columns:
        raise ValueError("the table holds all versions: load it in consistent mode")
    batch, checked = _staged(history(spec, source, stored, watermark=watermark, **options), checks)
    table.upsert(batch, spec.unique_key)
    return checked


def _replaced(table: HistoryTable, rows: DataFrame, checks: Checks | None) -> DataFrame | None:
    if checks is None:
        return table.replace(rows)
    seen, told = observed(rows, checks)
    table.replace(seen)
    return told(table.rows())


def _staged(rows: DataFrame, checks: Checks | None) -> tuple[DataFrame, DataFrame | None]:
    if checks is None:
        return stage(rows), None
    seen, told = observed(rows, checks)
    batch = stage(seen)
    return batch, told(batch)


def load_rows(
    spec: CdcSpec | SnapshotSpec,
    batch: DataFrame,
    table: HistoryTable,
    run_ts: str | None = None,
    task_rows: int | None = None,
    checks: Checks | None = None,
) -> DataFrame | None:
    """Fold ``batch`` into an existing table of all versions.

    Keys are rebuilt from their first version in the batch on, and only the
    difference to what is stored is written: new versions, copies that were loaded
    earlier than the stored ones, and versions that are a change now or no longer.
    No version ever goes. A batch that was loaded before changes nothing.
    """
    is_log = isinstance(spec, CdcSpec)
    loaded = LOADED if is_log else LANDED
    rows = stage(cdc_rows(spec, batch) if is_log else snapshot_rows(spec, batch))
    firsts = stage(first_versions(rows, spec.key))
    recent = table.rows(earliest(firsts))
    if CHANGED not in recent.columns:
        raise ValueError("the table does not hold all versions: refresh it in consistent mode")
    wide = rebuild_tails(table.rows(), recent, firsts, spec.key, loaded, rows, task_rows)
    written, checked = _staged(finish_cdc(spec, wide) if is_log else finish_snapshots(spec, wide, run_ts), checks)
    table.upsert(written, spec.unique_key)
    return checked


def _load_attributes(spec, source, table, run_ts, watermark, checks) -> DataFrame | None:
    """Attribute tables are rebuilt on a full refresh and appended to otherwise."""
    if table.time == TIME:  # attribute rows have no such column
        table = replace(table, time=HEADER_TIME)
    if watermark is None:
        return _replaced(table, attribute_pivot(spec, source, run_ts=run_ts), checks)
    rows = attribute_pivot(spec, source, table.rows(), run_ts, watermark)
    if checks is None:  # the batch and what the table holds of it are staged already
        return table.append(rows)
    batch, checked = _staged(rows, checks)
    table.append(batch)
    return checked
