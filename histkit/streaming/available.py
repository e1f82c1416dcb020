"""Load what has landed since the last run, as a stream that stops when done."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..plans.history import CONSISTENT
from ..plans.load import load, load_rows
from ..plans.specs import CdcSpec, SnapshotSpec
from ..sources.tables import HistoryTable


def load_available(
    spec: CdcSpec | SnapshotSpec, landed: DataFrame, table: HistoryTable, checkpoint: str, run_ts: str | None = None
) -> StreamingQuery:
    """Fold the files of a streaming source that are new since the last call into ``table``.

    The source's own bookkeeping says which files are new, so nothing is read
    twice and no day is read again; batches are folded in as in the consistent
    mode of ``load``, so the table holds all versions (see ``read_history``). A
    micro-batch that is run again after a failure meets its own versions in the
    table and changes nothing.
    """

    def fold(batch: DataFrame, _: int) -> None:
        if table.exists():
            load_rows(spec, batch, table, run_ts)
        else:
            load(spec, batch, table, run_ts, mode=CONSISTENT)

    query = landed.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint)
    return query.trigger(availableNow=True).start()
