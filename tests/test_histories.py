import datetime as dt
import random
import sys

import pytest
from pyspark.sql import functions as F

from histkit.plans import CONSISTENT, CdcSpec, Column, cdc_history, history_of, load, read_history, replace_keys
from histkit.sources import HistoryTable, stage, upsert
from tests.test_tables import files

T0 = dt.datetime(2024, 1, 1)
# the package has the function by this name
load_module = sys.modules["histkit.plans.load"]
SPEC = CdcSpec(
    "items",
    ("s", "items"),
    "item_key",
    (Column("id", "bigint", "id"), Column("a", "string", "a"), Column("b", "string", "b")),
    time_type="timestamp_ntz",
)
SCHEMA = (
    "id bigint, a string, b string, _h2_sf_inserted timestamp_ntz, _h2_is_deleted boolean, _h2_binlog_ts_ms timestamp_ntz"
)


def raw(spark, rows):
    """Rows of (id, effective minute, a, b, load day[, deleted])."""
    return spark.createDataFrame(
        [
            (
                i,
                a,
                b,
                T0 + dt.timedelta(days=day, minutes=n),
                bool(rest and rest[0]),
                None if minute is None else T0 + dt.timedelta(minutes=minute),
            )
            # a row's place tells when within the day it landed; None leaves its place empty
            for n, row in enumerate(rows)
            if row is not None
            for i, minute, a, b, day, *rest in [row]
        ],
        SCHEMA,
    )


def short(df):
    return sorted(
        (
            (r["id"], None if r["timestamp_effective"] is None else int((r["timestamp_effective"] - T0).total_seconds() // 60), r["a"], r["b"])
            for r in df.collect()
        ),
        key=repr,
    )


def test_null_that_moves_is_a_change(spark):
    df = raw(spark, [(1, 1, None, "x", 0), (1, 2, "x", None, 0)])
    assert len(short(cdc_history(SPEC, df))) == 2


def test_delete_flag_alone_is_no_change_unless_tracked(spark):
    df = raw(spark, [(1, 1, "x", "y", 0, False), (1, 2, "x", "y", 0, True)])
    assert len(short(cdc_history(SPEC, df))) == 1
    assert len(short(cdc_history(SPEC.with_(track_deletes=True), df))) == 2


COUNTER_EXAMPLE = [(1, 10, "A", "", 1), (1, 20, "A", "", 2), (1, 30, "C", "", 2), (1, 40, "C", "", 3)]


def days(rows, *wanted):
    return [r if r[4] in wanted else None for r in rows]


def fold(spark, rows, steps, mode):
    """Load days in steps: each run sees all rows landed so far."""
    target = None
    for until in steps:
        seen = raw(spark, [r if r[4] <= until else None for r in rows])
        batch = stage(cdc_history(SPEC, seen, target, mode=mode))
        if target is None:
            target = batch
        elif mode == CONSISTENT:
            target = stage(replace_keys(target, batch, "id"))
        else:
            target = stage(upsert(target, batch, SPEC.unique_key))
    return history_of(target)


def test_reference_mode_emits_a_version_read_twice_as_a_change(spark):
    full = short(cdc_history(SPEC, raw(spark, COUNTER_EXAMPLE)))
    assert full == [(1, 10, "A", ""), (1, 30, "C", "")]
    # the last version of the target is in the batch, so the one before it has no predecessor there
    assert short(fold(spark, COUNTER_EXAMPLE, [2, 3], "reference")) == [(1, 10, "A", ""), (1, 20, "A", ""), (1, 30, "C", "")]
    assert short(fold(spark, COUNTER_EXAMPLE, [2, 3], CONSISTENT)) == full


@pytest.mark.parametrize("seed", range(2))
def test_consistent_folds_equal_a_full_rebuild_when_times_arrive_in_order(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.choice([1, 2, None]), 10 * n, rng.choice("AB"), "", n // 10) for n in range(40)]
    rows += [(i, m, a, b, day + 1) for i, m, a, b, day in rows]  # replays a day later
    full = short(cdc_history(SPEC, raw(spark, rows)))
    assert short(fold(spark, rows, [0, 2, 4], CONSISTENT)) == full


def test_stored_version_wins_over_a_late_copy_with_other_values(spark):
    rows = [(1, 10, "A", "", 0), (1, 20, "B", "", 0), (1, 20, "Z", "", 2)]
    assert short(fold(spark, rows, [0, 2], CONSISTENT)) == [(1, 10, "A", ""), (1, 20, "B", "")]


def test_empty_target_counts_as_first_run(spark):
    empty = cdc_history(SPEC, raw(spark, [])).limit(0)
    df = raw(spark, [(1, 10, "A", "", 0)])
    assert short(cdc_history(SPEC, df, empty)) == [(1, 10, "A", "")]


def test_null_keys_and_times_are_kept(spark):
    rows = [(None, 10, "A", "", 0), (None, 20, "A", "", 0), (None, None, "B", "", 0), (1, None, "A", "", 0)]
    assert short(cdc_history(SPEC, raw(spark, rows))) == sorted(
        [(None, 10, "A", ""), (None, None, "B", ""), (1, None, "A", "")], key=repr
    )


def scrambled(seed, n=48):
    """Few keys and times, so that late rows are copies that differ, or lie between stored versions."""
    rng = random.Random(seed)
    return [(rng.choice([1, 2, 3, None]), rng.choice([None, *range(30)]), rng.choice("AB"), "", i // 12) for i in range(n)]


@pytest.mark.parametrize("seed", range(3))
def test_consistent_steps_equal_a_full_rebuild_in_any_order(spark, tmp_path, seed):
    rows = scrambled(seed)
    full = short(cdc_history(SPEC, raw(spark, rows)))
    assert short(fold(spark, rows, [0, 1, 3], CONSISTENT)) == full
    table = HistoryTable(spark, f"{tmp_path}/t", grain="day")
    for until in (0, 1, 3):
        load(SPEC, raw(spark, days(rows, *range(until + 1))), table, mode=CONSISTENT)
    assert short(read_history(table)) == full


def test_consistent_loads_whose_earlier_rows_land_last(spark, tmp_path):
    """A copy loaded earlier than the stored one takes its place, whenever it is found."""
    rows = scrambled(7)
    table = HistoryTable(spark, f"{tmp_path}/t", grain="day")
    for wanted in ((2, 3), (1,), (0, 1, 2, 3)):
        load(SPEC, raw(spark, days(rows, *wanted)), table, mode=CONSISTENT, watermark="2024-01-01")
    assert short(read_history(table)) == short(cdc_history(SPEC, raw(spark, rows)))


def test_a_copy_of_a_version_that_compaction_left_out(spark, tmp_path):
    """The time of a version without a change stays taken."""
    rows = [(1, 10, "A", "", 0), (1, 20, "A", "", 0), (1, 20, "Z", "", 1)]
    assert short(fold(spark, rows, [0, 1], CONSISTENT)) == [(1, 10, "A", "")]
    table = HistoryTable(spark, f"{tmp_path}/t")
    load(SPEC, raw(spark, days(rows, 0)), table, mode=CONSISTENT)
    load(SPEC, raw(spark, rows), table, mode=CONSISTENT)
    assert short(read_history(table)) == [(1, 10, "A", "")] and table.rows().count() == 2


def test_modes_do_not_mix(spark, tmp_path):
    df = raw(spark, COUNTER_EXAMPLE)
    plain, versions = HistoryTable(spark, f"{tmp_path}/p"), HistoryTable(spark, f"{tmp_path}/v")
    load(SPEC, df, plain)
    load(SPEC, df, versions, mode=CONSISTENT)
    with pytest.raises(ValueError):
        load(SPEC, df, plain, mode=CONSISTENT)
    with pytest.raises(ValueError):
        load(SPEC, df, versions)
    with pytest.raises(ValueError):
        cdc_history(SPEC, df, plain.rows(), mode=CONSISTENT)
    with pytest.raises(ValueError):
        cdc_history(SPEC, df, versions.rows())
    load(SPEC, df, plain, mode=CONSISTENT, full_refresh=True)
    assert short(read_history(plain)) == short(read_history(versions))


def test_load_again_without_news_changes_nothing(spark, tmp_path):
    df = raw(spark, COUNTER_EXAMPLE)
    table = HistoryTable(spark, f"{tmp_path}/t")
    load(SPEC, df, table, mode=CONSISTENT)
    before = sorted(table.rows().collect())
    load(SPEC, df, table, mode=CONSISTENT)
    assert sorted(table.rows().collect()) == before


def test_a_consistent_load_stages_and_writes_only_what_differs(spark, tmp_path, monkeypatch):
    """Stored versions of the batch's keys are not staged again: equal copies stay, new marks and rows are written."""
    rows = [(1, 10, "A", "", 0), (1, 20, "A", "", 0), (1, 30, "A", "", 0), (2, 10, "A", "", 0), (2, 20, "B", "", 0)]
    late = [(1, 10, "A", "", 2), (1, 15, "B", "", 2), (1, 30, "Z", "", 2), (None, 10, "A", "", 2), (2, 10, "C", "", -1)]
    table = HistoryTable(spark, str(tmp_path))
    load(SPEC, raw(spark, rows), table, mode=CONSISTENT)
    seen = []
    monkeypatch.setattr(load_module, "stage", lambda df: seen.append(stage(df)) or seen[-1])
    load(SPEC, raw(spark, rows + late), table, mode=CONSISTENT, watermark="2023-12-01")
    written = seen[-1]
    # 1's version at 20 follows a new one and is a change now, the one at 30 is none as before; 2's first was loaded later
    assert len(seen) == 3 and short(written) == [(1, 15, "B", ""), (1, 20, "A", ""), (2, 10, "C", ""), (None, 10, "A", "")]
    assert short(read_history(table)) == short(cdc_history(SPEC, raw(spark, rows + late)))


def test_load_full_refresh_forgets_what_the_source_lost(spark, tmp_path):
    table = HistoryTable(spark, f"{tmp_path}/t")
    load(SPEC, raw(spark, [(1, 10, "A", "", 0), (2, 10, "A", "", 0)]), table)
    load(SPEC, raw(spark, [(1, 10, "A", "", 0)]), table, full_refresh=True)
    assert short(read_history(table)) == [(1, 10, "A", "")]


def test_watermark_reads_the_last_day_again_and_not_more(spark):
    target = cdc_history(SPEC, raw(spark, COUNTER_EXAMPLE[:3]))
    later = raw(spark, COUNTER_EXAMPLE + [(9, 5, "old", "", 0)])
    assert 9 not in [r[0] for r in short(cdc_history(SPEC, later, target))]


def test_casts_that_fail(spark):
    df = raw(spark, [(1, 10, "A", "", 0)]).withColumn("id", F.lit("x"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        cdc_history(SPEC, df).collect()
    assert cdc_history(SPEC.with_(on_error="null"), df).first()["id"] is None


def test_consistent_load_rewrites_only_the_periods_that_change(spark, tmp_path):
    table = HistoryTable(spark, f"{tmp_path}/t", grain="day")
    days_apart = 24 * 60
    rows = [(1, n * days_apart, "AB"[n % 2], "", n) for n in range(6)]
    load(SPEC, raw(spark, rows[:5]), table, mode=CONSISTENT)
    before = files(table)
    load(SPEC, raw(spark, rows), table, mode=CONSISTENT)
    after = files(table)
    assert len(before) == 5 and len(after) == 6
    assert all(after[p] == before[p] for p in before)
    # a late version between two stored ones makes the later of them redundant
    late = (1, 2 * days_apart + 10, "B", "", 6)
    load(SPEC, raw(spark, [*rows, late]), table, mode=CONSISTENT)
    assert short(read_history(table)) == short(cdc_history(SPEC, raw(spark, [*rows, late])))


def test_a_hot_key_loads_like_any_other(spark, tmp_path):
    rng = random.Random(5)
    rows = [(rng.choice([1, 1, 1, 2]), rng.randrange(300), rng.choice("AB"), "", n // 100) for n in range(300)]
    full = short(cdc_history(SPEC, raw(spark, rows)))
    assert short(cdc_history(SPEC, raw(spark, rows), task_rows=20)) == full
    target = stage(cdc_history(SPEC, raw(spark, days(rows, 0, 1))))
    plain = cdc_history(SPEC, raw(spark, rows), target)
    assert short(cdc_history(SPEC, raw(spark, rows), target, task_rows=20)) == short(plain)
