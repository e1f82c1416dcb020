import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from histkit.operators import (
    anti_rows,
    anti_versions,
    change_history,
    compact_changes,
    dedupe_versions,
    key_filter,
    latest_per_key,
    may_match,
    pages_for,
    stretches,
    time_cuts,
    union_distinct,
)

T0 = dt.datetime(2024, 1, 1)


def at(minutes):
    return None if minutes is None else T0 + dt.timedelta(minutes=minutes)


def frame(spark, rows):
    """Rows of (key, minute, hash, load order)."""
    return spark.createDataFrame(
        [(k, at(m), h, n) for k, m, h, n in rows], "id string, ts timestamp_ntz, row_hash string, n int"
    )


def brute_history(rows):
    """Python's answer: first copy of each version, then rows that differ from the one before."""
    first = {}
    for k, m, h, n in sorted(rows, key=lambda r: (r[3], r[2])):
        first.setdefault((k, m), (k, m, h, n))
    out, keys = [], {k for k, _ in first}
    for key in keys:
        versions = sorted((v for v in first.values() if v[0] == key), key=lambda v: (v[1] is None, v[1] or 0))
        previous = None
        for v in versions:
            if previous is None or previous[2] != v[2]:
                out.append(v)
            previous = v
    return sorted(out, key=repr)


def got(df):
    return sorted(
        ((r.id, None if r.ts is None else int((r.ts - T0).total_seconds() // 60), r.row_hash, r.n) for r in df.collect()),
        key=repr,
    )


def test_dedupe_keeps_the_first_copy_and_breaks_ties(spark):
    rows = [("a", 1, "y", 2), ("a", 1, "x", 2), ("a", 1, "z", 3), ("a", 2, "q", 1), (None, None, "u", 1), (None, None, "v", 2)]
    assert got(dedupe_versions(frame(spark, rows), "id", "ts", ["n", "row_hash"])) == sorted(
        [("a", 1, "x", 2), ("a", 2, "q", 1), (None, None, "u", 1)], key=repr
    )


def test_latest_and_earliest(spark):
    df = frame(spark, [("a", 1, "x", 1), ("a", 5, "y", 1), ("b", 2, "z", 1), ("b", None, "w", 1), (None, 3, "q", 1)])
    assert got(latest_per_key(df, "id", "ts")) == sorted(
        [("a", 5, "y", 1), ("b", None, "w", 1), (None, 3, "q", 1)], key=repr
    )
    assert got(latest_per_key(df, "id", "ts", ascending=True)) == sorted(
        [("a", 1, "x", 1), ("b", 2, "z", 1), (None, 3, "q", 1)], key=repr
    )


def test_a_return_to_an_old_state_is_kept(spark):
    df = frame(spark, [("a", 1, "A", 1), ("a", 2, "A", 1), ("a", 3, "B", 1), ("a", 4, "A", 1)])
    assert [r[1:3] for r in got(compact_changes(df, "id", "ts"))] == [(1, "A"), (3, "B"), (4, "A")]


def random_rows(seed, n, keys, minutes):
    rng = random.Random(seed)
    return [
        (rng.choice(keys), rng.choice([None, *range(minutes)]), rng.choice("AB"), rng.randrange(50)) for _ in range(n)
    ]


@pytest.mark.parametrize("seed", range(3))
def test_history_equals_brute_force(spark, seed):
    rows = random_rows(seed, 300, ["a", "b", "c", None], 60)
    df = frame(spark, rows)
    assert got(change_history(df, "id", "ts", ["n", "row_hash"])) == brute_history(rows)


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("task_rows", [7, 100])
def test_keys_in_stretches_give_the_same_history(spark, seed, task_rows):
    rows = random_rows(seed, 600, ["hot"] * 5 + [None] * 5 + list("abc"), 200)
    df = frame(spark, rows)
    cut = {r["_cut_key"] for r in time_cuts(df, "id", "ts", task_rows).heads.collect()}
    assert {"hot", None} <= cut
    assert got(change_history(df, "id", "ts", ["n", "row_hash"], task_rows=task_rows)) == brute_history(rows)


def test_all_versions_with_their_marks(spark):
    rows = random_rows(9, 300, ["hot", "hot", None, "a"], 80)
    plain = {r[:3]: r for r in brute_history(rows)}
    for task_rows in (20, 10_000):
        marked = change_history(frame(spark, rows), "id", "ts", ["n", "row_hash"], task_rows=task_rows, flag="new")
        assert got(marked.where("new").drop("new")) == brute_history(rows)
        # one row of each (key, time), and no border is left
        assert marked.count() == len({r[:2] for r in rows}) == marked.dropDuplicates(["id", "ts"]).count()
    assert plain


def test_rows_of_one_time_without_order_follow_their_hash(spark):
    rows = [("hot", m // 3, "ABCA"[(m * 7) % 4], m) for m in range(300)]
    plain = got(change_history(frame(spark, rows), "id", "ts"))
    assert got(change_history(frame(spark, rows), "id", "ts", task_rows=10)) == plain


def test_copies_of_one_version_can_be_most_of_a_table(spark):
    rows = [("hot", 5, "A", n) for n in range(400)] + [("hot", m, "AB"[m % 2], 500) for m in range(40)] + [("b", 1, "A", 1)]
    df = frame(spark, rows)
    assert got(change_history(df, "id", "ts", ["n", "row_hash"], task_rows=20)) == brute_history(rows)


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp", "date"])
def test_stretches_follow_time_and_split_the_key(spark, kind):
    minutes = [*range(400), None]
    df = frame(spark, [("hot", m and 1440 * m, "A", 1) for m in minutes] + [("light", 1, "A", 1)])
    df = df.withColumn("ts", F.col("ts").cast(kind))
    cuts = time_cuts(df, "id", "ts", 40)
    rows = stretches(df, "id", "ts", cuts).where("id = 'hot'").orderBy(F.col("ts").asc_nulls_last()).collect()
    numbers = [r["_stretch"] for r in rows if not r["_border"]]
    assert numbers == sorted(numbers) and len(numbers) == len(minutes)
    sizes = [numbers.count(n) for n in set(numbers)]
    assert len(sizes) >= 8 and max(sizes) <= 80
    # each stretch but the first has one border row, which is the last version of the one before
    last = {r["_stretch"]: r["ts"] for r in rows if not r["_border"]}
    border = {r["_stretch"]: r["ts"] for r in rows if r["_border"]}
    assert all(border[n] == last[n - 1] for n in set(numbers) - {0})


def test_a_frame_within_the_limit_is_not_cut(spark):
    df = frame(spark, [("a", m, "A", 1) for m in range(100)])
    assert time_cuts(df, "id", "ts", 100) is None
    assert time_cuts(df, "id", "ts", 99) is not None
    assert time_cuts(df.limit(0), "id", "ts", 1) is None


def test_anti_joins_and_null_keys(spark):
    last = frame(spark, [("a", 1, "x", 1), ("b", 1, "x", 1), (None, 1, "x", 1), ("c", None, "x", 1)])
    batch = frame(spark, [("a", 1, "y", 2), ("b", 2, "y", 2), (None, 1, "y", 2), ("c", None, "y", 2)])
    assert {r[0] for r in got(anti_versions(last, batch, "id", "ts"))} == {"b", None, "c"}
    assert {r[0] for r in got(anti_rows(last, batch.select("id"), ["id"]))} == {None}


def test_union_distinct(spark):
    a = frame(spark, [("a", 1, "x", 1), ("a", 1, "x", 1)])
    assert got(union_distinct(a, a)) == [("a", 1, "x", 1)]


@pytest.mark.parametrize("kind", ["bigint", "string"])
def test_the_key_filter_keeps_all_that_match_and_little_else(spark, kind):
    df = spark.range(50_000).select(F.when(F.col("id") % 100 != 7, F.col("id")).cast(kind).alias("k"))
    batch = df.where("CAST(k AS bigint) % 10 = 3").unionByName(df.where("k IS NULL").limit(5))
    pages = pages_for(batch.count())
    near = may_match(df, "k", key_filter(batch, "k", pages), pages)
    keys = {r["k"] for r in near.collect()}
    assert {r["k"] for r in batch.where("k IS NOT NULL").collect()} <= keys and None not in keys
    assert len(keys) < 0.25 * 50_000
    assert may_match(df, "k", key_filter(batch.limit(0), "k", 1), 1).count() == 0
    assert pages_for(1) == 1 and pages_for(10**8) is None and pages_for(6 * 10**7) * 4096 <= 64 << 20
