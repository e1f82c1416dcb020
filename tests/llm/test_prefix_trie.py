import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from histkit.llm import prefix_trie as module
from histkit.llm.prefix_trie import prefix_nodes, two_fattest
from histkit.llm.queries import SQL, op12_prefix_trie
from tests.oracle import difference, duck

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def brute(rows, group=5, shares=9):
    """Every prefix in a dictionary; rows must not share a conversation and turn."""
    own = {}
    for c, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[1] is not None, r[1] or 0)):
        own.setdefault(c, []).append((role or "", text or ""))
    members, ends = {}, {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % shares
        first = c - (abs(c) % group if c >= 0 else -(abs(c) % group))
        whole = tuple(own.get(first, [])[:h] + turns[h:])
        for d in range(len(whole) + 1):
            members.setdefault(whole[:d], []).append(c)
        ends.setdefault(whole, []).append(c)
    children = {}
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[q] for q in children.get(p, [])) or 1
        saved[p] = (len(members[p]) - 1) * (len(p[-1][1].encode()) if p else 0) + sum(saved[q] for q in children.get(p, []))
    return sorted(
        (
            min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children.get(p, [])), leaves[p], saved[p],
            hashlib.sha256(",".join(map(str, sorted(ends.get(p, [])))).encode()).hexdigest(),
        )
        for p, m in members.items()
    )


def found(df):
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(tuple(r) for r in df.select(*names).collect())


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_query_equals_sql(spark, sf):
    path = f"/root/testdata/sf{sf}"
    assert difference(op12_prefix_trie(spark, path), duck(path), SQL["op12_prefix_trie"]) is None


def some(rng, n, words, most, low=0):
    """Conversations of few different turns, so that they share long prefixes."""
    rows = []
    for c in range(low, low + n):
        rows += [(c, t, rng.choice(["user", "assistant"][t % 2 :]), rng.choice(words)) for t in range(rng.randrange(1, most))]
    return rows


@pytest.mark.parametrize("seed", range(4))
def test_equals_every_prefix(spark, seed):
    rng = random.Random(seed)
    rows = some(rng, 120, ["a", "bé", "", "a longer text"][: 1 + seed], [4, 10, 25, 12][seed], low=-20)
    assert found(prefix_nodes(frame(spark, rows))) == brute(rows)


def test_batches_of_every_order(spark, monkeypatch):
    """Ends in the middle of edges, cuts of cut edges, and searches of many rounds."""
    rng = random.Random(9)
    rows = some(rng, 60, ["x", "y"], 40) + [(c, t, "u", "x") for c in range(100, 130) for t in range(c - 99)]
    expected = brute(rows)
    for batches in (((0, 16),), tuple((i, i + 1) for i in range(16))):
        monkeypatch.setattr(module, "BATCHES", batches)
        assert found(prefix_nodes(frame(spark, rows))) == expected


def test_a_group_of_copies_and_short_texts(spark, monkeypatch):
    monkeypatch.setattr(module, "TEXT", 20)
    rows = [(c, t, "user", f"turn {t}") for c in range(0, 400) for t in range(3)]
    rows += [(c, 0, "user", "turn 0") for c in range(400, 420)]
    got = found(prefix_nodes(frame(spark, rows).repartition(6)))
    assert got == brute(rows)


def test_odd_rows(spark):
    rows = [
        (1, None, "user", "first"), (1, 0, None, "second"), (1, 1, "user", None), (2, 5, "", ""), (None, 1, "user", "x"),
        (5, None, None, None), (7, 1, "a", "long " * 100_000), (7, 2, "a", "é" * 9), (-3, 1, "user", "minus"), (0, 1, "user", "x"),
        (10**18, 1, "user", "x"),
    ]
    clashing = frame(spark, rows).selectExpr("*", "1 AS d", "2 AS a", "'x' AS rep", "3 AS place", "4 AS bytes")
    assert found(prefix_nodes(clashing)) == brute(rows)
    assert found(prefix_nodes(frame(spark, []))) == []
    assert found(prefix_nodes(frame(spark, [(None, 1, "user", "x")]))) == []


def test_repeated_rows_and_tied_turns(spark):
    """Equal rows are turns of their own; rows tied in their turn have one order, whatever order they come in."""
    rows = [(0, 1, "user", "x")] * 3 + [(5, 1, "user", "p"), (5, 1, "user", "q"), (5, 1, "robot", "p")]
    got = found(prefix_nodes(frame(spark, rows).repartition(3)))
    hashed = frame(spark, rows).withColumn("h", F.xxhash64(F.lit(1), "role", "text")).orderBy("conv_id", "h").collect()
    assert got == brute([(r["conv_id"], i, r["role"], r["text"]) for i, r in enumerate(hashed)])


def test_only_turnless_conversations(spark):
    # the first of their group is missing, and all their turns are replaced
    few = [c for c in range(1, 200) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 0][:4]
    rows = [(c, 0, "user", "gone") for c in few]
    assert found(prefix_nodes(frame(spark, rows))) == brute(rows)
    assert len(brute(rows)) == 1


def test_two_fattest(spark):
    def plain(low, high):
        return max(range(low + 1, high + 1), key=lambda n: n & -n)

    pairs = [(low, high) for high in range(1, 70) for low in range(high)]
    df = spark.createDataFrame(pairs, "low int, high int").withColumn("f", two_fattest(F.col("low"), F.col("high")))
    assert all(r["f"] == plain(r["low"], r["high"]) for r in df.collect())
