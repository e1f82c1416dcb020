import random
import zlib

from histkit.llm import sharding
from histkit.llm.queries import op10_sharding
from histkit.llm.sharding import difference, shard_by_bytes
from tests.llm.small import SF, empty, frame, odd, rows


def plain_difference(sizes, m):
    """Karmarkar-Karp on lists of sets, by sorting at each step."""
    todo = [([0] * (m - 1) + [s], [[] for _ in range(m - 1)] + [[i]]) for i, s in enumerate(sizes)]
    while len(todo) > 1:
        todo.sort(key=lambda v: max(v[0]) - min(v[0]), reverse=True)
        (a, ai), (b, bi), *todo = todo
        both = sorted(zip([x + y for x, y in zip(a, b[::-1])], [x + y for x, y in zip(ai, bi[::-1])]), key=lambda v: v[0])
        todo.append(([s for s, _ in both], [i for _, i in both]))
    return todo[0]


def test_difference_is_karmarkar_karp():
    rng = random.Random(3)
    for m in (2, 3, 8):
        for n in (1, 2, 7, 60):
            sizes = rng.sample(range(1, 10**6), n)
            sums, places = difference([[0] * (m - 1) + [s] for s in sizes])
            assert sums == plain_difference(sizes, m)[0]
            got = [0] * m
            for s, p in zip(sizes, places):
                got[p[-1]] += s
            assert got == sums
    assert difference([[0, 8], [0, 7], [0, 6], [0, 5], [0, 4]])[0] == [14, 16]
    assert difference([]) == ([], [])


def check(out, texts):
    """Whole, gapless, groups undivided."""
    assert sorted(map(str, (r["doc_id"] for r in out))) == sorted(str(i) for i, _ in texts)
    slots, of_text = {}, {}
    by = {}
    for i, t in texts:
        by.setdefault((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())), []).append(t)
    for r in out:
        assert (r["doc_id"], r["size"], r["text_crc32"]) in by
        slots.setdefault(r["shard"], []).append(r["slot"])
        of_text.setdefault((r["size"], r["text_crc32"]), set()).add(r["shard"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in of_text.values())
    assert set(slots) <= set(range(8))


def test_query(spark):
    out = op10_sharding(spark, SF).collect()
    check(out, [(r["doc_id"], r["text"]) for r in rows()])
    assert {r["law"] for r in out} == {"bytes"} and {r["grown_shard"] for r in out} == {None}
    sums = [sum(r["size"] for r in out if r["shard"] == s) for s in range(8)]
    assert max(sums) - min(sums) < 0.01 * max(sums)


def test_many_levels(spark, monkeypatch):
    """Buckets of 4 groups, merged 3 at a time, stay near the best balance."""
    monkeypatch.setattr(sharding, "FAN_IN", 3)
    rng = random.Random(1)
    texts = [(i, "x" * rng.randint(100, 1000) + str(i % 190)) for i in range(200)]
    out = shard_by_bytes(frame(spark, texts), groups_per_task=4).collect()
    check(out, texts)
    sums = [sum(r["size"] for r in out if r["shard"] == s) for s in range(8)]
    assert max(sums) - min(sums) < 0.1 * max(sums)


def test_hot_group(spark):
    texts = [(i, "hot" if i % 3 else f"text {i}") for i in range(300)]
    check(shard_by_bytes(frame(spark, texts)).collect(), texts)


def test_odd_rows(spark):
    docs = odd(spark)
    check(shard_by_bytes(docs).collect(), [(r["doc_id"], r["text"]) for r in docs.collect()])
    assert shard_by_bytes(empty(spark)).collect() == []
