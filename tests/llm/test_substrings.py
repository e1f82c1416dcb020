import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from histkit.llm import substrings
from histkit.llm.queries import op7_substrings
from histkit.llm.substrings import WINDOW, Automaton, pack_windows, remove_repeats, unpack_windows
from tests.llm.small import SF, empty, frame, odd, rows


def brute(docs):
    """(doc_id, n_words, n_removed, kept) by the definition; NULL ids are last."""
    own = [(i, (t or "").encode().split()) for i, t in docs]
    first = {}
    order = lambda i: (i is None, i or 0)
    for i, w in own:
        for k in range(len(w) - WINDOW + 1):
            key = tuple(w[k : k + WINDOW])
            first[key] = min(first.get(key, order(i)), order(i))
    out = []
    for i, w in own:
        gone = set()
        for k in range(len(w) - WINDOW + 1):
            if first[tuple(w[k : k + WINDOW])] < order(i):
                gone.update(range(k, k + WINDOW))
        out.append((i, len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    return sorted(out, key=str)


def found(df):
    return sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in df.collect()), key=str)


@settings(deadline=None)
@given(
    st.lists(st.lists(st.integers(0, 3), max_size=30), max_size=6),
    st.lists(st.integers(0, 4), max_size=40),
    st.integers(1, 5),
)
def test_automaton_is_matching_statistics(references, text, least):
    automaton = Automaton()
    for key, r in enumerate(references):
        automaton.add(r, key)
    automaton.finish()
    has = lambda r, w: any(r[i : i + len(w)] == w for i in range(len(r) - len(w) + 1))
    want = [
        min((k for k, r in enumerate(references) if has(r, text[i : i + least])), default=substrings._LAST)
        for i in range(len(text) - least + 1)
    ]
    assert automaton.earliest(text, least).tolist() == want


def test_packed_windows():
    rng = np.random.default_rng(0)
    for n in (0, 1, 500):
        doc = np.sort(rng.integers(-5, 5, n))
        place = rng.integers(0, 2**20, n)
        order = np.lexsort((place, doc))
        doc, place = doc[order], place[order]
        hashes = rng.integers(0, 2**63, n).astype(np.uint64)
        got = unpack_windows(pack_windows(hashes, doc, place))
        assert [x.tolist() for x in got] == [hashes.tolist(), doc.tolist(), place.tolist()]


def test_query(spark):
    got = [(r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in op7_substrings(spark, SF).collect()]
    want = [(*r[:3], hashlib.sha256(r[3].encode()).hexdigest()) for r in brute([(r["doc_id"], r["text"]) for r in rows()])]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert sum(r[2] for r in want) > 0


def quilt(rng):
    """Documents sewn from shared passages of 5 to 60 words, some repeated within a document."""
    passages = [[f"p{i}w{k}" for k in range(rng.randint(5, 60))] for i in range(40)]
    docs = []
    for d in range(120):
        own = []
        for _ in range(rng.randint(0, 8)):
            p = rng.choice(passages[:4] if rng.random() < 0.3 else passages)
            a, b = sorted((rng.randint(0, len(p)), rng.randint(0, len(p))))
            own += p[a:b] if rng.random() < 0.6 else p
            own += [f"u{rng.random()}"] * rng.randint(0, 2)
        docs.append((d * 3, " ".join(own)))
    return docs + [(1000 + i, docs[5][1]) for i in range(30)]


@pytest.mark.parametrize("parts", [1, 5])
def test_passages(spark, monkeypatch, parts):
    """Any number of buckets, shards and tasks; owners split."""
    docs = quilt(random.Random(parts))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    if parts > 1:
        monkeypatch.setattr(substrings, "OWNER_WORDS", 100)
        monkeypatch.setattr(substrings, "SHARD_WORDS", 1000)
        monkeypatch.setattr(substrings, "SORTED", 50)
        monkeypatch.setattr(substrings, "BUCKET_BYTES", 5_000)
    try:
        table = frame(spark, docs).repartition(parts * 2)
        assert found(remove_repeats(table)) == brute(docs)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_colliding_hashes_remove_nothing(spark, monkeypatch):
    """With hashes of few bits nearly all windows are routed; matches decide."""
    plain = substrings.window_hashes

    def weak(hashes, ends):
        h, doc, place = plain(hashes, ends)
        return h % np.uint64(7), doc, place

    docs = quilt(random.Random(9))[:40]
    ids = np.array([i for i, _ in docs])
    flat = [np.array([hash(w) & (2**63 - 1) for w in t.split()], np.uint64) for _, t in docs]
    ends = np.cumsum([len(f) for f in flat])
    h, number, place = weak(np.concatenate(flat), ends)
    owner, shared = substrings.owners(h, ids[number])
    assert shared.mean() > 0.9
    import pyarrow as pa

    runs = substrings._runs(pa.table({"data": [substrings._pack_repeats(ids[number][shared], place[shared], owner[shared])]}))
    lists = pa.array([f.view(np.int64) for f in flat], pa.list_(pa.int64()))
    per_doc = {i: [] for i in ids.tolist()}
    for r in runs.to_pylist():
        per_doc[r["doc"]].append({**r, "shards": [0]})
    batch = pa.record_batch([pa.array(ids), pa.array(ids), lists, pa.array([per_doc[i] for i in ids.tolist()])], ["doc", "text_key", "h", "runs"])
    spans = substrings._match(pa.Table.from_batches(substrings._cut_runs([batch]))).to_pylist()
    for i, n, removed, _ in brute(docs):
        gone = {k for s in spans if s["doc"] == i for k in range(s["start"], s["stop"])}
        assert len(gone) <= removed  # an owner by a chance hash may hide a real one, never add one


def test_odd_rows(spark):
    docs = odd(spark)
    pairs = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert found(remove_repeats(docs)) == brute(pairs)
    passage = " ".join(f"w{i}" for i in range(20))
    pairs = [(None, passage), (None, passage + " x"), (4, passage), (4, "y " + passage), (2, "z " + passage)]
    assert found(remove_repeats(frame(spark, pairs))) == brute(pairs)
    assert remove_repeats(empty(spark)).collect() == []


def test_query_against_sql(spark):
    from histkit.llm.queries import SQL
    from tests.oracle import difference, duck

    assert difference(op7_substrings(spark, SF), duck(SF), SQL["op7_substrings"]) is None


def test_buckets_follow_the_text_and_not_the_session(spark, monkeypatch):
    """Small buckets change nothing, nor does the number of shuffle partitions."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plain = sorted(map(tuple, remove_repeats(docs, hashed=True).collect()))
    routed = []
    router = substrings._router
    monkeypatch.setattr(substrings, "_router", lambda parts: routed.append(parts) or router(parts))
    size = sum(len((r["text"] or "").encode()) for r in docs.collect())
    monkeypatch.setattr(substrings, "BUCKET_BYTES", 10_000)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for partitions in (2, 9):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            assert sorted(map(tuple, remove_repeats(docs, hashed=True).collect())) == plain
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert routed == [-(-size // 10_000)] * 2
