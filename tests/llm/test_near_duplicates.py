import random

import numpy as np
import pytest

from histkit.llm import near_duplicates
from histkit.llm.components import components
from histkit.llm.near_duplicates import COORDINATES, drop_near_duplicates, near_duplicate_classes, shingles_of, signatures
from histkit.llm.queries import op9_near_duplicates
from tests.llm.small import SF, empty, frame, odd, rows


def shingles(text):
    own = (text or "").encode().split()
    return {tuple(own[i : i + 5]) for i in range(max(1, len(own) - 4))} if own else set()


def roots(n, pairs):
    up = list(range(n))

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def brute(texts):
    """The class of each text: components of all pairs at 0.8 or more."""
    sets = [shingles(t) for t in texts]
    pairs = [
        (a, b)
        for a in range(len(sets))
        for b in range(a)
        if sets[a] == sets[b] or len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])
    ]
    return roots(len(sets), pairs)


def same_classes(found, texts, expected):
    """found: doc_id (the place in texts) -> class_id."""
    assert [found[i] for i in range(len(texts))] == expected


def edited(rng, text, edits):
    own = text.split()
    for _ in range(edits):
        own[rng.randrange(len(own))] = f"edit{rng.random()}"
    return " ".join(own)


def test_signatures_estimate_weighted_similarity():
    """Pairs with fractional weights: agreement is weighted Jaccard, for few and many elements."""
    rng = np.random.default_rng(4)
    for n in (1, 3, 40, 3000):
        agree, true = [], []
        for _ in range(40 if n < 1000 else 8):
            element = rng.integers(0, 2**63, n).astype(np.uint64)
            a, b = 1 + np.log(rng.integers(1, 6, n)), 1 + np.log(rng.integers(1, 6, n))
            a[rng.random(n) < 0.2], b[rng.random(n) < 0.2] = 0, 0
            if not a.any() or not b.any():
                continue
            sig = [signatures(element[w > 0], np.zeros((w > 0).sum(), int), w[w > 0], 1)[0] for w in (a, b)]
            agree.append((sig[0] == sig[1]).mean())
            true.append(np.minimum(a, b).sum() / np.maximum(a, b).sum())
        error = np.abs(np.array(agree) - true)
        assert abs(np.mean(agree) - np.mean(true)) < 0.03 and error.max() < 4.5 * 0.5 / COORDINATES**0.5


def test_signatures_do_not_depend_on_the_batch():
    rng = np.random.default_rng(0)
    sizes = [0, 1, 700, 0, 5, 60, 3]
    doc = np.repeat(np.arange(len(sizes)), sizes)
    element = rng.integers(0, 2**63, len(doc)).astype(np.uint64)
    weight = 1 + np.log(rng.integers(1, 4, len(doc)))
    all_ = signatures(element, doc, weight, len(sizes))
    for d in range(len(sizes)):
        mine = doc == d
        alone = signatures(element[mine], np.zeros(mine.sum(), int), weight[mine], 1)[0]
        assert (alone == all_[d]).all() and bool(alone.all()) == bool(sizes[d])


def test_shingles():
    hashes = np.arange(1, 20, dtype=np.uint64)
    ends = np.array([0, 2, 9, 9, 14, 19])  # 0, 2, 7, 0, 5 and 5 words
    element, doc = shingles_of(hashes, ends)
    assert np.bincount(doc, minlength=6).tolist() == [0, 1, 3, 0, 1, 1]
    again, _ = shingles_of(hashes[2:9], np.array([7]))
    assert set(again) == set(element[doc == 2])


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, 100 + i) for i in range(1, 50)]
    some = [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(60)]
    pairs = chain + star + some + [(7, 7)]
    pairs = [p if rng.random() < 0.5 else p[::-1] for p in pairs]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    want = roots(300, pairs)
    linked = {x for p in pairs if p[0] != p[1] for x in p}
    assert got == {x: want[x] for x in linked}


def test_query(spark):
    texts = [r["text"] for r in rows()]
    assert [r["doc_id"] for r in rows()] == list(range(len(texts)))
    out = op9_near_duplicates(spark, SF).collect()
    assert len(out) == len(texts)
    expected = brute(texts)
    assert {r["doc_id"]: r["class_id"] for r in out} == dict(enumerate(expected))
    assert {r["doc_id"] for r in out if r["first"]} == set(expected)
    assert len(set(expected)) < len(texts)


def families(rng):
    """Groups of copies at every distance, so that many pairs lie on both sides of the threshold."""
    texts = []
    for f in range(12):
        base = " ".join(f"w{rng.randrange(3000)}" for _ in range(rng.choice([6, 30, 150, 400])))
        texts += [edited(rng, base, rng.choice([0, 1, 2, 4, 8])) for _ in range(12)]
        texts += [base + " and an end"] * 2
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("block", [3, 256])
def test_no_link_is_lost(spark, monkeypatch, block):
    """Chains and dense groups around the threshold give the components of all pairs."""
    monkeypatch.setattr(near_duplicates, "BLOCK", block)
    monkeypatch.setattr(near_duplicates, "COLUMNS", 10 * block)
    monkeypatch.setattr(near_duplicates, "TASK_ROWS", 20 * block)
    texts = families(random.Random(7))
    out = near_duplicate_classes(frame(spark, list(enumerate(texts)))).collect()
    assert {r["doc_id"]: r["class_id"] for r in out} == dict(enumerate(brute(texts)))


def test_no_link_is_lost_where_passages_repeat(spark):
    """Texts against themselves written twice, three times and more often, and with a line said over and over."""
    rng = random.Random(8)
    texts = []
    for f in range(40):
        own = [f"w{f}x{i}" for i in range(100)]
        texts.append(" ".join(own))
        texts.append(" ".join(own * (2 + f % 4)))
        line = own[40:60] * (1 + 5 * (f % 5))
        texts.append(" ".join(own[:40] + line + own[60:]) + f" end{rng.random()}")
    rng.shuffle(texts)
    out = near_duplicate_classes(frame(spark, list(enumerate(texts)))).collect()
    assert {r["doc_id"]: r["class_id"] for r in out} == dict(enumerate(brute(texts)))
    assert len({r["class_id"] for r in out}) == 40


def test_second_round_finds_what_the_pivot_hides(spark):
    """b is like c but not like the pivot a, though all three share buckets."""
    rng = random.Random(3)
    a = [f"w{i}" for i in range(400)]
    b = a[:]
    for i in range(30):  # about 0.7 to a
        b[rng.randrange(400)] = f"x{i}"
    c = b[:]
    c[200] = "y"
    texts = [" ".join(t) for t in (a, b, c)]
    out = near_duplicate_classes(frame(spark, list(enumerate(texts)))).collect()
    assert {r["doc_id"]: r["class_id"] for r in out} == dict(enumerate(brute(texts)))


def test_drop(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    expected = set(brute([r["text"] for r in rows()]))
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(expected)


def test_odd_rows(spark):
    docs = odd(spark)
    out = near_duplicate_classes(docs).collect()
    assert len(out) == docs.count()
    text = {(str(r["doc_id"]), " ".join((r["text"] or "").split())) for r in docs.collect()}
    kept = drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    got = kept.collect()
    # classes: the two equal rows, four without words, and five texts of their own
    assert len(got) == 7
    assert sorted(str(r["doc_id"]) for r in got) == sorted(["5", "5", "None", "7", "10", "11", "-3"])
    assert {(str(r["doc_id"]), " ".join((r["text"] or "").split())) for r in got} <= text
    nulls = frame(spark, [(None, "a b"), (None, "a b"), (None, None)])
    assert sorted(str(r["text"]) for r in drop_near_duplicates(nulls).collect()) == ["None", "a b"]
    assert near_duplicate_classes(empty(spark)).collect() == []
    assert drop_near_duplicates(empty(spark)).collect() == []
