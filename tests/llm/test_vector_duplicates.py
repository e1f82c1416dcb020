import numpy as np
import pytest

from histkit.llm import vector_duplicates as module
from histkit.llm.queries import SQL, op13_vector_duplicates
from histkit.llm.vector_duplicates import Quantiser, allowed_bits, buckets, unit_rows, vector_links
from tests.llm.test_near_duplicates import roots
from tests.oracle import difference, duck

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def frame(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    return spark.createDataFrame([(i, None if v is None else [float(x) for x in v], 0) for i, v in zip(ids, vectors)], SCHEMA)


def links(vectors, similar=0.95):
    u = unit_rows(np.asarray(vectors, np.float32).astype(np.float64))
    hit = u @ u.T >= similar
    np.fill_diagonal(hit, False)
    return hit


def brute(vectors, similar=0.95):
    """vec_id -> (links, component) by all pairs."""
    hit = links(vectors, similar)
    component = roots(len(vectors), list(zip(*np.nonzero(hit))))
    return {i: (int(hit[i].sum()), component[i]) for i in range(len(vectors))}


def found(df):
    return {r["vec_id"]: (r["n_links"], r["component_id"]) for r in df.collect()}


def around(rng, centre, n, angle):
    """``n`` vectors about ``angle`` degrees from ``centre``."""
    noise = rng.normal(size=(n, len(centre)))
    noise -= np.outer(noise @ centre, centre) / (centre @ centre)
    noise /= np.linalg.norm(noise, axis=1, keepdims=True)
    return centre / np.linalg.norm(centre) + np.tan(np.radians(angle)) * noise


def test_query_equals_sql(spark):
    for sf in ("0.001", "0.01"):
        path = f"/root/testdata/sf{sf}"
        assert difference(op13_vector_duplicates(spark, path), duck(path), SQL["op13_vector_duplicates"]) is None


@pytest.mark.parametrize("width", [16, 64, 100])
def test_groups_of_near_copies_equal_all_pairs(spark, width):
    """Copies of 7 degrees spread: units, singles and what lies between."""
    rng = np.random.default_rng(width)
    parts = [rng.normal(size=(600, width))]
    parts += [around(rng, rng.normal(size=width), n, 7) for n in (2, 3, 30, 200)]
    vectors = np.concatenate(parts).astype(np.float32)
    order = rng.permutation(len(vectors))
    vectors = vectors[order]
    got = found(vector_links(frame(spark, vectors)))
    assert got == brute(vectors)


def test_groups_whose_pairs_link_only_in_part(spark, monkeypatch):
    """Copies of 13 degrees spread lie at both sides of the limit, so that blocks of members are compared."""
    monkeypatch.setattr(module, "MEMBERS", 7)
    monkeypatch.setattr(module, "UNITS", 9)
    rng = np.random.default_rng(2)
    centre = rng.normal(size=48)
    tight = [around(rng, c, 25, 6) for c in around(rng, centre, 6, 6)]
    vectors = np.concatenate([rng.normal(size=(100, 48)), around(rng, rng.normal(size=48), 60, 13), *tight]).astype(np.float32)
    expected, hit = brute(vectors), links(vectors)
    got = found(vector_links(frame(spark, vectors)))
    missed = sum(expected[i][0] - got[i][0] for i in expected)
    assert all(got[i][0] <= expected[i][0] for i in expected)
    assert missed <= 0.03 * hit.sum() and hit.sum() > 10_000
    assert {i: c for i, (_, c) in got.items()} == {i: c for i, (_, c) in expected.items()}


def test_recall_of_pairs_just_above_the_limit(spark):
    """Single pairs at a cosine of 0.95 to 0.97, the hardest ones."""
    rng = np.random.default_rng(4)
    first = rng.normal(size=(500, 64))
    second = np.concatenate([around(rng, v, 1, np.degrees(np.arccos(rng.uniform(0.9501, 0.97)))) for v in first])
    vectors = np.concatenate([first, second, rng.normal(size=(2000, 64))]).astype(np.float32)
    expected, got = brute(vectors), found(vector_links(frame(spark, vectors)))
    assert all(got[i][0] <= expected[i][0] for i in expected)
    total = sum(n for n, _ in expected.values())
    recall = sum(n for n, _ in got.values()) / total
    assert total >= 1000 and recall >= 0.97


def test_copies_count_as_rows(spark):
    rng = np.random.default_rng(5)
    one = rng.normal(size=8)
    vectors = np.concatenate([np.tile(one, (50, 1)), 3 * one[None], rng.normal(size=(20, 8)), -one[None]]).astype(np.float32)
    got = found(vector_links(frame(spark, vectors).repartition(4)))
    assert got == brute(vectors)
    assert got[0] == (50, 0)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [[1, 0], None, [0, 0], [nan, 1], [inf, 1], [], [1, None], [1], [1, 0.01], [-0.0, 1], [0.0, 1], [1e-42, 0], [3e38, 1e30], [2]]
    ids = [4, 1, 2, 3, 5, 6, 7, 8, None, 9, 10, 11, 12, 4]
    rows = [(i, v if v is None else [None if x is None else float(x) for x in v], 0) for i, v in zip(ids, vectors)]
    clashing = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS node", "2 AS unit", "'x' AS vector", "3 AS n1", "4 AS kept")
    got = sorted((tuple(r) for r in vector_links(clashing).collect()), key=repr)
    # 4, 8, NULL, 11, 12 and the second 4 point one way, 9 and 10 another
    expected = [(i, 5, 4, i == 4) for i in (4, 4, 8, None, 11, 12)] + [(9, 1, 9, True), (10, 1, 9, False)]
    expected += [(i, 0, i, True) for i in (1, 2, 3, 5, 6, 7)]
    assert got == sorted(expected, key=repr)
    lone = [tuple(r) for r in vector_links(spark.createDataFrame([(None, [1.0, 2.0], 0)], SCHEMA)).collect()]
    assert lone == [(None, 0, None, True)]
    assert vector_links(spark.createDataFrame([], SCHEMA)).collect() == []


def test_codes_are_balanced_and_near_for_near_vectors():
    rng = np.random.default_rng(6)
    sample = rng.normal(size=(3000, 64)) + 0.5
    model = Quantiser(sample)
    codes = model.codes(unit_rows(sample))
    ones = np.bitwise_count(codes.view(np.uint64)).mean(axis=0) / 64
    assert codes.shape == (3000, 3) and (np.abs(ones - 0.5) < 0.05).all()
    close = np.concatenate([around(rng, v, 1, 18) for v in sample[:500]])
    other = model.codes(unit_rows(close))
    far = np.bitwise_count((codes[:500, 0] ^ other[:, 0]).view(np.uint64))
    assert (far <= allowed_bits(0.95)).mean() > 0.99
    assert (buckets(codes[:500]) == buckets(other)).any(axis=1).mean() > 0.97
    assert buckets(codes).min() >= 0 and buckets(codes).max() < 15 << 12
