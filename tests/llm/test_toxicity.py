import zlib

import numpy as np
import pytest

from histkit.llm.queries import op6_toxicity
from histkit.llm.toxicity import FEATURES, Boosted, Features, fit, isotonic, score
from tests.llm.small import empty, frame, odd

SF = "/root/testdata/sf0.01"


def test_features():
    make = Features({"moron": 5.0, "vequ*": 4.0})
    x = dict(zip(FEATURES, make.of("You utter Moron!! Vequta m0ron sooo GOOD?")))
    assert x["hits"] == 2 / 7 and x["terms"] == 2 and x["best"] == 5 and x["stem_hits"] == 1 / 7
    assert x["second_person"] == 1 / 7 and x["near"] == 1 and x["capital_words"] == 1 / 7
    assert x["hidden"] == 1 / 7 and x["hidden_hits"] == 1 / 7 and x["drawn"] == 1 / 7
    assert x["exclaims"] == 2 / 7 and x["asks"] == 1 / 7 and x["repeats"] == 1 / 7
    far = dict(zip(FEATURES, make.of("moron " + "x " * 50 + "you")))
    assert far["near"] == 0
    assert not make.of("").any() and not make.of(" \n").any()
    make.kept = {}
    assert (make.of("a moron a") == Features(make.lexicon).of("a moron a")).all()


def test_trees_learn_a_rule():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 5))
    y = ((x[:, 0] > 0.6) & (x[:, 3] < 0.5)).astype(float)
    model = Boosted().fit(x[:3000], y[:3000])
    assert ((model.raw(x[3000:]) > 0) == y[3000:]).mean() > 0.98


def brute_isotonic(raw, y):
    """Min-max formula of the monotone least-squares fit."""
    places = np.unique(raw)
    mean = lambda a, b: y[(raw >= places[a]) & (raw <= places[b])].mean()
    n = len(places)
    return [max(min(mean(a, b) for b in range(i, n)) for a in range(i + 1)) for i in range(n)]


def test_isotonic():
    rng = np.random.default_rng(1)
    raw = rng.integers(0, 25, 200).astype(float)
    y = (rng.random(200) < raw / 25).astype(float)
    at, share = isotonic(raw, y)
    assert np.allclose(np.interp(np.unique(raw), at, share), brute_isotonic(raw, y))


def auc(scores, labels):
    order = np.argsort(np.argsort(scores))
    n = labels.sum()
    return (order[labels == 1].sum() - n * (n - 1) / 2) / (n * (len(labels) - n))


def test_query(spark):
    """Held-out accuracy, and exact flags."""
    got = op6_toxicity(spark, SF).toPandas()
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas()
    assert len(got) == 1000 and got.score.between(0, 1).all()
    assert (got.predicted == (got.score >= 0.7)).all()
    assert [zlib.crc32(str(i).encode()) % 3 == 1 for i in got.doc_id] == got.held_out.tolist()
    both = got.merge(labels, on="doc_id")
    unseen = both[both.held_out]
    assert auc(unseen.score.to_numpy(), unseen.toxic.to_numpy()) > 0.95
    assert unseen[unseen.toxic == 0].predicted.mean() < 0.03


def test_labels_alone_teach(spark):
    """Labels of held-out rows change nothing."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    usable = "NOT coalesce(crc32(cast(doc_id AS string)) % 3 = 1, false)"
    from pyspark.sql import functions as F

    turned = labels.withColumn("toxic", F.expr(f"CASE WHEN {usable} THEN toxic ELSE 1 - toxic END"))
    a = fit(docs, labels, F.expr(usable))
    b = fit(docs.repartition(5), turned, F.expr(usable))
    assert a.lexicon == b.lexicon
    x = np.random.default_rng(2).random((50, len(FEATURES)))
    assert np.allclose(a.scores(x), b.scores(x))


@pytest.mark.parametrize("toxic", [None, 0, 1])
def test_odd_rows(spark, toxic):
    docs = odd(spark)
    labels = spark.createDataFrame([(5, None, toxic), (7, 1, toxic), (7, 1, toxic), (None, 1, 1)], "doc_id bigint, quality int, toxic int")
    model = fit(docs, labels)
    got = score(docs, model)
    assert got.columns == ["row", "score"] and got.select("row.*").columns == docs.columns
    assert got.count() == docs.count() and all(0 <= r["score"] <= 1 for r in got.collect())
    assert score(empty(spark), fit(empty(spark), labels)).collect() == []


def test_repeated_rows_score_alike(spark):
    docs = frame(spark, [(1, "you moron"), (2, "you moron"), (None, "you moron")])
    labels = spark.createDataFrame([(1, 1)], "doc_id bigint, toxic int")
    assert len({r["score"] for r in score(docs, fit(docs, labels)).collect()}) == 1
