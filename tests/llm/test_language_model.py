import math
import zlib
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from histkit.llm import language_model as lm
from histkit.llm.queries import op5_language_model
from tests.llm.small import SF, empty, frame, odd, rows


def held(key):
    return key is not None and zlib.crc32(str(key).encode()) % 5 == 1


def brute(docs, model):
    """Counts and base score by definition; the model's score from its table, word by word."""
    train = Counter()
    for key, text in docs:
        if not held(key):
            train.update([*lm.tokens(text or ""), None])
    n, v = sum(train.values()), len(train)
    single = {w: i for w, i in model.frequent.items() if i < lm.WORD_CLASSES - 1}
    in_class = defaultdict(list)
    for w, c in train.items():
        if w is not None and w not in single:
            in_class[lm.rare_class(w)].append(c)
    table = model.table()
    out = []
    for key, text in docs:
        own = [*lm.tokens(text or ""), None]
        base = sum(math.log10((train[w] + 0.5) / (n + 0.5 * (v + 1))) for w in own)
        score, before = 0.0, lm.CLASSES
        for w in own:
            kind = lm.WORD_CLASSES - 1 if w is None else single.get(w, None)
            if kind is None:
                kind = lm.rare_class(w)
                score += math.log10((train[w] + 0.5) / (sum(in_class[kind]) + 0.5 * (len(in_class[kind]) + 1)))
            score += float(table[before, kind])
            before = kind
        out.append((key, held(key), len(own), sum(train[w] > 0 for w in own), n, base, score))
    return out


def same(got, want):
    key = lambda r: (str(r[0]), *r[1:5], round(r[5], 6))
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5:] for r in got], [r[5:] for r in want], rtol=1e-6, atol=1e-6)


def test_query(spark, monkeypatch):
    """Exact counts and scores, with few frequent words too; better than word frequencies on unseen texts."""
    docs = [(r["doc_id"], r["text"]) for r in rows()]
    table = spark.read.parquet(f"{SF}/documents.parquet")
    for frequent, counted in ((150_000, 300_000), (2_000, 500)):
        monkeypatch.setattr(lm, "FREQUENT", frequent)
        monkeypatch.setattr(lm, "COUNTED", counted)
        model, _ = lm.fit(table.where("NOT crc32(cast(doc_id AS string)) % 5 = 1"))
        got = op5_language_model(spark, SF).collect()
        same(got, brute(docs, model))
        unseen = [r for r in got if r["held_out"]]
        assert sum(r["score"] for r in unseen) > sum(r["base_score"] for r in unseen)


def test_model_is_normalised(spark):
    model, _ = lm.fit(spark.read.parquet(f"{SF}/documents.parquet"))
    assert np.allclose((10.0 ** model.table()).sum(axis=1), 1, atol=1e-3)
    assert np.allclose(model.table(7), model.table(), atol=1e-5)


def test_noise_contrastive_estimation_finds_the_distribution():
    """Counts drawn from a low-rank model are learned: unnormalised sums come out near 1, and near the truth."""
    rng = np.random.default_rng(1)
    logits = rng.standard_normal((30, 4)) @ rng.standard_normal((4, 40))
    true = np.exp(logits) / np.exp(logits).sum(axis=1, keepdims=True)
    pairs = np.array([rng.multinomial(20_000, p) for p in true]).astype(float)
    q, r, b = lm.noise_contrastive(pairs, size=8, steps=600)
    raw = np.exp(q @ r.T + b)
    assert np.abs(np.log(raw.sum(axis=1))).max() < 0.1
    learned = raw / raw.sum(axis=1, keepdims=True)
    divergence = (true * np.log(true / learned)).sum(axis=1).mean()
    unigram = pairs.sum(axis=0) / pairs.sum()
    assert divergence < 0.03 < 0.3 < (true * np.log(true / unigram)).sum(axis=1).mean()


def test_odd_rows(spark, tmp_path):
    docs = odd(spark)
    docs.write.parquet(f"{tmp_path}/odd/documents.parquet")
    pairs = [(r["doc_id"], r["text"]) for r in docs.collect()]
    unseen = F.expr("coalesce(crc32(cast(doc_id AS string)) % 5 = 1, false)")
    model, _ = lm.fit(docs.where(~unseen))
    same(op5_language_model(spark, f"{tmp_path}/odd").collect(), brute(pairs, model))
    empty(spark).write.parquet(f"{tmp_path}/empty/documents.parquet")
    assert op5_language_model(spark, f"{tmp_path}/empty").collect() == []


def test_without_training_rows(spark):
    docs = frame(spark, [(1, "a b"), (2, None)])
    model, counts = lm.fit(docs.where("false"))
    got = lm.score(docs, F.lit(True), model, counts).collect()
    assert [(r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"]) for r in got] == [(1, 3, 0, 0), (2, 1, 0, 0)]
    assert all(r["score"] < 0 and abs(r["base_score"]) < 1e-9 for r in got)
