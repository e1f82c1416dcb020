import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from histkit.llm import toxicity
from tests.llm.small import SF, frame, odd
from tests.llm.test_decontamination import words_of
from tests.llm.test_near_duplicates import brute as classes
from tests.llm.test_pieces import brute as piece_digests
from tests.llm.test_secrets import base


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """What each stage returns, written and read again."""
    out = [spark.read.parquet(f"{SF}/documents.parquet")]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("steps") / str(i))
        stage(spark, out[-1], SF).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def rows(df):
    return sorted((r.asDict() for r in df.collect()), key=lambda r: r["doc_id"])


def test_columns_stay(steps):
    for step in steps[1:-1]:
        assert step.dtypes == steps[0].dtypes


def test_toxicity(spark, steps):
    model = toxicity.fit(steps[0], spark.read.parquet(f"{SF}/labels.parquet"))
    make = toxicity.Features(model.lexicon)
    kept = [r for r in rows(steps[0]) if model.scores(make.of(r["text"])[None])[0] < 0.7]
    assert rows(steps[1]) == kept
    assert 0 < len(rows(steps[0])) - len(kept) < 60


def test_near_duplicates(steps):
    before = rows(steps[1])
    first = sorted(set(classes([r["text"] for r in before])))
    assert rows(steps[2]) == [before[i] for i in first] and len(first) < len(before)


def test_decontamination(spark, steps):
    items = [" ".join(words_of(r["text"])) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    before = rows(steps[2])
    kept = [r for r in before if not any(f" {w} " in f" {' '.join(words_of(r['text']))} " for w in items)]
    assert rows(steps[3]) == kept and len(kept) < len(before)


def test_secrets(steps):
    before, after = rows(steps[3]), rows(steps[4])
    assert [r["doc_id"] for r in before] == [r["doc_id"] for r in after]
    for a, b in zip(before, after):
        assert {k: v for k, v in a.items() if k not in ("text", "n_chars")} == {k: v for k, v in b.items() if k not in ("text", "n_chars")}
        if base(a["text"]):
            assert not base(b["text"]) and "[secret]" in b["text"] and b["n_chars"] == len(b["text"])
        elif "[secret]" not in b["text"]:
            assert a == b


def test_secrets_that_are_examples_stay(spark):
    """A template value under many owners stays; random values go, however many owners or copies they have."""
    random, own = "k3Jx9Qw2Lm7Zt4Vb", "0f3a9c5e7b1d2468ace013579bdf02468ace1357"
    items = [(i, f"text {i}: password=your-password, token={random}", f"owner{i}") for i in range(4)]
    items += [(10 + i, f"one text with secret={own}", f"owner{i}") for i in range(4)]
    out = {r["doc_id"]: r for r in corpus_pipeline.mask_secrets(spark, frame(spark, items), SF).collect()}
    for i in range(4):
        assert out[i]["text"] == f"text {i}: password=your-password, [secret]"
        assert out[10 + i]["text"] == "one text with [secret]" and out[10 + i]["n_chars"] == len(out[10 + i]["text"])


def test_pieces(steps):
    want = sorted((r["doc_id"], *piece_digests(r["text"])) for r in rows(steps[4]))
    assert sorted(tuple(r) for r in steps[5].collect()) == want


def test_run(spark, steps):
    got = corpus_pipeline.run(spark, SF).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, steps[5].collect()))


def test_odd_rows(spark):
    """Every stage alone on odd rows, with a column whose name the operators use themselves."""
    docs = odd(spark).withColumn("row", F.lit(1)).withColumn("spans", F.lit("x"))
    sizes = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        sizes[name] = out.count()
        if name != "pieces":
            assert out.columns == docs.columns
        assert stage(spark, frame(spark, []), SF).count() == 0
    n = docs.count()
    assert sizes == {"toxicity": n, "near_duplicates": 7, "decontamination": n, "secrets": n, "pieces": n}
