import hashlib

import pytest
import xxhash
from pyspark.sql import functions as F

from histkit.llm import fingerprints, ordered
from histkit.llm.fingerprints import BINS, as_text, fingerprint, likeness
from histkit.llm.ordered import with_next
from histkit.llm.queries import op1_fingerprints
from tests.llm.small import SF, empty, frame, odd, rows


def chain(values, seed=42):
    for v in values:
        seed = xxhash.xxh64_intdigest(v.to_bytes(8, "little"), seed)
    return seed


def shingles(text):
    own = [xxhash.xxh64_intdigest(w, 42) for w in (text or "").encode().split()]
    if len(own) < 5:
        if not own:
            return set()
        state = 5
        for h in own:  # the accumulator is hashed first, then the word
            state = chain([state, h])
        return {state}
    return {chain(own[i : i + 5]) for i in range(len(own) - 4)}


ORDERS = fingerprints._probe_orders()


def brute(text):
    """Bins as a dict, each empty one filled by its own probe order."""
    found = {}
    for h in shingles(text):
        signed = h - (1 << 64) if h >> 63 else h
        found.setdefault((signed >> 56) + BINS // 2, []).append(signed)
    if not found:
        return ""
    least = {b: min(v) for b, v in found.items()}
    whole = [least[b] if b in least else next(least[j] for j in ORDERS[b] if j in least) for b in range(BINS)]
    return "".join("0123456789abcdef"[v & 15] for v in whole)


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


TEXTS = ["", " \n", "one", "one two three four", "a b c d e", "a b c d e f g " * 3, "x " * 500, "é 日本 😀 w v u"]


def test_fingerprint(spark):
    texts = TEXTS + [r["text"] for r in rows()[:40]]
    out = frame(spark, list(enumerate(texts))).select("doc_id", as_text(fingerprint(F.col("text"))).alias("p")).collect()
    assert {r["doc_id"]: r["p"] for r in out} == {i: brute(t) for i, t in enumerate(texts)}


def test_likeness_follows_resemblance(spark):
    """Against the true resemblance of pairs that share any part of 400 words."""
    words = [f"w{i}" for i in range(2000)]
    pairs = [(" ".join(words[:400]), " ".join(words[k : k + 400])) for k in range(0, 440, 20)]
    found = (
        spark.createDataFrame(pairs, "a string, b string")
        .select("a", "b", likeness(fingerprint(F.col("a")), fingerprint(F.col("b"))).alias("near"))
        .collect()
    )
    errors = [r["near"] - jaccard(r["a"], r["b"]) for r in found]
    assert max(map(abs, errors)) < 0.15 and abs(sum(errors)) / len(errors) < 0.04
    assert [r["near"] for r in found if r["a"] == r["b"]] == [1.0]


def expected(docs):
    """doc_id, n_chars, edited hash, fingerprints, by falling id."""
    docs = sorted(docs, key=lambda d: (d[0] is None, -(d[0] or 0), d[1] or ""))
    out = []
    for i, (key, text) in enumerate(docs):
        text, after = text or "", docs[(i + 1) % len(docs)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        out.append((str(key), len(text), hashlib.sha256(edited.encode()).hexdigest(), brute(text), brute(edited)))
    return sorted(out)


def check(out, docs):
    got = [(str(r["doc_id"]), r["n_chars"], r["edited_sha256"], r["fingerprint"], r["edited_fingerprint"]) for r in out]
    assert sorted(got) == expected(docs)
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in out)


def test_query(spark):
    out = op1_fingerprints(spark, SF).collect()
    check(out, [(r["doc_id"], r["text"]) for r in rows()])
    text = {r["doc_id"]: r["text"] for r in rows()}
    errors = [r["near_next"] - jaccard(text[r["doc_id"]], text[(r["doc_id"] - 1) % len(text)]) for r in out]
    assert max(map(abs, errors)) < 0.2


@pytest.mark.parametrize("per_range", [1, 3, 7, 1000])
def test_next_row_in_any_ranges(spark, per_range):
    keys = [5, 9, 9, 2**62, -4, 100, 101, 102, 103, 7, None, None]
    docs = frame(spark, [(k, f"t{i}") for i, k in enumerate(keys)]).repartition(3)
    out = with_next(docs.select("doc_id", "text"), "doc_id", "text", ["text", "doc_id"], per_range).collect()
    order = sorted(((k, f"t{i}") for i, k in enumerate(keys)), key=lambda d: (d[0] is None, -(d[0] or 0), d[1]))
    after = {t: order[(i + 1) % len(order)] for i, (_, t) in enumerate(order)}
    assert {r["text"]: (r["next_doc_id"], r["next_text"]) for r in out} == after and len(out) == len(keys)


def test_next_row_alone(spark):
    for key in (3, None):
        out = with_next(frame(spark, [(key, "only")]).select("doc_id", "text"), "doc_id", "text", ["text"]).collect()
        assert [(r["doc_id"], r["next_text"]) for r in out] == [(key, "only")]


def test_ranges_are_cut_at_quantiles(spark):
    cuts = sorted({(i * 37) % 1000 for i in range(300)})
    keys = spark.range(-5, 1010).select("id", ordered._range_of(F.col("id"), cuts).alias("r")).collect()
    assert all(r["r"] == sum(c < r["id"] for c in cuts) for r in keys)


def test_odd_rows(spark, tmp_path):
    docs = odd(spark)
    docs.write.parquet(f"{tmp_path}/odd/documents.parquet")
    out = op1_fingerprints(spark, f"{tmp_path}/odd").collect()
    check(out, [(r["doc_id"], r["text"]) for r in docs.collect()])
    empty(spark).write.parquet(f"{tmp_path}/empty/documents.parquet")
    assert op1_fingerprints(spark, f"{tmp_path}/empty").collect() == []


def test_equal_texts_have_equal_fingerprints(spark):
    docs = frame(spark, [(i, r["text"]) for i, r in enumerate(rows()[:20] * 2)])
    out = docs.select("text", as_text(fingerprint(F.col("text"))).alias("p")).distinct()
    assert out.count() == len({r["text"] for r in rows()[:20]})


def test_thousands_of_rows_without_an_id(spark):
    """They are cut into ranges by text, copies too, and follow each other by text all the same."""
    items = [(i, f"text {i}") for i in range(50)]
    items += [(None, f"no id {i:05d}") for i in range(3000)] + [(None, "one text that many have")] * 2000
    docs = frame(spark, items).select("doc_id", "text").repartition(5)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = ordered._ranges_of_nulls(docs, "doc_id", "text").groupBy("_range").count().collect()
        assert len(sizes) == 8 and max(r["count"] for r in sizes) < 1500
        for some in (docs, docs.where("doc_id IS NULL")):
            got = with_next(some, "doc_id", "text", ["text"]).collect()
            order = sorted(some.collect(), key=lambda r: (r["doc_id"] is None, -(r["doc_id"] or 0), r["text"]))
            follows = sorted((a["text"], b["text"]) for a, b in zip(order, order[1:] + order[:1]))
            assert sorted((r["text"], r["next_text"]) for r in got) == follows
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
