"""Small document tables for the corpus tests."""

from __future__ import annotations

import pyarrow.parquet as pq

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def rows(sf_dir: str = SF, table: str = "documents"):
    return pq.read_table(f"{sf_dir}/{table}.parquet").to_pylist()


def frame(spark, items):
    """A documents table of (doc_id, text) or (doc_id, text, source) tuples."""
    full = [(i[0], i[1], None, i[2] if len(i) > 2 else None, None) for i in items]
    return spark.createDataFrame(full, SCHEMA)


def odd(spark):
    """NULLs in every column, empty and long texts, repeated rows and ids, and a clashing column name."""
    long = "a long text with words that go on and on " * 5_000
    items = [
        (5, "same words in two rows of one id, more than five of them"),
        (5, "same words in two rows of one id, more than five of them"),
        (5, "another text of the same id"),
        (None, "a text without an id"),
        (None, None),
        (7, None),
        (8, ""),
        (9, "   \n\t "),
        (10, long),
        (11, "one"),
        (-3, "naïve 日本語 😀 ﬁ"),
    ]
    return frame(spark, items).selectExpr("*", "1 AS bucket", "'x' AS shard", "2.5 AS score", "doc_id AS content")


def empty(spark):
    return frame(spark, [])
