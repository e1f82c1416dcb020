"""The corpus pipeline: documents in, token digests of clean documents out.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage
before it kept, as written and read again. All but the last return the columns
of ``docs`` as they came, whatever these are.

1. toxicity: documents scored 0.7 or more go. The model learns from the labelled
   rows of ``docs``.
2. near duplicates: one row of each class stays, that of the smallest id.
3. decontamination: documents with a verified benchmark item go.
4. secrets: secrets are masked in the text, except widely copied examples;
   ``n_chars`` follows the text. All documents stay.
5. pieces: ids of each text, as digests, and of the text decoded from them.

Odd rows: NULL texts are empty texts to every stage, and pass the first, third
and fourth unchanged; every row is judged by its own text, whatever its id, but
labels reach rows by id; repeated rows become one in the second stage; empty
tables give empty results.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from histkit.llm import decontamination, near_duplicates, pieces, secrets, toxicity
from histkit.sources.tables import shared_folder

def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, model).where(F.col("score") < toxicity.THRESHOLD).select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_duplicates.drop_near_duplicates(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    keyed = docs.select(F.struct(*docs.columns).alias("_row"), "text", "source", "lang")
    found = secrets.find_secrets(keyed, ["_row"])
    hidden = F.filter("spans", lambda s: s["verdict"] != "example")
    text = secrets.mask(F.col("_row.text"), hidden)
    masked = found.select("_row", text.alias("_text"), (F.size(hidden) > 0).alias("_changed"))
    changed = {"text": F.col("_text"), "n_chars": F.length("_text").cast(docs.schema["n_chars"].dataType)}
    return masked.select(
        *[
            (F.when(F.col("_changed"), changed[c]).otherwise(F.col(f"_row.`{c}`")) if c in changed else F.col(f"_row.`{c}`")).alias(c)
            for c in docs.columns
        ]
    )


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.encode_pieces(docs, public_tokenizers.path("piece_bpe_32k.model"), with_ids=False)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("secrets", mask_secrets),
    ("pieces", encode),
]

#: Boosted trees, sketches and merges cannot be said in SQL; the tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents; what a stage returns is written to the shared folder and read again."""
    folder = shared_folder(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{i}-{name}-{uuid.uuid4().hex[:8]}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
