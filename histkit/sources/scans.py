"""Scans of the three raw shapes."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.casts import FAIL
from ..functions.documents import as_document, field_value, json_get, read_members
from ..operators.pivot import FIELD_LIST, HEADER

TIMES = "timestamp_ntz"
SHREDDING = ("spark.sql.variant.writeShredding.enabled", "spark.sql.variant.inferShreddingSchema")
PAYLOAD, LOADED = "raw_data", "raw_inserted_timestamp"


def scan_cdc(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """A change log cut down to the named columns."""
    return df.select(*dict.fromkeys(c.lower() for c in columns))


def scan_json(
    df: DataFrame,
    members: Mapping[str, str] | None = None,
    payload: str = PAYLOAD,
    loaded: str = LOADED,
    on_error: str = FAIL,
) -> DataFrame:
    """JSON documents, parsed once: (document, load time).

    ``document`` is a struct of the given top-level members, or the whole
    document as a VARIANT.
    """
    col, kind = F.col(payload), df.schema[payload].dataType
    document = as_document(col, kind, on_error) if members is None else read_members(col, kind, members, on_error)
    return df.select(document.alias("document"), loaded)


def scan_files(spark: SparkSession, path: str, payload: str = PAYLOAD, loaded: str = LOADED) -> DataFrame:
    """JSON files where they land, as a raw table: (payload, raw_filename, load time) (S3).

    A line is a document, read as a VARIANT without a schema; the file's name and
    the time it was last changed come with it, and the partition columns of the folder.
    """
    files = spark.read.option("singleVariantColumn", payload).json(path)
    return files.select(
        payload,
        F.col("_metadata.file_name").alias("raw_filename"),
        F.col("_metadata.file_modification_time").alias(loaded),
        *[c for c in files.columns if c != payload],
    )


@contextmanager
def _shredding(spark: SparkSession):
    before = {name: spark.conf.get(name, None) for name in SHREDDING}
    for name in SHREDDING:
        spark.conf.set(name, "true")
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def store_documents(df: DataFrame, path: str, payload: str = PAYLOAD, on_error: str = FAIL, mode: str = "append") -> None:
    """Write a raw table of JSON documents with the payload parsed, once and for all.

    Members that most documents of a file have become columns of it, so a scan of the
    stored table reads the paths that a table description names and skips the rest of
    the documents. The specs take either form.
    """
    document = as_document(F.col(payload), df.schema[payload].dataType, on_error)
    with _shredding(df.sparkSession):
        df.withColumn(payload, document).write.mode(mode).parquet(path)


def scan_attributes(
    df: DataFrame,
    payload: str = PAYLOAD,
    on_error: str = FAIL,
    fields: str | None = FIELD_LIST,
    timestamp_format: str | None = None,
) -> DataFrame:
    """Attribute-list documents: header columns and the ``fields`` list.

    ``fields`` is the type the list is read as; None leaves it out. No filter
    on the list here: pushed below the projection it would parse the document
    a second time. The operators that follow drop documents without attributes.

    The header's time is read with ``timestamp_format`` like those of the
    fields. It tells versions of a document apart, so one that is there and
    cannot be read raises, with ``on_error="null"`` too.
    """
    members = {name: "variant" for name, _ in HEADER} | ({"fields": fields} if fields else {})
    document = read_members(F.col(payload), df.schema[payload].dataType, members, on_error)
    cols = []
    for name, kind in HEADER:
        value = F.col("document")[name]
        if kind == TIMES:
            cols.append(field_value(value, "ts", "$", timestamp_format).alias(name))
        else:
            cols.append(json_get(value, "$", kind, on_error=on_error).alias(name))
    if fields:
        cols.append(F.col("document")["fields"].alias("fields"))
    return df.select(document.alias("document")).select(*cols)
