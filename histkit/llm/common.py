"""Words, texts and small helpers that the corpus operators share.

Defined results for odd rows, everywhere in this package: a NULL text counts as
the empty text, a NULL id is an id of its own, and columns other than those an
operator names are not looked at, so they may have any name.
"""

from __future__ import annotations

import ctypes
import functools
import gc

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space as the contracts have it: space, tab, line feed to carriage return.
SPACES = r"[\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def whole_texts(docs: DataFrame, *more: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``text`` (never NULL) and the columns named, nothing else."""
    return docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"), *more)


def words(text: Column) -> Column:
    """The words of a text, an empty array if it has none."""
    return F.filter(F.split(text, SPACES, -1), lambda w: w != F.lit(""))


def let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once a row, however often ``use`` names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def tidy(run):
    """A function of batches whose worker gives back the memory that it used.

    Workers live on after a task. Arrow's pool and the C library keep what they
    freed, and over the stages of a pipeline that adds up.
    """

    @functools.wraps(run)
    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)

    return wrapped


def ceil_div(a: int, b: int) -> int:
    return -(-a // b)
