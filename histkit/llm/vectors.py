"""Vectors of an embeddings table as rows of numbers, and a row's place in it."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


def is_finite(vector: Column) -> Column:
    """True for a vector whose components are all there and finite; the empty vector is one. Never NULL."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.coalesce(~bad, F.lit(False))


def matrix(lists: pa.Array, width: int | None = None) -> np.ndarray:
    """Lists of numbers as rows of a matrix; shorter ones end in zeros."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    sizes = np.diff(lists.offsets.to_numpy(zero_copy_only=False))
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    width = int(sizes.max(initial=0)) if width is None else width
    out = np.zeros((len(sizes), width))
    at = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[np.repeat(np.arange(len(sizes)), sizes), at] = flat
    return out


def widened(m: np.ndarray, width: int) -> np.ndarray:
    return m if m.shape[1] >= width else np.pad(m, ((0, 0), (0, width - m.shape[1])))


def as_lists(m: np.ndarray) -> pa.ListArray:
    ends = np.arange(0, m.size + 1, m.shape[1], dtype=np.int32) if m.shape[1] else np.zeros(len(m) + 1, np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(m.ravel()))
