"""Row hashes and surrogate keys.

``xxhash64`` and ``hash`` skip NULLs and give int and bigint different values,
so a NULL that moves from one column to the next would go unnoticed. Both keys
here are MD5 over text instead.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .casts import zone_free

NULL_MARK = "-"


def _as_text(name: str, data_type: T.DataType) -> Column:
    col = F.col(f"`{name}`")
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        # adding zero folds -0.0 into 0.0
        return (col + F.lit(0.0)).cast("string")
    if isinstance(data_type, (T.VariantType, T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(col)
    return zone_free(col, data_type).cast("string")


def row_hash(df: DataFrame, columns: Iterable[str] | None = None) -> Column:
    """MD5 of the given columns of ``df`` (all of them by default).

    Every value enters as ``<length>:<text>`` and NULL as a mark no value can
    produce, so neither shifted NULLs nor separators inside values collide.
    """
    types = {f.name.lower(): f.dataType for f in df.schema.fields}
    texts = F.array(*[_as_text(name, types[name.lower()]) for name in (df.columns if columns is None else columns)])
    # one expression for all values: spelled out for each of a wide row, it is a method that the JVM does not compile
    parts = F.transform(texts, lambda t: F.concat(F.char_length(t), F.lit(":"), t))
    return F.md5(F.array_join(parts, "", NULL_MARK))


def surrogate_key(df: DataFrame, *columns: str) -> Column:
    """MD5 of columns of ``df`` as text, NULL as the empty string, joined by ``-``.

    Times enter as in UTC, so a key does not depend on the session.
    """
    types = {f.name.lower(): f.dataType for f in df.schema.fields}
    parts = [F.coalesce(zone_free(F.col(f"`{c}`"), types[c.lower()]).cast("string"), F.lit("")) for c in columns]
    return F.md5(F.concat_ws("-", *parts))
