"""Lists inside documents and child tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.casts import FAIL, NULL


def explode_variant(df: DataFrame, column: str, path: str = "$", name: str = "value", outer: bool = False) -> DataFrame:
    """One row per element of a JSON list.

    Rows whose list is empty, missing or null vanish, unless ``outer``.
    """
    elements = F.variant_get(F.col(column), path, "array<variant>")
    explode = F.explode_outer if outer else F.explode
    return df.select("*", explode(elements).alias(name))


def child_list(doc: Column, path: str, id_field: str, type_field: str, on_error: str = FAIL) -> Column:
    """A child list of a document as ``array<struct<type, id>>``."""
    get = F.try_variant_get if on_error == NULL else F.variant_get
    children = get(doc, path, f"array<struct<`{type_field}`: string, `{id_field}`: string>>")
    return F.transform(children, lambda c: F.struct(c[type_field].alias("type"), c[id_field].alias("id")))


def child_columns(children: Column, types: Mapping[str, str]) -> list[Column]:
    """One column per child type, read inside the row: no explode, join or shuffle (C4).

    ``types`` maps child type to column name. Of several children of one type
    the largest id is taken.
    """

    def of_type(child_type: str) -> Column:
        return F.array_max(F.transform(F.filter(children, lambda c: c["type"] == F.lit(child_type)), lambda c: c["id"]))

    return [of_type(child_type).alias(name) for child_type, name in types.items()]


def child_pivot(
    children: DataFrame, keys: Sequence[str], type_column: str, value_column: str, types: Mapping[str, str]
) -> DataFrame:
    """One column per child type for children that are rows of their own (C4).

    One conditional aggregate for all types; partial aggregates run before the
    shuffle, so a parent with any number of children sends one row per task.
    """
    child_type, value = F.col(type_column), F.col(value_column)
    wanted = children.where(child_type.isin(list(types)))
    return wanted.groupBy(*keys).agg(
        *[F.max(F.when(child_type == F.lit(t), value)).alias(name) for t, name in types.items()]
    )


def lateral_left(
    df: DataFrame, children: DataFrame, key: str, type_column: str, value_column: str, types: Mapping[str, str]
) -> DataFrame:
    """One left join per child type on the key alone.

    Several children of a type multiply the row: a key with D children of each
    of n types gives D**n rows for each of its rows. Kept for callers that need
    exactly that, and never a default; ``child_pivot`` and ``child_columns`` keep rows unique.
    """
    for child_type, name in types.items():
        one = children.where(F.col(type_column) == F.lit(child_type)).select(
            F.col(key).alias("_key"), F.col(value_column).alias(name)
        )
        df = df.join(one, F.col(key) == F.col("_key"), "left").drop("_key")
    return df


