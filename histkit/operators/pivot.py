"""Attribute lists to columns.

A document lists its attributes as ``fields: [{name, type, value}]``. One row
per attribute with a conditional maximum per column costs (attributes x
columns) for each document, so the list becomes an object inside the row and each
column looks its name up. Only the finished wide row is aggregated.
"""

from __future__ import annotations

import zlib
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.casts import FAIL
from ..functions.documents import FIELD_KINDS, field_value

# Header members of a document and their types.
HEADER = (("deleted", "string"), ("id", "bigint"), ("lastUpdated", "timestamp_ntz"))
KEYS = tuple(name for name, _ in HEADER)

FIELD_LIST = "array<struct<name: string, type: string, value: variant>>"
# kinds as ``infer_fields`` sees them; text comes first, so that a range tells text from mixed values
SEEN = ("str", "ts", "label", "id", "num", "var")
# kinds whose value is the attribute's own, not a member of it
TOP_KINDS = ("str", "ts", "num")
# what the pivot reads of it
NAMED_VALUES = "array<struct<name: string, value: variant>>"
#: Fields up to which values are looked up in an object of the document; of more, each is read where it stands in the list.
LOOKED_UP = 100


def attribute_rows(df: DataFrame) -> DataFrame:
    """One row per attribute, replays of a document version removed (A3).

    Documents are shuffled, not their attributes: equal rows are of one version, so
    those of a task need no other. A plain explode would have Spark put a filter on the
    list below all projections, where it parses the documents a second time.
    """
    return (
        df.repartition(*KEYS)
        .select(*KEYS, F.posexplode_outer("fields").alias("place", "field"))
        .where("place IS NOT NULL")
        .select(*KEYS, "field.name", "field.type", F.to_json("field.value").alias("value"))
        .distinct()
    )


def _layers() -> Column:
    """The attributes of a document as one list of unique names.

    A document that repeats a name, or has an attribute without one, becomes
    one list per named attribute instead; the maximum over the document version
    that follows joins them again. A document without attributes gives none.
    """
    names = F.array_distinct(F.array_compact("fields.name"))
    named = F.filter("fields", lambda f: f["name"].isNotNull())
    one_each = F.when(F.size(named) > 0, F.transform(named, lambda f: F.array(f))).otherwise(F.array(named))
    return F.when(F.size(names) < F.size("fields"), one_each).when(F.size("fields") > 0, F.array("fields"))


def pivot_attributes(
    df: DataFrame, fields: Mapping[str, str], timestamp_format: str | None = None, on_error: str = FAIL
) -> DataFrame:
    """One typed row per document version: (deleted, id, lastUpdated) (A2, A4).

    ``fields`` maps attribute name to kind. NULLs are ignored and of several
    values the largest wins. Replays of a version need no DISTINCT first: a
    maximum does not change when a value is seen again.
    """
    read = _read_by_name if len(fields) <= LOOKED_UP else _read_in_place
    rows = read(df, fields, timestamp_format, on_error)
    return rows.groupBy(*KEYS).agg(*[F.max(f"`{name}`").alias(name) for name in fields])


def _read_by_name(df: DataFrame, fields: Mapping[str, str], timestamp_format: str | None, on_error: str) -> DataFrame:
    """The fields of each document out of an object of its attributes; rows are shuffled and sorted by version."""
    at_top = {kind: FIELD_KINDS[kind][1] for kind in TOP_KINDS if not (kind == "ts" and timestamp_format)}
    # kind by kind: like values next to each other are packed tighter
    plain = {name: at_top[kind] for kind in at_top for name, k in fields.items() if k == kind}
    rest = {name: kind for name, kind in fields.items() if name not in plain}
    of_kind = {kind: [name for name, k in rest.items() if k == kind] for kind in dict.fromkeys(rest.values())}
    values = F.col("values")

    def read(kind: str) -> Column:
        return F.array(*[field_value(values, kind, f"$['{n}']", timestamp_format, on_error) for n in of_kind[kind]])

    # values that are the attribute itself are read in one pass over the object; each path of its own is a search
    get = F.variant_get if on_error == FAIL else F.try_variant_get
    names = ", ".join(f"`{name}`: {kind}" for name, kind in plain.items())
    once = [get(values, "$", f"struct<{names}>").alias("_plain")] if plain else []
    # read where the object is made: as a column of a shuffled row it would be copied for each of its paths
    objects = F.transform(_layers(), lambda f: F.to_variant_object(F.map_from_arrays(f["name"], f["value"])))
    lists = df.select(*KEYS, F.explode(objects).alias("values"))
    lists = lists.select(*KEYS, *once, *[read(k).alias(f"_{k}") for k in of_kind])
    # the narrow rows, a struct and a list of values for each other kind, are shuffled and sorted; the wide ones are
    # aggregated where they are made
    narrow = lists.repartition(*KEYS).sortWithinPartitions(*KEYS)

    def column(name: str, kind: str) -> Column:
        if name in plain:
            return F.col("_plain").getField(name)
        return F.get(f"_{kind}", F.lit(of_kind[kind].index(name)))

    return narrow.select(*KEYS, *[column(name, kind).alias(name) for name, kind in fields.items()])


def _read_in_place(df: DataFrame, fields: Mapping[str, str], timestamp_format: str | None, on_error: str) -> DataFrame:
    """The fields of each document where their names stand in its list; rows are shuffled and sorted by version.

    An object of hundreds of attributes costs more to make and to search than their values to read. A name is
    found by its CRC-32, as numbers are compared faster than text. No two of a list are the same, so a name that
    is not where its CRC-32 is does not occur.
    """
    marked = df.select(*KEYS, "fields", F.transform("fields.name", lambda name: F.crc32(name)).alias("sums"))
    # a list that repeats one, or lacks several names, becomes a list for each attribute
    pairs = F.arrays_zip("sums", "fields")
    one_each = F.transform(pairs, lambda p: F.struct(F.array(p["sums"]).alias("sums"), F.array(p["fields"]).alias("fields")))
    repeats = F.size(F.array_distinct("sums")) < F.size("sums")
    layers = F.when(repeats, one_each).when(F.size("sums") > 0, F.array(F.struct("sums", "fields")))
    lists = marked.select(*KEYS, F.explode(layers).alias("list")).select(*KEYS, "list.sums", "list.fields")

    def column(name: str, kind: str) -> Column:
        # without a condition, so that the search is one step that Spark shares between its two uses
        place = F.array_position("sums", F.lit(zlib.crc32(name.encode())).cast("bigint"))
        own = F.get("fields", (place - 1).cast("int"))["name"] == F.lit(name)
        value = F.get("fields", (place * own.cast("bigint") - 1).cast("int"))["value"]
        return field_value(value, kind, "$", timestamp_format, on_error)

    wide = lists.select(*KEYS, *[column(name, kind).alias(name) for name, kind in fields.items()])
    return wide.repartition(*KEYS).sortWithinPartitions(*KEYS)


def pivot_rows(df: DataFrame, keys: Sequence[str], name: str, value: str, names: Sequence[str]) -> DataFrame:
    """Conditional-maximum pivot of (name, value) rows that are rows already (A2)."""
    return df.groupBy(*keys).agg(*[F.max(F.when(F.col(name) == F.lit(n), F.col(value))).alias(n) for n in names])


def infer_fields(df: DataFrame, nested: bool = False) -> DataFrame:
    """Which attributes occur, of which kind, in how many documents.

    Takes the frame of ``scan_attributes``. A value with a label is a
    ``label``, another object with an id an ``id``; lists, other objects and
    mixed values are ``var``; text that always reads as a time is ``ts``. A
    document counts as often as it landed. With ``nested`` a column ``shape`` gives
    the type of a ``var`` attribute with those of its members, merged over all values,
    and is NULL for other kinds.
    """
    names = F.transform("fields", lambda f: f["name"])
    # only a document that repeats a name has to look for its first place
    plain = F.size(F.array_distinct("names")) == F.size("names")
    marked = F.transform(
        "fields",
        lambda f, i: F.struct(
            f["name"].alias("name"),
            f["value"].alias("value"),
            (F.col("plain") | (F.array_position(F.col("names"), f["name"]) == i + 1)).alias("first"),
        ),
    )
    rows = (
        df.select("fields", names.alias("names"))
        .withColumn("plain", plain)
        .select(F.explode(marked).alias("f"))
        .select("f.name", "f.value", "f.first")
        .where("name IS NOT NULL")
    )
    number = {kind: F.lit(i) for i, kind in enumerate(SEEN)}
    shape = F.schema_of_variant("value")
    text = F.try_variant_get(F.col("value"), "$", "string")
    seen = (
        F.when(shape.isNull() | (shape == "VOID"), F.lit(None))
        .when(F.try_variant_get(F.col("value"), FIELD_KINDS["label"][0], "string").isNotNull(), number["label"])
        .when(F.try_variant_get(F.col("value"), "$.id", "decimal(38,0)").isNotNull(), number["id"])
        .when(shape.startswith("ARRAY") | shape.startswith("OBJECT"), number["var"])
        .when(shape == "STRING", F.when(F.try_to_timestamp(text).isNotNull(), number["ts"]).otherwise(number["str"]))
        .when(shape == "BOOLEAN", number["str"])
        .otherwise(number["num"])
    )
    # numbers, as the least and largest text could not be had without sorting all attributes
    low, high = F.min("seen"), F.max("seen")
    kind = (
        F.when(low.isNull(), "str")
        .when(low == high, F.get(F.array(*[F.lit(k) for k in SEEN]), low))
        .when(high <= SEEN.index("ts"), "str")
        .otherwise("var")
    )
    shapes = [F.schema_of_variant_agg("value").alias("shape")] if nested else []
    found = (
        rows.select("name", "first", seen.alias("seen"), *["value"][: len(shapes)])
        .groupBy("name")
        .agg(kind.alias("kind"), F.sum(F.col("first").cast("bigint")).alias("n_docs"), *shapes)
    )
    return found.withColumn("shape", F.when(F.col("kind") == "var", F.col("shape"))) if nested else found
