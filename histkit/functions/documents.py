"""JSON documents: parse once, read many paths.

Text is parsed straight into the members that are read, each a VARIANT, so the
rest of a document is skipped and not built. Spark rejects VARIANT in DISTINCT, set operations, GROUP BY and ``max``, so a
sub-document that is kept leaves these functions as canonical JSON text, with
object keys in sorted order.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .casts import FAIL, NULL

# Where the value of an attribute sits and what type it has.
FIELD_KINDS = {
    "str": ("$", "string"),
    "label": ("$.defaultAttributes.Label", "string"),
    "id": ("$.id", "bigint"),
    "ts": ("$", "timestamp_ntz"),
    "num": ("$", "decimal(38,0)"),
    "var": ("$", "json"),
}


def as_document(col: Column, source: T.DataType, on_error: str = FAIL) -> Column:
    """JSON text to VARIANT; a VARIANT column passes through."""
    if isinstance(source, T.VariantType):
        return col
    return F.try_parse_json(col) if on_error == NULL else F.parse_json(col)


def read_members(col: Column, source: T.DataType, members: Mapping[str, str], on_error: str = FAIL) -> Column:
    """Top-level members of a document as a struct; ``members`` maps name to type.

    A document that does not parse raises, or with ``on_error="null"`` gives
    NULL members.
    """
    if isinstance(source, T.VariantType):
        get = F.try_variant_get if on_error == NULL else F.variant_get
        return F.struct(*[get(col, f"$['{name}']", kind).alias(name) for name, kind in members.items()])
    schema = ", ".join(f"`{name}` {kind}" for name, kind in members.items())
    return F.from_json(col, schema, {"mode": "PERMISSIVE" if on_error == NULL else "FAILFAST"})


def member_path(path: str) -> tuple[str, str]:
    """Split ``$.A[0].B`` into the member ``A`` and the path ``$[0].B`` below it."""
    name = re.match(r"\$\.([^.\[]+)", path).group(1)
    return name, "$" + path[2 + len(name) :]


def canonical_json(doc: Column) -> Column:
    """Text form with sorted object keys, usable in joins, groups and hashes."""
    return F.to_json(doc)


def json_get(doc: Column, path: str, target: str, time_type: str = "timestamp", on_error: str = FAIL) -> Column:
    """Read ``path`` of a VARIANT as ``target``.

    Besides Spark type names ``target`` may be ``json`` (canonical text of a
    sub-document) or ``date_timestamp`` (a date, then midnight of that day).
    """
    get = F.try_variant_get if on_error == NULL else F.variant_get
    if target == "json":
        return canonical_json(get(doc, path, "variant"))
    if target == "date_timestamp":
        return get(doc, path, "date").cast(time_type)
    if target == "bigint":
        # through a scale-0 decimal, which rounds fractions
        return get(doc, path, "decimal(38,0)").cast("bigint")
    return get(doc, path, time_type if target == "timestamp" else target)


def field_value(
    value: Column, kind: str, at: str = "$", timestamp_format: str | None = None, on_error: str = FAIL
) -> Column:
    """Read the attribute value at path ``at`` by its kind (``FIELD_KINDS``).

    ``timestamp_format`` reads times kept as text that a plain cast does not
    take, such as 12-hour clock times.
    """
    below, target = FIELD_KINDS[kind]
    path = at + below[1:]
    if kind == "ts" and timestamp_format:
        text = json_get(value, path, "string", on_error=on_error)
        parse = F.try_to_timestamp if on_error == NULL else F.to_timestamp_ltz
        return parse(text, F.lit(timestamp_format)).cast(target)
    col = json_get(value, path, target, on_error=on_error)
    # a JSON null carries no value
    return F.nullif(col, F.lit("null")) if kind == "var" else col
