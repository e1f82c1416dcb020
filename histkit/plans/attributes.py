"""Attribute-list documents to wide typed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import row_hash
from ..operators.pivot import KEYS, NAMED_VALUES, infer_fields, pivot_attributes
from ..operators.skew import if_small
from ..operators.versions import anti_rows
from ..operators.watermark import current_watermark, watermark_filter
from ..sources.scans import scan_attributes
from ..sources.tables import stage
from .history import HASH, LOADED, of_keys
from .specs import AttributeSpec


def attribute_pivot(
    spec: AttributeSpec,
    source: DataFrame,
    target: DataFrame | None = None,
    run_ts: str | None = None,
    watermark: str | None = None,
) -> DataFrame:
    """One row per document version, with row hash and load time.

    With ``target`` only documents loaded since its newest row are read, and
    rows it already holds with the same content are left out (P6, J2): append
    the result. Without it the result is the whole table.
    """
    if target is not None and watermark is None:
        watermark = current_watermark(target, LOADED, grain=None)
    batch = watermark_filter(source, spec.loaded, watermark, spec.loaded_day)
    documents = scan_attributes(batch, spec.payload, spec.on_error, NAMED_VALUES, spec.timestamp_format)
    wide = pivot_attributes(documents, spec.fields, spec.timestamp_format, spec.on_error)
    wide = wide.withColumn(HASH, row_hash(wide, [*KEYS, *spec.fields]))
    if target is not None:
        # the documents are read once; of a large target only the rows with an id of the batch can match
        wide = stage(wide)
        known = of_keys(target.select("id", HASH), wide, "id", wide.count())
        # which rows the target holds is found on two columns, so that few of them leave the wide rows where they are
        held = stage(wide.select("id", HASH).join(known, ["id", HASH], "left_semi"))
        wide = anti_rows(wide, if_small(held, held.count()), ["id", HASH])
    stamp = F.current_timestamp() if run_ts is None else F.lit(run_ts)
    return wide.select(*KEYS, *[f"`{n}`" for n in spec.fields], HASH, stamp.cast(spec.time_type).alias(LOADED))


def infer_spec(spec: AttributeSpec, source: DataFrame) -> AttributeSpec:
    """``spec`` with the fields found in the documents (D5); one row per field reaches the driver."""
    found = infer_fields(scan_attributes(source, spec.payload, spec.on_error, timestamp_format=spec.timestamp_format))
    kinds = {r["name"]: r["kind"] for r in found.orderBy("name").collect()}
    return spec.with_(fields=kinds)
