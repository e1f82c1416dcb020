"""Which rows of a large table may have a key of a batch: a filter that is broadcast.

A batch that is too large to broadcast itself is joined by shuffle, and would move the
whole table with it. Its keys' hashes as bits of a map are far smaller: eight bits for a row
of the batch let about one row in nine pass that has none of its keys. The map is cut into
pages of 4 KB, made by one aggregate; a row of the table meets the page of its key. What
passes still goes through the join, so the result is the same with or without.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits for a row of the batch, bits of a page, and bytes that are broadcast at most.
BITS_PER_ROW, PAGE_BITS, MOST_BYTES = 8, 4096 * 8, 64 << 20


def pages_for(rows: int) -> int | None:
    """Pages for a batch of so many rows, or None if they would be too large to broadcast."""
    pages = max(1, -(-rows * BITS_PER_ROW // PAGE_BITS))
    return pages if pages * PAGE_BITS // 8 <= MOST_BYTES else None


def _place(key: Column, pages: int) -> tuple[Column, Column]:
    """Page and bit of a key."""
    bit = F.pmod(F.xxhash64(F.lit(17), key), F.lit(pages * PAGE_BITS))
    return F.floor(bit / PAGE_BITS).cast("int"), (bit % PAGE_BITS).cast("int")


def key_filter(batch: DataFrame, key: str, pages: int) -> DataFrame:
    """The map of the batch's keys: (_page, _bits), ``pages`` rows at most."""
    page, bit = _place(F.col(key), pages)
    placed = batch.where(F.col(key).isNotNull()).select(page.alias("_page"), bit.cast("bigint").alias("_bit"))
    return placed.groupBy("_page").agg(F.bitmap_construct_agg("_bit").alias("_bits"))


def may_match(df: DataFrame, key: str, filter_: DataFrame, pages: int) -> DataFrame:
    """Rows of ``df`` whose key may be in the batch; none with a NULL key."""
    page, bit = _place(F.col(key), pages)
    own = [F.col(f"`{c}`") for c in df.columns]
    met = df.where(F.col(key).isNotNull()).join(F.broadcast(filter_), page == F.col("_page"))
    # the byte as a number: a character of an encoding that has one for each byte
    byte = F.ascii(F.decode(F.substring("_bits", F.floor(bit / 8).cast("int") + 1, F.lit(1)), "ISO-8859-1"))
    return met.where(F.call_function("shiftright", byte, bit % 8).bitwiseAND(1) == 1).select(own)
