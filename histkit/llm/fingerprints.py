"""Document fingerprints: one-permutation MinHash, densified and packed.

Each shingle of five words is hashed once. The hash's top 8 bits choose one of
256 bins and the smallest hash of a bin is kept, which a sort of the hashes
gives for all bins at once. An empty bin takes the value of a filled one, found
by probing the bins in an order that is random but fixed for each bin (optimal
densification), so that borrowed values agree in two documents as often as
their shingles do. Of each bin's value only the low 4 bits are stored.

Two unlike bins agree in 4 bits by chance once in 16 times; ``likeness`` takes
that out: (share of equal bins - 1/16) / (1 - 1/16), not below 0.

Everything is a column expression. Odd rows: a text of one to four words is one
shingle; a text without words (NULL, empty, white space) has an empty
fingerprint, which is like another empty one and unlike all others. Equal texts
have equal fingerprints.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column
from pyspark.sql import functions as F

from histkit.llm.common import let, words

SHINGLE = 5
BIN_BITS = 8
BINS = 1 << BIN_BITS
LOW_BITS = 4
PER_WORD = 64 // LOW_BITS
#: How many probes are made before the next, longer list is tried.
PROBES = (6, 48, BINS)


def _literal(values, kind: str) -> Column:
    """A constant column; folded when the query is planned."""
    return F.from_json(F.lit(json.dumps(values)), kind)


def _probe_orders() -> list[list[int]]:
    def rank(bin_, other):
        return hashlib.blake2b(f"{bin_},{other}".encode(), digest_size=8).digest()

    return [sorted(range(BINS), key=lambda j, b=b: rank(b, j)) for b in range(BINS)]


def shingle_hashes(text: Column) -> Column:
    """64-bit hashes of a text's shingles, with repeats."""
    none = F.array().cast("array<bigint>")

    def of(h: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(h) - SHINGLE)
        whole = F.aggregate(h, F.lit(SHINGLE).cast("bigint"), lambda a, x: F.xxhash64(a, x))
        each = F.transform(starts, lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(SHINGLE)]))
        return F.when(F.size(h) == 0, none).when(F.size(h) < SHINGLE, F.array(whole)).otherwise(each)

    return let(F.transform(words(text), lambda w: F.xxhash64(w)), of)


def fingerprint(text: Column) -> Column:
    """256 bins of 4 bits as 16 numbers, or an empty array for a text without words."""
    shift = 64 - BIN_BITS
    half = BINS // 2
    # the largest number of each bin marks it as empty
    empty = _literal([((b - half + 1) << shift) - 1 for b in range(BINS)], "array<bigint>")
    orders = _probe_orders()

    def smallest(hashes: Column) -> Column:
        def firsts(h: Column) -> Column:
            return F.filter(h, lambda x, i: (i == 0) | (F.shiftright(x, shift) != F.shiftright(F.get(h, i - 1), shift)))

        return let(F.sort_array(F.concat(hashes, empty)), firsts)

    def densified(bins: Column) -> Column:
        filled = F.zip_with(bins, empty, lambda x, e: F.when(x != e, x))

        def fill(f: Column) -> Column:
            def borrow(i: Column, probes: Column) -> Column:
                unset = F.lit(None).cast("bigint")
                return F.aggregate(F.get(probes, i), unset, lambda got, j: F.coalesce(got, F.get(f, j)))

            tries = [_literal([o[:n] for o in orders], "array<array<int>>") for n in PROBES]
            return F.transform(f, lambda x, i: F.coalesce(x, *[borrow(i, t) for t in tries]))

        return let(filled, fill)

    def packed(bins: Column) -> Column:
        low = (1 << LOW_BITS) - 1
        return F.transform(
            F.sequence(F.lit(0), F.lit(BINS // PER_WORD - 1)),
            lambda w: F.aggregate(
                F.slice(bins, w * PER_WORD + 1, F.lit(PER_WORD)),
                F.lit(0).cast("bigint"),
                lambda a, x: F.shiftleft(a, LOW_BITS).bitwiseOR(x.bitwiseAND(low)),
            ),
        )

    def build(hashes: Column) -> Column:
        none = F.array().cast("array<bigint>")
        return F.when(F.size(hashes) == 0, none).otherwise(let(densified(smallest(hashes)), packed))

    return let(shingle_hashes(text), build)


def as_text(print_: Column) -> Column:
    """A packed fingerprint as hexadecimal text, one digit a bin."""
    return F.lower(F.array_join(F.transform(print_, lambda w: F.lpad(F.hex(w), PER_WORD, "0")), ""))


def likeness(a: Column, b: Column) -> Column:
    """Estimated resemblance of two packed fingerprints, 0 to 1."""
    ones = int("1" * PER_WORD, 16)

    def equal_bins(x: Column, y: Column) -> Column:
        differ = x.bitwiseXOR(y)
        pair = differ.bitwiseOR(F.shiftright(differ, 1))
        return PER_WORD - F.bit_count(pair.bitwiseOR(F.shiftright(pair, 2)).bitwiseAND(ones))

    same = F.aggregate(F.zip_with(a, b, equal_bins), F.lit(0).cast("bigint"), lambda n, x: n + x)
    chance = 1 / (1 << LOW_BITS)
    near = F.greatest(F.lit(0.0), (same / BINS - chance) / (1 - chance))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), (F.size(a) == F.size(b)).cast("double")).otherwise(near)
