"""Secrets in texts, judged by how widely each value is copied.

Candidates are found by pattern: assignments to a password-like name, access
keys, long hexadecimal strings, and opaque strings (long, with digits and both
cases). The value of each is hashed, and the hashes are counted over the whole
corpus by distinct repositories and owners. Copies of one text count once, under
one repository, as a text that travels whole says nothing of its values.

- *example*: a value that doesn't look random, in several repositories of three
  owners or more, or in so many repositories of fewer owners that it must be
  boilerplate. Only examples are harmless.
- *live*: looks random, and a single owner has it, in whatever many repositories.
- *shared*: looks random, and several owners have it: a credential that was copied.
- *unclear*: the rest.

Opaque strings are too common to report by pattern alone: they count as live, or as
shared while fewer owners than an example needs have them.

Everything is a column expression. Spans are places of code points; a span's
place follows from the lengths of the matches and of the gaps between them, as
``split`` and ``regexp_extract_all`` cut a text at the same places.

Counts are aggregated per (hash, text), then per (hash, repository) before anything
is joined, so a value in a third of all texts is one row; the join back is one that
adaptive execution can split. Values leave a text only as hashes.

Odd rows: a NULL text has no spans; NULL repositories and owners count as one
each; every input row gives one output row, repeated or without id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from histkit.llm.common import let
from histkit.sources.tables import stage

# The patterns of the base kinds and the least lengths.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{32,}"
OPAQUE = r"[A-Za-z0-9_+/-]{20,}"
ASSIGN_LEAST = 8
ACCESS_LEAST = 16
#: Kinds in the order in which spans that start together are listed.
KINDS = ("assign", "access", "hex", "opaque")
#: From so many owners, or repositories, on a value that isn't random is an example.
EXAMPLE_OWNERS, EXAMPLE_REPOSITORIES = 3, 8
#: Different characters of a value that looks random.
LIVE_CHARACTERS = 8
PLACEHOLDER = r"(?i)example|dummy|sample|changeme|placeholder|your|xxxx|1234567|abcdef"

_SPAN = "array<struct<start:bigint,kind:int,end:bigint,value:string>>"


def _spans(text: Column, pattern: str, kind: int, group: int = 0) -> Column:
    """All matches as (start, end, kind, value of the group)."""
    none = F.array().cast(_SPAN)

    def place(matches: Column) -> Column:
        gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(matches))
        values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else matches
        each = F.arrays_zip(gaps.alias("gap"), matches.alias("whole"), values.alias("value"))
        start = F.struct(F.lit(0).cast("bigint").alias("at"), none.alias("out"))

        def step(done: Column, m: Column) -> Column:
            begin = done["at"] + F.length(m["gap"])
            end = begin + F.length(m["whole"])
            span = F.struct(begin.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), m["value"].alias("value"))
            return F.struct(end.alias("at"), F.concat(done["out"], F.array(span)).alias("out"))

        return F.when(F.size(matches) == 0, none).otherwise(
            F.aggregate(each, start, step, lambda done: done["out"])
        )

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), place)


def candidate_spans(text: Column) -> Column:
    """Base spans and opaque strings outside them, by start, then kind."""
    assign = F.filter(_spans(text, ASSIGN, 0, 2), lambda s: F.length(s["value"]) >= ASSIGN_LEAST)
    access = F.filter(_spans(text, ACCESS, 1), lambda s: F.length(s["value"]) >= ACCESS_LEAST)
    base = F.concat(assign, access, _spans(text, HEX, 2))

    def mixed(s: Column) -> Column:
        return s["value"].rlike("[0-9]") & s["value"].rlike("[a-z]") & s["value"].rlike("[A-Z]")

    opaque = F.filter(_spans(text, OPAQUE, 3), mixed)

    def outside(found: Column) -> Column:
        inside = lambda s: F.exists(found, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
        return F.sort_array(F.concat(found, F.filter(opaque, lambda s: ~inside(s))))

    return let(base, outside)


def _looks_random(value: Column) -> Column:
    return (F.size(F.array_distinct(F.split(value, ""))) >= LIVE_CHARACTERS) & ~value.rlike(PLACEHOLDER)


def find_secrets(
    docs: DataFrame, carry: list[str], text: str = "text", repository: tuple = ("source", "lang"), owner: str = "source"
) -> DataFrame:
    """``carry`` and ``spans``: start, kind, end, repositories, owners, verdict; one row per row of ``docs``.

    A repository is named by the columns ``repository``, its owner by ``owner``.
    """
    spans = F.transform(
        candidate_spans(F.coalesce(F.col(text), F.lit(""))),
        lambda s: F.struct(
            s["start"].alias("start"),
            s["kind"].alias("kind"),
            s["end"].alias("end"),
            F.sha2(s["value"], 256).alias("hash"),
            _looks_random(s["value"]).alias("random"),
        ),
    )
    kept = F.struct(*[F.col(c) for c in carry]).alias("_kept")
    found = stage(
        docs.select(
            F.monotonically_increasing_id().alias("_row"),
            kept,
            F.struct(*[F.col(c) for c in repository]).alias("_repository"),
            F.struct(F.col(owner)).alias("_owner"),
            F.xxhash64(F.col(text)).alias("_text"),
            spans.alias("_spans"),
        )
    )
    uses = found.where(F.size("_spans") > 0).select("_row", "_repository", "_owner", "_text", F.inline("_spans"))
    counts = (
        uses.groupBy("hash", "_text")
        .agg(F.min(F.struct("_owner", "_repository")).alias("_place"))
        .select("hash", "_place.*")
        .groupBy("hash", "_owner", "_repository")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("hash", "_owner")
        .agg(F.count(F.lit(1)).alias("repositories"))
        .groupBy("hash")
        .agg(F.sum("repositories").alias("repositories"), F.count(F.lit(1)).alias("owners"))
    )
    many = (F.col("owners") >= EXAMPLE_OWNERS) | (F.col("repositories") >= EXAMPLE_REPOSITORIES)
    verdict = (
        F.when(F.col("random"), F.when(F.col("owners") == 1, "live").otherwise("shared"))
        .when(many, "example")
        .otherwise("unclear")
    )
    told = F.col("verdict") == "live"
    told |= (F.col("verdict") == "shared") & (F.col("owners") < EXAMPLE_OWNERS)
    judged = uses.join(counts, "hash").withColumn("verdict", verdict)
    span = F.struct("start", "kind", "end", "repositories", "owners", "verdict")
    # a row's spans are those of one text; its kept columns come along once
    with_spans = (
        judged.where((F.col("kind") != KINDS.index("opaque")) | told)
        .groupBy("_row")
        .agg(F.sort_array(F.collect_list(span)).alias("spans"))
    )
    none = F.array().cast(with_spans.schema["spans"].dataType)
    bearing = found.where(F.size("_spans") > 0).join(with_spans, "_row", "left")
    plain = found.where(F.size("_spans") == 0)
    both = bearing.select("_kept", F.coalesce("spans", none).alias("spans")).unionByName(
        plain.select("_kept", none.alias("spans"))
    )
    return both.select("_kept.*", "spans")


def spans_text(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def mask(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """``text`` with each span, or run of overlapping spans, replaced by ``mark``. Spans in order of start."""
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))

    def step(done: Column, s: Column) -> Column:
        gap = F.substring(text, (done["at"] + 1).cast("int"), (s["start"] - done["at"]).cast("int"))
        out = F.when(s["start"] >= done["at"], F.concat(done["out"], gap, F.lit(mark))).otherwise(done["out"])
        return F.struct(F.greatest(done["at"], s["end"]).alias("at"), out.alias("out"))

    def rest(done: Column) -> Column:
        return F.concat(done["out"], F.substring(text, (done["at"] + 1).cast("int"), F.length(text)))

    return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(spans, start, step, rest))
