"""Pattern matches with their places, in Spark expressions that take linear time.

A pattern's matches and the pieces between them come from one engine, so the lengths
of both add up to the places. Places count code points from 0, the end is exclusive.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Elements that a running sum adds one by one; longer arrays go in blocks of so many.
BLOCK = 512


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with ``value`` worked out once per row."""
    return F.transform(F.array(value), body)[0]


def running_sums(lengths: Column) -> Column:
    """Sum of the elements before each one, block by block."""

    def total(part: Column) -> Column:
        return F.aggregate(part, F.lit(0), lambda a, b: a + b)

    def before(part: Column) -> Column:
        return F.transform(part, lambda _, i: total(F.slice(part, F.lit(1), i)))

    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.greatest(F.size(lengths), F.lit(1)) - 1) / BLOCK).cast("int")),
        lambda k: F.slice(lengths, k * BLOCK + 1, F.lit(BLOCK)))
    return let(blocks, lambda b: let(F.transform(b, total), lambda sums: F.flatten(
        F.zip_with(b, before(sums), lambda part, base: F.transform(before(part), lambda x: base + x)))))


MATCH = "array<struct<start:int,end:int,match:string,before:string>>"


def matches(text: Column, pattern: str) -> Column:
    """All leftmost non-overlapping matches as structs of ``start``, ``end``, ``match``, and
    ``before``, the text since the previous match. The pattern must not match nothing."""
    regex = F.lit(pattern)

    def placed(found: Column) -> Column:
        return let(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found)), lambda pieces: let(
            running_sums(F.zip_with(pieces, found, lambda p, m: F.length(p) + F.length(m))),
            lambda bases: F.transform(found, lambda m, i: let(
                bases[i] + F.length(pieces[i]), lambda start: F.struct(
                    start.alias("start"), (start + F.length(m)).alias("end"), m.alias("match"),
                    pieces[i].alias("before"))))))

    return let(F.regexp_extract_all(text, regex, 0), lambda found: F.when(
        F.size(found) > 0, placed(found)).otherwise(F.array().cast(MATCH)))


def in_order(spans: Column, kinds: list[str]) -> Column:
    """Spans (structs with ``kind`` and ``start``) by start, then by the kinds' order."""
    rank = F.array(*[F.lit(k) for k in kinds])
    return F.transform(
        F.array_sort(F.transform(spans, lambda s: F.struct(
            s["start"].alias("a"), F.array_position(rank, s["kind"]).alias("b"), s.alias("span")))),
        lambda x: x["span"])


def as_text(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
