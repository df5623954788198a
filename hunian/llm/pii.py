"""Personal data: patterns propose, checks confirm, context words weigh.

A pattern proposes spans of a kind; a check (number parts, digit counts, Luhn, modulo 97) drops
those that fail; the words before a span raise or lower its score. All of it are Spark
expressions within the row: nothing is shuffled, and a text of any length is read whole.

Null and empty texts have no spans. Kinds are found independently and may overlap.
Repeated rows give repeated results. ``find`` returns an array column, so no column name of the
input can clash.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import text_or_empty
from .spans import as_text, in_order, let, matches


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _octets(match: Column) -> Column:
    """Every part at most 255, with any number of leading zeros."""
    return F.forall(F.split(match, r"\."), lambda p: let(
        F.regexp_replace(p, "^0+(?=[0-9])", ""), lambda n: (F.length(n) <= 3) & (n.try_cast("int") <= 255)))


def luhn(match: Column) -> Column:
    """Whether the digits pass Luhn's check: every second one from the right doubled."""
    return let(F.reverse(F.filter(F.split(_digits(match), ""), lambda d: d != "")), lambda digits: F.aggregate(
        F.transform(digits, lambda d, i: let(
            d.cast("int") * (1 + i % 2), lambda v: v - F.when(v > 9, 9).otherwise(0))),
        F.lit(0), lambda a, b: a + b) % 10 == 0)


def mod_97(match: Column) -> Column:
    """Whether an account number leaves 1 by 97: first four to the end, letters from 10 on."""
    plain = F.upper(F.regexp_replace(match, " ", ""))
    turned = F.concat(F.substr(plain, F.lit(5)), F.substring(plain, 1, 4))
    return let(F.filter(F.split(turned, ""), lambda c: c != ""), lambda letters: F.aggregate(
        letters, F.lit(0), lambda left, c: F.when(
            c.between("0", "9"), (left * 10 + c.try_cast("int")) % 97
        ).otherwise((left * 100 + F.ascii(c) - 55) % 97)) == 1)


def _count(match: Column, least: int, most: int) -> Column:
    return F.length(_digits(match)).between(least, most)


@dataclass(frozen=True)
class Kind:
    """A kind of personal data: its pattern, its check, its score and the words that support it."""

    name: str
    pattern: str
    check: Callable[[Column], Column] | None
    score: float
    support: str


# A run of the first character class can only begin where the class begins or the previous match ended;
# possessive groups neither go back nor recurse. Both give the same matches as the plain patterns.
BASE = (
    Kind("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         None, 0.9, "mail|contact|write"),
    Kind("ip", r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", _octets, 0.6, r"\bip\b|address|host|server"),
    Kind("card", r"(?:(?<![0-9])|\G)[0-9](?:[\x20-]?[0-9]){11,}+",
         lambda m: _count(m, 12, 19) & luhn(m), 0.7, "card|visa|credit|pay|account"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: _count(m, 9, 15), 0.6, "phone|call|tel|mobile|fax"),
)
#: What this method adds to the base kinds.
ADDED = (
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}+(?![A-Za-z0-9])", mod_97, 0.9,
         "iban|bank|account|transfer"),
)
#: Code points before a span that are searched for supporting words, and what those words change.
CONTEXT, RAISED = 40, 0.2
#: Words that say a number is something else, and what they change.
AGAINST, LOWERED = r"\border\b|invoice|isbn|version|serial", -0.3


def find(text: Column, kinds: tuple[Kind, ...] = BASE + ADDED) -> Column:
    """Array of ``kind, start, end, score`` of one text, by start and then by the order of ``kinds``."""

    def of_kind(kind: Kind) -> Column:
        found = matches(text, kind.pattern)
        if kind.check:
            found = F.filter(found, lambda m: kind.check(m["match"]))

        def scored(m: Column) -> Column:
            near = F.lower(F.right(m["before"], F.lit(CONTEXT)))
            change = F.when(near.rlike(kind.support), RAISED).when(near.rlike(AGAINST), LOWERED).otherwise(0.0)
            return F.struct(
                F.lit(kind.name).alias("kind"), m["start"].alias("start"), m["end"].alias("end"),
                F.round(F.least(F.lit(1.0), F.lit(kind.score) + change), 2).alias("score"))

        return F.transform(found, scored)

    return in_order(F.concat(*[of_kind(k) for k in kinds]), [k.name for k in kinds])


def redact(text: Column, spans: Column) -> Column:
    """The text with each span, or run of overlapping ones, replaced by its first kind in brackets."""
    empty = F.array().cast("array<struct<kind:string,start:int,end:int>>")
    merged = F.aggregate(spans, empty, lambda done, s: F.when(
        (F.size(done) > 0) & (F.get(done, F.size(done) - 1)["end"] > s["start"]),
        F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(let(
            F.get(done, F.size(done) - 1), lambda last: F.struct(
                last["kind"].alias("kind"), last["start"].alias("start"),
                F.greatest(last["end"], s["end"]).alias("end")))))
    ).otherwise(F.concat(done, F.array(F.struct(
        s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))))))

    def rebuilt(cuts: Column) -> Column:
        parts = F.transform(cuts, lambda c, i: let(
            F.when(i > 0, F.get(cuts, i - 1)["end"]).otherwise(0), lambda at: F.concat(
                F.substr(text, at + 1, c["start"] - at), F.lit("["), F.upper(c["kind"]), F.lit("]"))))
        return F.concat(F.array_join(parts, ""), F.substr(text, F.get(cuts, F.size(cuts) - 1)["end"] + 1))

    return F.when(F.size(spans) == 0, text).otherwise(let(merged, rebuilt))


def masked(text: Column) -> Column:
    """The text with all that ``find`` finds replaced."""
    return let(find(text), lambda spans: redact(text, spans))


def report(docs: DataFrame) -> DataFrame:
    """Spans of every document: counts per base kind, a digest of the base spans, all spans."""
    base = [k.name for k in BASE]

    def of(*kinds: str) -> Column:
        return F.filter("_spans", lambda s: s["kind"].isin(*kinds))

    found = docs.select("doc_id", find(text_or_empty()).alias("_spans"))
    return found.select(
        "doc_id", *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in base],
        F.sha2(as_text(of(*base)), 256).alias("base_sha256"), as_text(F.col("_spans")).alias("spans"),
        F.transform("_spans", lambda s: s["score"]).alias("scores"))
