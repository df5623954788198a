"""Secrets, found with an inverted index of trigrams.

Every rule's regular expression is turned into a Boolean query over the trigrams that each of its matches
must hold. The index has a posting for each of those trigrams and each distinct text that contains it (in lower
case); trigrams no rule asks for are not indexed. Postings are intersected by text, which gives
the rules a text is a candidate of, and only those are run on it. A rule without mandatory
trigrams runs on every text.

Texts are known by a 64-bit hash, so copies share postings; should two texts share a
hash, they share candidates, and the patterns decide. Null and empty texts have no spans.
Repeated rows give repeated results. Extra columns of the input are not read.
"""

from __future__ import annotations

import re._constants as C
import re._parser as parser
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import text_or_empty
from .spans import as_text, in_order, matches


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    keep: Callable[[Column], Column] | None = None


ASSIGN = (r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
# {14,} and {16,} find the very runs of which a plain + keeps the long ones: a run is always matched from
# its beginning to its end. For the assignments a failing match uses up text, so they are checked after.
BASE = (
    Rule("assign", ASSIGN, lambda m: F.length(F.regexp_extract(m, ASSIGN, 2)) >= 12),
    Rule("access", r"AKIA[A-Z0-9]{14,}+"),
    Rule("hex", r"[0-9a-f]{16,}+"),
)
#: What this method adds to the base rules.
ADDED = (
    Rule("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("git_token", r"(?<![A-Za-z0-9])gh[opsur]_[A-Za-z0-9]{36,}+"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}+"),
    Rule("web_token", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+"),
)

#: A query is a trigram, ("all", queries), ("any", queries), or ANYTHING, which every text meets.
ANYTHING = ("all", ())
#: More alternatives than this are not spelled out.
SPELLED = 64


def trigrams(pattern: str) -> str | tuple:
    """Boolean query over lower-case trigrams that every match of ``pattern`` meets."""
    query, _ = _sequence(parser.parse(pattern))
    return query


def _all(queries) -> str | tuple:
    """All of ``queries``; those inside one another are flattened."""
    parts = [p for q in queries for p in (q[1] if isinstance(q, tuple) and q[0] == "all" else (q,))]
    kept = sorted(set(parts), key=repr)
    return kept[0] if len(kept) == 1 else ("all", tuple(kept))


def _any(queries) -> str | tuple:
    """Any of ``queries``; one that asks for more than another does is not needed."""
    asked = {q: frozenset(q[1]) if isinstance(q, tuple) and q[0] == "all" else frozenset([q]) for q in queries}
    kept = sorted((q for q in asked if not any(other < asked[q] for other in asked.values())), key=repr)
    return ANYTHING if not kept else kept[0] if len(kept) == 1 else ("any", tuple(kept))


def _spelled(words: set[str]) -> str | tuple:
    """One of ``words`` occurs."""
    return _any(_all(w[i:i + 3] for i in range(len(w) - 2)) for w in sorted(words))


def _sequence(items) -> tuple[str | tuple, set[str] | None]:
    """Query of a sequence, and all texts it can match if those are few."""
    queries, words, exact = [], {""}, True
    for item in items:
        query, choices = _item(item)
        queries.append(query)
        joined = {w + c for w in words for c in choices} if choices is not None else None
        if joined is not None and len(joined) <= SPELLED:
            words = joined
            continue
        exact = False
        queries.append(_spelled(words))
        words = choices if choices is not None and len(choices) <= SPELLED else {""}
    queries.append(_spelled(words))
    return _all(queries), words if exact else None


def _item(item) -> tuple[str | tuple, set[str] | None]:
    op, value = item
    if op is C.LITERAL:
        return ANYTHING, {chr(value).lower()}
    if op is C.IN and all(kind is C.LITERAL for kind, _ in value):
        return ANYTHING, {chr(c).lower() for _, c in value}
    if op is C.SUBPATTERN:
        return _sequence(value[3])
    if op is C.ATOMIC_GROUP:
        return _sequence(value)
    if op is C.BRANCH:
        made = [_sequence(branch) for branch in value[1]]
        words = None if any(w is None for _, w in made) else set().union(*[w for _, w in made])
        return _any(q for q, _ in made), words
    if op in (C.MAX_REPEAT, C.MIN_REPEAT, C.POSSESSIVE_REPEAT):
        least, most, inner = value
        query, words = _sequence(inner)
        if (least, most) == (0, 1) and words is not None:
            return ANYTHING, words | {""}
        return (query if least else ANYTHING), None
    if op in (C.AT, C.ASSERT, C.ASSERT_NOT):
        return ANYTHING, {""}
    return ANYTHING, None


def _needed(query) -> set[str]:
    return {query} if isinstance(query, str) else set().union(*map(_needed, query[1]), set())


def _met(query, grams: Column) -> Column:
    if isinstance(query, str):
        return F.array_contains(grams, query)
    parts = [_met(q, grams) for q in query[1]]
    return reduce(lambda a, b: a & b if query[0] == "all" else a | b, parts)


def text_key(text: Column) -> Column:
    return F.xxhash64(text)


def _grams(rules: tuple[Rule, ...]) -> list[str]:
    """The trigrams that some rule asks for."""
    return sorted(set().union(*[_needed(trigrams(r.pattern)) for r in rules]))


def postings(docs: DataFrame, rules: tuple[Rule, ...], text: str = "text") -> DataFrame:
    """The index: ``gram``, ``key`` for each trigram the rules ask for and each text that has it."""
    plain = docs.select(text_or_empty(text).alias("text"))
    lower = plain.select(text_key(F.col("text")).alias("key"), F.lower("text").alias("lower"))
    present = F.array(*[F.when(F.contains("lower", F.lit(g)), F.lit(g)) for g in _grams(rules)])
    return lower.select("key", F.explode(F.array_compact(present)).alias("gram"))


def candidates(index: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """``key`` and the kinds whose queries its postings meet; rules that need no trigram are not in it."""
    queries = {r.kind: trigrams(r.pattern) for r in rules}
    grams = index.groupBy("key").agg(F.collect_set("gram").alias("grams"))  # at most as many as the rules name
    kinds = F.array_compact(F.array(*[
        F.when(_met(q, F.col("grams")), F.lit(k)) for k, q in queries.items() if q != ANYTHING]))
    return grams.select("key", kinds.alias("kinds")).filter(F.size("kinds") > 0)


def find(docs: DataFrame, rules: tuple[Rule, ...] = BASE + ADDED) -> DataFrame:
    """``doc_id`` and ``found``, the spans (``kind``, ``start``, ``end``) of each row by start and rule."""
    found = candidates(postings(docs, rules), rules)
    texts = docs.select("doc_id", text_or_empty().alias("text")).withColumn("lower", F.lower("text"))
    # Only texts with a posting have candidates to ask for; the others stay where they are.
    met = reduce(lambda a, b: a | b, [F.contains("lower", F.lit(g)) for g in _grams(rules)], F.lit(False))
    # By two hashes, so that both sides of the join come straight from a shuffle and AQE can split a text with very many copies.
    some = texts.filter(met).select("doc_id", "text", text_key(F.col("text")).alias("key")).withColumn("again", F.xxhash64(F.lit(1), "key"))
    found = found.select(F.col("key").alias("_key"), F.xxhash64(F.lit(1), "key").alias("_again"), "kinds")
    joined = some.join(found, (F.col("key") == F.col("_key")) & (F.col("again") == F.col("_again")), "left").select("doc_id", "text", "kinds")
    others = texts.filter(~met).select("doc_id", "text", F.lit(None).cast("array<string>").alias("kinds"))
    scanned = {r.kind for r in rules if trigrams(r.pattern) == ANYTHING}

    def of_rule(rule: Rule) -> Column:
        made = matches(F.col("text"), rule.pattern)
        if rule.keep:
            made = F.filter(made, lambda m: rule.keep(m["match"]))
        made = F.transform(made, lambda m: F.struct(
            F.lit(rule.kind).alias("kind"), m["start"].alias("start"), m["end"].alias("end")))
        if rule.kind in scanned:
            return made
        return F.when(F.array_contains("kinds", rule.kind), made).otherwise(
            F.array().cast("array<struct<kind:string,start:int,end:int>>"))

    spans = in_order(F.concat(*[of_rule(r) for r in rules]), [r.kind for r in rules])
    return joined.union(others).select("doc_id", spans.alias("found"))


def report(docs: DataFrame) -> DataFrame:
    """Spans of every document: counts per base rule, a digest of the base spans, all spans."""
    base = [r.kind for r in BASE]

    def of(*kinds: str) -> Column:
        return F.filter("found", lambda s: s["kind"].isin(*kinds))

    return find(docs).select(
        "doc_id", *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in base],
        F.sha2(as_text(of(*base)), 256).alias("base_sha256"), as_text(F.col("found")).alias("spans"))
