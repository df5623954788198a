"""Facility counts per district and category."""

from __future__ import annotations

from datetime import datetime
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import iso_text, load_time
from ..schemas import FACILITY_FILTERS


def category_counts(filters=FACILITY_FILTERS, whole_value: bool = False) -> list[Column]:
    """One aggregate per category: the sum over its filters of the matching rows.

    A row that matches two filters of a category counts twice. Patterns match
    anywhere in a tag (``park`` in ``parking``) unless ``whole_value``.
    """
    by_category: dict[str, list[Column]] = {}
    for category, tag, pattern in filters:
        wanted = f"^(?:{pattern})$" if whole_value else pattern
        by_category.setdefault(category, []).append(F.count_if(F.col(tag).rlike(wanted)))
    return [reduce(add, counts).alias(category) for category, counts in by_category.items()]


def places_in(places: DataFrame, country: str, admin_level: int = 6) -> DataFrame:
    """Places whose district area is of the given level inside the country."""
    return places.filter((F.col("country") == country) & (F.col("admin_level") == admin_level))


def count_places(
    places: DataFrame, key: str = "kecamatan", filters=FACILITY_FILTERS, whole_value: bool = False
) -> DataFrame:
    """Wide counts per district.

    Aggregated before any join: the partial counts leave one row per district
    and task, so a district with a third of all places is no hot key later on.
    """
    counts = category_counts(filters, whole_value)
    return places.filter(F.col(key).isNotNull()).groupBy(key).agg(*counts)


def filter_rows(filters=FACILITY_FILTERS) -> list[tuple[int, str, str, str]]:
    """``filter``, ``category``, ``tag`` and ``literal`` of every alternative of the filters, numbered."""
    return [(n, category, tag, literal) for n, (category, tag, pattern) in enumerate(filters) for literal in pattern.split("|")]


def count_by_table(places: DataFrame, filters: DataFrame, key: str = "kecamatan", whole_value: bool = False) -> DataFrame:
    """``key``, ``category`` and ``n``: like ``count_places`` for filters that are a table, however many there are.

    ``filters`` has ``filter``, ``category``, ``tag`` and ``literal``, a text that is found anywhere in the tag unless
    ``whole_value``; a filter of several literals counts a place once. Places are first counted by key and tag value. Of the distinct
    values, which are few, each part as long as some literal is looked up in the table, so no pattern runs for each
    filter and a thousand filters cost what nine do. Categories without a match have no row.
    """
    tags = [r[0] for r in filters.select("tag").distinct().collect() if r[0] in places.columns]
    each = places.filter(F.col(key).isNotNull()).select(key, F.inline(F.array(*[
        F.struct(F.lit(t).alias("tag"), F.col(t).alias("value")) for t in tags]))).filter("value is not null")
    counted = each.groupBy(key, "tag", "value").agg(F.count("*").alias("n"))
    values = each.select("tag", "value").distinct()
    literals = filters.select("filter", "category", F.col("tag").alias("_tag"), "literal").filter("literal <> ''").distinct()
    if whole_value:
        parts = values.withColumn("part", F.col("value"))
    else:
        lengths = literals.groupBy("_tag").agg(F.collect_set(F.length("literal")).alias("sizes"))
        sized = values.join(lengths, F.col("tag") == F.col("_tag")).select("tag", "value", F.explode("sizes").alias("size"))
        parts = sized.filter(F.length("value") >= F.col("size")).select(
            "tag", "value", F.explode(F.transform(F.sequence(F.lit(1), F.length("value") - F.col("size") + 1), lambda at: F.substr(
                "value", at, F.col("size")))).alias("part"))
    met = parts.join(literals, (F.col("tag") == F.col("_tag")) & (F.col("part") == F.col("literal")))
    hits = met.select("tag", "value", "filter", "category").distinct().groupBy("tag", "value", "category").agg(F.count("*").alias("filters"))
    return counted.join(hits, ["tag", "value"]).groupBy(key, "category").agg(F.sum(F.col("n") * F.col("filters")).alias("n"))


def counts_for(keys: DataFrame, counts: DataFrame, key: str = "kecamatan") -> DataFrame:
    """Counts of every key in ``keys`` (unique); a district without places gets zeros."""
    names = [c for c in counts.columns if c != key]
    return keys.join(counts, key, "left").select(
        *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in names], key)


def facility_rows(counts: DataFrame, now: datetime | None) -> DataFrame:
    """Add load time and status; a district lacking any count is left out."""
    return counts.na.drop().withColumns({"timestamp": iso_text(load_time(now)), "status": F.lit("success")})
