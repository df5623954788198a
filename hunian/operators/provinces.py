"""Listings with the figures of their province.

Listings name a province by the slug of its page's address, the dimension by its name. The dimension's size decides, by Spark's own
check, whether it is broadcast; then a condition on it also prunes the ``province=`` folders of a stored table while the query runs, so that only
those of the provinces that are left are opened.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def slug(name: Column) -> Column:
    """A province's name as addresses have it: lower case, other characters than letters and digits as one hyphen, none at the ends."""
    return F.trim(F.regexp_replace(F.lower(name), "[^a-z0-9]+", "-"), F.lit("-"))


def with_province(listings: DataFrame, provinces: DataFrame, key: str = "province", name: str = "provinsi") -> DataFrame:
    """``listings`` of the provinces in ``provinces``, with its other columns behind their own.

    ``key`` is the slug column, of a stored table the one it is partitioned by. Filter ``provinces`` first. A slug that two
    names have gives rows for both; listings of a province that is not there are dropped, as null ones are.
    """
    others = [c for c in provinces.columns if c != name and c not in listings.columns]
    figures = provinces.select(slug(F.col(name)).alias("_slug"), *others)
    return listings.join(figures, F.col(key) == F.col("_slug")).drop("_slug")
