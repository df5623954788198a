"""The chain extract, count, clean; when to run it is the caller's business."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from ..operators.pages import Site
from .clean import CleanResult, clean_page
from .count import count_districts
from .extract import extract_page
from .store import Store


@dataclass(frozen=True)
class BatchResult:
    new_listings: int
    new_facilities: int
    clean: CleanResult


def run_batch(
    spark: SparkSession, store: Store, pages: DataFrame, places: DataFrame, site: Site,
    country: str = "Indonesia", now: datetime | None = None, version: str | None = None,
    allow_whole: bool = False, whole_value: bool = False, searches: DataFrame | None = None,
) -> BatchResult:
    """One page, all steps. An error in any step goes to the caller."""
    new = extract_page(spark, store, pages, site, now, version, searches)
    counted = count_districts(spark, store, places, country, now, whole_value=whole_value)
    return BatchResult(new, counted, clean_page(spark, store, allow_whole))
