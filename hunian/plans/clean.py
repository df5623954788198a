"""Clean job: typed listings and facilities of the current page, then the state."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..operators import clean as C, keys
from ..sources import sinks
from ..sources.files import CSV_READ
from ..streaming import progress
from .store import Store, raw_facilities, raw_page, select_batch


@dataclass(frozen=True)
class CleanResult:
    page: int
    listings: int
    facilities: int


def clean_page(spark: SparkSession, store: Store, allow_whole: bool = False) -> CleanResult:
    """Clean one page and advance the progress.

    Both tables are written before the state, and each write replaces its page:
    after an error the state is unchanged and the next run redoes the page.
    """
    batch = select_batch(spark, store)
    listings = facilities = 0
    raw = raw_page(spark, store, batch)
    if raw is not None:
        clean = C.clean_listings(raw.drop("province", "page"), allow_whole)
        listings = sinks.write_page(clean, store.clean_listings, batch.page, store.clean_format)
        # The written page is read back: one narrow column instead of a second
        # pass over the raw data, and nothing is lost with an executor.
        reader = spark.read.schema(clean.schema).options(**CSV_READ if store.clean_format == "csv" else {})
        written = reader.format(store.clean_format).load(
            sinks.page_path(store.clean_listings, batch.page, store.clean_format))
        facilities = _facilities(spark, store, batch.page, keys.distinct_keys(written, "kecamatan"))
    progress.write_progress(progress.advance(batch.state), store.progress)
    return CleanResult(batch.page, listings, facilities)


def _facilities(spark: SparkSession, store: Store, page: int, districts) -> int:
    """Facility rows of the page's districts; without any, no page is written."""
    raw = raw_facilities(spark, store)
    if raw is None:
        return 0
    if store.facilities_format == "bucketed":
        kept = C.clean_facilities(keys.stored_rows(raw, districts, "kecamatan"))
    else:
        kept = keys.keep_known(C.clean_facilities(raw), districts, "kecamatan")
    if store.clean_format == "csv":
        return 0 if kept.isEmpty() else sinks.write_page(kept, store.clean_facilities, page, "csv")
    return sinks.overwrite_partitions(kept.withColumn("page", F.lit(page)), store.clean_facilities, ["page"])
