"""Count job: facility counts of districts that have none yet."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import facilities as A, keys
from ..schemas import RAW_FACILITY
from ..sources import bucketed, sinks
from ..sources.files import file_name
from .store import Store, page_districts, raw_facilities, raw_page, select_batch


def count_districts(
    spark: SparkSession, store: Store, places: DataFrame, country: str = "Indonesia", now: datetime | None = None,
    **options,
) -> int:
    """Append a row for every district of the batch without one; returns how many.

    ``places`` has ``country``, ``admin_level``, ``kecamatan`` and the tag columns.
    """
    batch = select_batch(spark, store)
    raw = raw_page(spark, store, batch)
    if raw is None:
        return 0
    wanted = page_districts(raw)
    stored = raw_facilities(spark, store)
    if stored is not None:
        wanted = keys.missing_keys(wanted, stored, "kecamatan")
    if wanted.isEmpty():
        return 0
    # Only places of wanted districts are searched; patterns are the dear part.
    near = keys.keep_known(A.places_in(places, country), wanted, "kecamatan")
    counts = A.count_places(near, **options)
    rows = A.facility_rows(A.counts_for(wanted, counts), now)
    text = rows.select(*[F.col(c).cast("string").alias(c) for c in RAW_FACILITY.names])
    if store.facilities_format == "bucketed":
        counted, written = sinks.observed(text)
        bucketed.append(counted, store.raw_facilities, "kecamatan")
        return written()
    if store.raw_format == "csv":
        # The district is read from its column; its file only has to be its own.
        name = F.concat(file_name(F.col("kecamatan")), F.lit(".csv"))
        return sinks.write_csv_files(text, store.raw_facilities, name, store.scratch_folder, parts=False)
    return sinks.append_rows(text, store.raw_facilities, [])
