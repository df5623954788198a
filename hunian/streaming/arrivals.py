"""New listings out of fetched pages as they arrive: a stream in place of page-by-page batches.

Files of pages (``url``, ``html``) appear in a folder. Each micro-batch adds its cards, its detail records and the listings that
they complete, a card with the page behind its link: cards of the batch with details that have come so far, and earlier cards with
details of the batch. So a listing comes out once, whichever of its two pages is first.

Every batch writes folders named by its number and replaces what is there, and reads earlier batches only. So a run that is
killed anywhere, also between a write and the stream's own commit, does the same batch again and leaves the same rows. Offsets are in the
``checkpoint`` folder. Cards whose title is known, among titles stored before the stream began, are dropped.
A url should arrive once; of a second fetch each gives a row.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import keys, pages as P
from ..sources.files import file_system
from ..sources.listings import STORED

PAGES = "url string, html string"


@dataclass(frozen=True)
class Arrivals:
    """Where the stream keeps its tables; each has a folder ``batch=<n>`` for each batch."""

    cards: str
    details: str
    listings: str
    checkpoint: str

    @classmethod
    def under(cls, root: str) -> Arrivals:
        return cls(*[f"{root}/{n}" for n in ("cards", "details", "listings", "checkpoint")])


def of_search_url(url: Column, site: P.Site) -> tuple[Column, Column]:
    """Province and page of a search page's url, null for other urls."""
    pattern = re.escape(site.base_url + site.search_path).replace(r"\{province\}", "([^/?#]+)").replace(r"\{page\}", "([0-9]+)")
    # The two in the order of the path.
    first, second = (1, 2) if site.search_path.index("{province}") < site.search_path.index("{page}") else (2, 1)
    is_search = url.rlike(f"^{pattern}$")
    return (F.when(is_search, F.regexp_extract(url, f"^{pattern}$", first)),
            F.when(is_search, F.regexp_extract(url, f"^{pattern}$", second).try_cast("int")))


def _write(rows: DataFrame, root: str, batch: int) -> None:
    rows.write.mode("overwrite").parquet(f"{root}/batch={batch}")


def _before(spark: SparkSession, root: str, schema: str, batch: int) -> DataFrame:
    """Rows of the batches before ``batch``."""
    files, at = file_system(spark, root)
    if not files.exists(at):
        return spark.createDataFrame([], f"{schema}, batch long")
    return spark.read.schema(f"{schema}, batch long").parquet(root).filter(F.col("batch") < batch)


def process(
    pages: DataFrame, batch: int, tables: Arrivals, site: P.Site, known: Callable[[DataFrame], DataFrame], now: datetime | None = None,
) -> None:
    """One micro-batch; the same again for the same ``pages`` and number. ``known`` gives the known ones among distinct titles."""
    spark = pages.sparkSession
    province, page = of_search_url(F.col("url"), site)
    fetched = pages.filter(F.col("html").isNotNull()).withColumns({"province": province, "page": page})
    cards = P.page_cards(fetched.filter("province is not null").select("province", "page", "html"), site).select(
        "province", "page", "judul_iklan", "link")
    details = P.detail_records(fetched.filter("province is null").select("url", "html"), site, now).drop("provinsi")
    card_columns, detail_columns = (", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema) for rows in (cards, details))
    _write(cards, tables.cards, batch)
    _write(details, tables.details, batch)
    new_cards = spark.read.schema(card_columns).parquet(f"{tables.cards}/batch={batch}")
    new_details = spark.read.schema(detail_columns).parquet(f"{tables.details}/batch={batch}")
    old_cards = _before(spark, tables.cards, card_columns, batch).drop("batch")
    old_details = _before(spark, tables.details, detail_columns, batch).drop("batch")
    made = []
    # Earlier tables are first cut to the links of the batch, which are few.
    wanted, come = new_cards.select(F.col("link").alias("link_rumah123")).distinct(), new_details.select(F.col("link_rumah123").alias("link")).distinct()
    for a, b in ((new_cards, new_details), (new_cards, old_details.join(wanted, "link_rumah123", "left_semi")),
                 (old_cards.join(come, "link", "left_semi"), new_details)):
        fresh = keys.keep_new(a, known(a.select("judul_iklan").distinct()), "judul_iklan")
        joined = fresh.select("province", "page", "link").join(b, F.col("link") == F.col("link_rumah123"))
        made.append(joined.withColumn("provinsi", F.col("province")).select(*STORED.names))
    _write(keys.union_pages(made), tables.listings, batch)


def follow(
    spark: SparkSession, folder: str, tables: Arrivals, site: P.Site, known: Callable[[DataFrame], DataFrame], now: datetime | None = None,
    files_a_batch: int | None = None,
) -> None:
    """All files that are in ``folder`` and have not been followed yet, then stop; run it again for later ones."""
    options = {"maxFilesPerTrigger": files_a_batch} if files_a_batch else {}
    stream = spark.readStream.schema(PAGES).options(**options).parquet(folder)
    query = stream.writeStream.trigger(availableNow=True).option("checkpointLocation", tables.checkpoint).foreachBatch(
        lambda pages, batch: process(pages, batch, tables, site, known, now)).start()
    query.awaitTermination()


def listings(spark: SparkSession, tables: Arrivals) -> DataFrame:
    """All listings so far, with the ``batch`` they came in."""
    return spark.read.schema(f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in STORED)}, batch long").parquet(tables.listings)
