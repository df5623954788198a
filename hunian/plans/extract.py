"""Extract job: new listings out of fetched pages."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import keys, pages as P
from ..sources import listings, sinks, titles
from ..sources.files import fresh, remove
from ..sources.pages import fetched, newest
from .store import Selection, Store, raw_page, select_batch


#: Up to this many urls go to the scan as literals.
LITERALS = 200


def search_pages(
    spark: SparkSession, pages: DataFrame, site: P.Site, batch: Selection, version: str | None = None,
    searches: DataFrame | None = None,
) -> DataFrame:
    """Newest fetch of each search page of the batch, with ``province`` and ``page``.

    The urls of a usual batch, one a province, go to the scan as literals, so Parquet skips row groups by them; more are joined.
    Where a province's page is spread over many addresses, ``searches`` (``province``, ``url``) has all of them; the waiting
    provinces' are joined and stay off the driver.
    """
    if searches is not None:
        targets = searches.filter(F.col("province").isin(batch.provinces)).select(
            "province", F.lit(batch.page).alias("page"), "url").distinct()
    else:
        rows = [(p, batch.page, site.search_url(p, batch.page)) for p in batch.provinces]
        targets = spark.createDataFrame(rows, "province string, page int, url string")
        if len(rows) <= LITERALS:
            pages = pages.filter(F.col("url").isin([url for _, _, url in rows]))
    found = fetched(pages, targets.select("url").distinct(), version)
    return newest(found.filter(F.col("html").isNotNull()), "url", version).join(targets, "url")


def new_cards(
    searched: DataFrame, known: DataFrame | Callable[[DataFrame], DataFrame], site: P.Site, scratch: str, key: str = "judul_iklan",
) -> DataFrame:
    """Cards whose title is not known: ``province``, ``page``, ``link``.

    Search pages are parsed a single time; later steps read the small table in ``scratch``. The long
    list of known titles is first cut to those on the cards, map-side while the cards are few. ``known`` may also be
    a function that gives the known ones among some distinct titles.
    """
    path = fresh(scratch, "cards")
    cards = P.page_cards(searched.select("province", "page", "html"), site).select("province", "page", key, "link")
    sinks.append_rows(cards, path, [])
    cards = searched.sparkSession.read.schema(f"province string, page int, {key} string, link string").parquet(path)
    asked = cards.select(key).distinct()
    met = known(asked) if callable(known) else known.select(key).join(asked, key, "left_semi")
    return keys.keep_new(cards, met, key).select("province", "page", "link")


def new_listings(
    searched: DataFrame, pages: DataFrame, known: DataFrame | Callable[[DataFrame], DataFrame], site: P.Site, scratch: str,
    now: datetime | None = None, version: str | None = None,
) -> DataFrame:
    """Raw listings of all new cards, one row per card that has a fetched page.

    Of several fetches of a url the one with the largest ``version`` counts. Only pages that cards ask for are parsed, and their
    fields are cut out of the markup before rows are gathered by url.
    """
    cards = new_cards(searched, known, site, scratch)
    keep = (version,) if version else ()
    wanted = fetched(pages, cards.select(F.col("link").alias("url")).distinct(), version)
    details = P.detail_records(wanted.select("url", "html", *keep), site, now, keep=keep)
    details = newest(details, "link_rumah123", version).drop("provinsi", *keep)
    joined = cards.join(details, F.col("link") == F.col("link_rumah123"))
    return joined.withColumn("provinsi", F.col("province")).select(*listings.STORED.names)


def extract_page(
    spark: SparkSession, store: Store, pages: DataFrame, site: P.Site, now: datetime | None = None,
    version: str | None = None, searches: DataFrame | None = None,
) -> int:
    """Append the batch's new listings to the raw store; returns how many.

    Rows of an earlier run of the page stay, and their titles are known now: a
    second run adds nothing. ``version`` names the column of ``pages`` that grows with every fetch,
    ``searches`` is a table of search pages as in ``search_pages``.
    With a title store only the buckets that may hold a card's title are read, and the page's own rows, as a run that died
    may not have added their titles.
    """
    batch = select_batch(spark, store)
    if not batch.provinces:
        return 0
    if store.titles:
        own = raw_page(spark, store, batch)

        def known(cards: DataFrame) -> DataFrame:
            stored = titles.known_among(spark, store.titles, cards)
            return stored if own is None else keys.union_keys([stored, own.join(cards, "judul_iklan", "left_semi")], "judul_iklan")
    elif store.raw_format == "csv":
        found = listings.read_titles_csv(spark, store.raw_listings)
        known = spark.createDataFrame([], "judul_iklan string") if found is None else found.select("judul_iklan")
    else:
        known = listings.read_all(spark, store.raw_listings).select("judul_iklan")
    scratch = fresh(store.scratch_folder, "extract")
    searched = search_pages(spark, pages, site, batch, version, searches)
    rows = new_listings(searched, pages, known, site, scratch, now, version)
    if store.raw_format == "csv":
        count = _into_files(spark, store, batch, rows, scratch)
    else:
        count = sinks.append_rows(rows, store.raw_listings, ["province", "page"])
    remove(spark, scratch)
    if store.titles and (own := raw_page(spark, store, batch)) is not None:
        titles.add(spark, store.titles, own)
    return count


def index_titles(spark: SparkSession, store: Store) -> None:
    """Put the titles of all stored listings into the title store; for a history from before it."""
    stored = listings.read_titles_csv(spark, store.raw_listings) if store.raw_format == "csv" else listings.read_all(spark, store.raw_listings)
    if stored is not None:
        titles.add(spark, store.titles, stored)


def _into_files(spark: SparkSession, store: Store, batch: Selection, rows: DataFrame, scratch: str) -> int:
    """Add rows to the page files of their provinces; a file that is there keeps its rows."""
    path = fresh(scratch, "rows")
    count = sinks.append_rows(rows, path, [])
    rows = spark.read.schema(listings.STORED).parquet(path)
    stored = raw_page(spark, store, batch)
    if stored is not None:
        touched = stored.join(rows.select("province").distinct(), "province", "left_semi")
        rows = keys.union_pages([touched, rows])
    name = F.format_string("%s/page_%d_%s.csv", "province", "page", "province")
    sinks.write_csv_files(
        rows.withColumn("_into", name).drop("province", "page"), store.raw_listings, F.col("_into"), scratch)
    return count
