"""Where the tables of the jobs are."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..operators import keys
from ..schemas import PROGRESS, RAW_FACILITY
from ..sources import bucketed, facilities, listings, sinks
from ..streaming import progress


@dataclass(frozen=True)
class Store:
    """Folders of one deployment.

    ``raw_format`` is ``parquet``, or ``csv`` for a tree of page and district files. ``titles`` is a title
    store, if there is one; without it every extract run reads the titles of all stored listings. ``facilities_format`` is that of the
    raw facilities where it differs: ``bucketed`` for a table bucketed by district, which joins do not move.
    """

    raw_listings: str
    raw_facilities: str
    clean_listings: str
    clean_facilities: str
    progress: str
    raw_format: str = "parquet"
    clean_format: str = "parquet"
    scratch: str = ""
    titles: str = ""
    facilities_format: str = ""

    @classmethod
    def under(cls, root: str, **kwargs) -> Store:
        names = ("raw_listings", "raw_facilities", "clean_listings", "clean_facilities", "progress")
        return cls(*[f"{root}/{n}" for n in names], **{"scratch": f"{root}/_scratch", **kwargs})

    @property
    def scratch_folder(self) -> str:
        """Where jobs keep what they need until they are done; beside the raw listings if none is named."""
        return self.scratch or f"{self.raw_listings}_scratch"


@dataclass(frozen=True)
class Selection:
    """The batch: its page, the provinces waiting at it and the whole state."""

    page: int
    provinces: list[str]
    state: DataFrame


def select_batch(spark: SparkSession, store: Store) -> Selection:
    """Read the progress document, once: it is one row and names each province once."""
    row: Row = progress.newest_state(spark, store.progress)
    state = spark.createDataFrame([(row["current_page"], row["provinces"])], PROGRESS)
    waiting = sorted(p for p, page in row["provinces"].items() if page == row["current_page"])
    return Selection(row["current_page"], waiting, state)


def raw_page(spark: SparkSession, store: Store, batch: Selection) -> DataFrame | None:
    """Raw listings of the batch; None if no selected province has any.

    The province names go into the paths, so only those folders are opened.
    """
    read = listings.read_page_csv if store.raw_format == "csv" else listings.read_page
    return read(spark, store.raw_listings, batch.provinces, batch.page)


def raw_facilities(spark: SparkSession, store: Store) -> DataFrame | None:
    if store.facilities_format == "bucketed":
        return bucketed.attach(spark, store.raw_facilities, RAW_FACILITY, "kecamatan")
    read = facilities.read_facilities_csv if store.raw_format == "csv" else facilities.read_facilities
    return read(spark, store.raw_facilities)


def page_districts(raw: DataFrame) -> DataFrame:
    return keys.distinct_keys(raw, "kecamatan")


def adopt_csv_tree(spark: SparkSession, store: Store, target: Store, split: str = "") -> tuple[int, int]:
    """Copy the raw CSV files of ``store`` into the Parquet tables of ``target``.

    All columns are kept. A file that lacks a required column or cannot be read raises. With ``split``, a folder, bad rows of
    page files are left there instead, with their file and the reason, and only good ones are copied. Pages that
    are there already are replaced and districts that are there already are left, so a second call changes nothing.
    """
    if split:
        raw = listings.read_good_rows(spark, store.raw_listings, split)
    else:
        raw = listings.read_all_csv(spark, store.raw_listings)
    found = facilities.read_facilities_csv(spark, store.raw_facilities)
    pages = districts = 0
    if raw is not None:
        # A file, or a part of a large one, is of one page and read by one task, so rows are not moved to write them.
        pages = sinks.overwrite_partitions(_named(raw, listings.STORED), target.raw_listings, ["province", "page"], gather=bool(split))
    if found is not None:
        rows = _named(found, RAW_FACILITY)
        stored = facilities.read_facilities(spark, target.raw_facilities)
        if stored is not None:
            there = stored.select(F.col("kecamatan").alias("_there")).distinct()
            rows = rows.join(there, F.col("kecamatan").eqNullSafe(F.col("_there")), "left_anti")
        districts = sinks.append_rows(rows, target.raw_facilities, [])
    return pages, districts


def _named(df: DataFrame, schema) -> DataFrame:
    """The columns of ``schema``, null where the files lack one, then all others."""
    named = [(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema]
    return df.select(*named, *[c for c in df.columns if c not in schema.names])
