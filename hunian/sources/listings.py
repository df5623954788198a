"""Raw and clean listings.

The engine's raw store is Parquet under ``province=<p>/page=<n>``. The file tree
``<province>/page_<n>_<province>.csv`` is read as well.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import LISTING_REQUIRED, RAW_LISTING
from . import sinks
from .files import escape_glob, partition_value, read_csv_by_name, read_existing, read_rows

#: Raw listing columns plus the two partition columns.
STORED = T.StructType(
    [*RAW_LISTING, T.StructField("province", T.StringType()), T.StructField("page", T.IntegerType())])


def read_page(spark: SparkSession, root: str, provinces: list[str], page: int) -> DataFrame | None:
    """Stored listings of one page with any further columns; provinces without data are simply absent."""
    names = [f"province={escape_glob(partition_value(p))}/page={page}" for p in provinces]

    def read(path: str) -> DataFrame:
        # The files' own columns first, from their footers: a given schema alone would hide the further ones.
        found = spark.read.option("basePath", root).option("mergeSchema", True).parquet(path).schema
        further = [f for f in found if f.name not in STORED.names]
        schema = T.StructType([*RAW_LISTING, *further, STORED["province"], STORED["page"]])
        return spark.read.schema(schema).option("basePath", root).parquet(path)

    return read_existing(read, root, names)


def read_all(spark: SparkSession, root: str) -> DataFrame:
    """Every stored listing; empty when nothing is stored yet."""
    found = read_existing(spark.read.schema(STORED).option("basePath", root).parquet, root, ["province=*"])
    return spark.createDataFrame([], STORED) if found is None else found


def read_page_csv(spark: SparkSession, root: str, provinces: list[str], page: int) -> DataFrame | None:
    """One page from the CSV tree, with ``province`` and ``page`` from the file names."""
    names = [f"{p}/page_{page}_{p}.csv" for p in map(escape_glob, provinces)]
    return read_existing(lambda path: _tree(spark, path, LISTING_REQUIRED, False), root, names)


def read_titles_csv(spark: SparkSession, root: str, required=("judul_iklan",)) -> DataFrame | None:
    """The whole CSV tree; files that cannot be read or lack a required column are skipped."""
    return read_existing(lambda path: _tree(spark, path, list(required), True), root, ["*/page_*.csv"])


def read_all_csv(spark: SparkSession, root: str) -> DataFrame | None:
    """The whole CSV tree with all its columns; a file that cannot be read or lacks a column raises."""
    return read_existing(lambda path: _tree(spark, path, LISTING_REQUIRED, False), root, ["*/page_*.csv"])


def read_good_rows(spark: SparkSession, root: str, split: str) -> DataFrame | None:
    """Good rows of the whole CSV tree; they and the bad ones are written under ``split`` first."""
    rows = read_existing(lambda path: read_rows(spark, path, LISTING_REQUIRED[:1]), root, ["*/page_*.csv"])
    if rows is None:
        return None
    sinks.write_split(rows, split)
    return _named_by_file(spark.read.schema(rows.schema).parquet(sinks.split_path(split, good=True)).drop("_reason", "_line"))


def _tree(spark: SparkSession, path: str, required: list[str], skip_bad: bool) -> DataFrame | None:
    raw = read_csv_by_name(spark, path, required, skip_bad)
    return None if raw is None else _named_by_file(raw)


def _named_by_file(raw: DataFrame) -> DataFrame:
    """``province`` and ``page`` from the files' names, or from that of the folder that holds a large file's parts."""
    name = F.url_decode(F.regexp_replace(F.regexp_extract("_file", "([^/]+)(?:/part-[^/]+)?$", 1), r"\+", "%2B"))
    pattern = r"^page_(\d+)_(.+)\.csv$"
    return raw.select(
        *[c for c in raw.columns if c != "_file"],
        F.regexp_extract(name, pattern, 2).alias("province"),
        F.regexp_extract(name, pattern, 1).try_cast("int").alias("page"))
