"""Raw facility rows: one Parquet folder, or a folder with one CSV per district."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schemas import FACILITY_REQUIRED, RAW_FACILITY
from .files import read_csv_by_name, read_existing


def read_facilities(spark: SparkSession, root: str) -> DataFrame | None:
    """All stored districts; None when nothing is stored yet."""
    return read_existing(spark.read.schema(RAW_FACILITY).parquet, root, ["*.parquet"])


def read_facilities_csv(spark: SparkSession, root: str) -> DataFrame | None:
    """All district files in one scan; the district is a column, not a file name."""
    found = read_existing(lambda path: read_csv_by_name(spark, path, FACILITY_REQUIRED), root, ["*.csv"])
    return None if found is None else found.drop("_file")
