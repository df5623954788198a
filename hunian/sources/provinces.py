"""The province dimension, a small CSV with a header."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import PROVINCE_COLUMNS


def read_provinces(spark: SparkSession, path: str) -> DataFrame:
    """Typed rows under plain names; a header in another order or width raises."""
    ddl = ", ".join(f"`{name}` {kind}" for name, (_, kind) in PROVINCE_COLUMNS.items())
    raw = spark.read.csv(path, header=True, schema=ddl, enforceSchema=False)
    return raw.select(*[F.col(f"`{name}`").alias(to) for name, (to, _) in PROVINCE_COLUMNS.items()])
