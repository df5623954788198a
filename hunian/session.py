"""Session settings the jobs are designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.session.timeZone": "UTC",
    # Larger methods run interpreted; a wide projection is better split by not generating one method for it.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def session(app: str = "hunian", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings above; ``conf`` adds to them or replaces them.

    On a cluster give ``spark.sql.shuffle.partitions`` a value near the shuffle
    size over 128 MB; AQE merges what a small batch leaves empty.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
