"""Fetched pages: a table of ``url``, ``html`` and what tells fetches of a url apart.

Fetching itself is not done here. ``write_pages`` lays a table out in folders by the url's hash; a reader that knows
its urls then opens only the folders they are in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Folders of a pages table, a number that stays as it is once a table is written.
URL_BUCKETS = 1024
BUCKET = "url_bucket"


def bucket_of(url: Column) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(URL_BUCKETS)).cast("int")


def write_pages(pages: DataFrame, path: str) -> None:
    """Add fetched pages to a table in folders."""
    rows = pages.withColumn(BUCKET, bucket_of(F.col("url")))
    rows.hint("rebalance", BUCKET).write.mode("append").partitionBy(BUCKET).parquet(path)


def read_pages(spark: SparkSession, path: str, version: str | None = None) -> DataFrame:
    """``url``, ``html``, the ``version`` column and the folder number of a table that has folders."""
    pages = spark.read.parquet(path)
    return pages.select("url", "html", *[c for c in (version, BUCKET) if c and c in pages.columns])


def fetched(pages: DataFrame, urls: DataFrame, version: str | None = None) -> DataFrame:
    """The pages of ``urls`` (a column ``url``, distinct).

    Of a table in folders only those with a wanted url are opened; their numbers are at
    most ``URL_BUCKETS``. How the rest is joined is Spark's choice by size.
    """
    if BUCKET in pages.columns:
        hit = [r[0] for r in urls.select(bucket_of(F.col("url"))).distinct().collect()]
        pages = pages.filter(F.col(BUCKET).isin(hit)).drop(BUCKET)
    return pages.join(urls, "url", "left_semi")


def newest(rows: DataFrame, key: str, version: str | None = None) -> DataFrame:
    """One row per ``key``: of the largest ``version``, and of equals the largest row."""
    order = [version] if version else []
    others = [c for c in rows.columns if c not in (key, *order)]
    best = F.max(F.struct(*order, *others)).alias("_newest")
    return rows.groupBy(key).agg(best).select(key, *[F.col(f"_newest.{c}") for c in (*others, *order)])
