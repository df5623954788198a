"""Distinct keys and the membership joins between listings, keys and progress.

No key ever reaches the driver. Key sets are made distinct before they are
joined, so a value that fills a third of a table is folded to one row by the
map-side half of the aggregate. On the row side such a value stays, and AQE has
to be able to cut its partition: see ``_membership``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_keys(df: DataFrame, key: str, keep_null: bool = False) -> DataFrame:
    """One row per value of ``key``; null is dropped unless ``keep_null``."""
    keys = df.select(key)
    return (keys if keep_null else keys.filter(F.col(key).isNotNull())).distinct()


def union_keys(frames: list[DataFrame], key: str) -> DataFrame:
    """Distinct non-null keys over several frames, in one aggregate."""
    return distinct_keys(reduce(DataFrame.unionByName, (f.select(key) for f in frames)), key)


def union_pages(frames: list[DataFrame]) -> DataFrame:
    """All rows of all frames, matched by column name, duplicates kept."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def keep_new(rows: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Rows whose ``key`` is not among ``known``; copies within ``rows`` all stay."""
    return _membership(rows, known, key, "left_anti")


def keep_known(rows: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Rows whose ``key`` is among ``known``; a null key never is."""
    return _membership(rows, known, key, "left_semi")


def missing_keys(keys: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """Distinct non-null keys without a stored row.

    Both sides are unique on ``key`` after their aggregates, whose exchanges the
    join reuses: two shuffles in all and no heavy key on either side.
    """
    return distinct_keys(keys, key).join(distinct_keys(stored, key), key, "left_anti")


def stored_rows(stored: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """Rows of a table that is bucketed by ``key`` whose key is wanted.

    Unlike ``keep_known`` the join is on the key alone, as the buckets are, so only the wanted keys move. The
    table should hold few rows of any one key.
    """
    return stored.join(distinct_keys(wanted, key), key, "left_semi").select(*stored.columns)


def _membership(rows: DataFrame, known: DataFrame, key: str, how: str) -> DataFrame:
    """Semi or anti join of possibly skewed ``rows`` with a deduplicated key set.

    AQE cuts a skewed partition only if both join inputs come straight from a
    shuffle. The aggregate that makes ``known`` distinct would sit in between,
    as its own exchange on ``key`` already fits the join. Joining on the key and
    its hash asks for one more exchange of the (small, unique) key set and lets
    the heavy key's rows be spread over many tasks.
    """
    keys = distinct_keys(known, key).select(
        F.col(key).alias("_known"), F.xxhash64(key).alias("_known_hash"))
    match = (F.col(key) == F.col("_known")) & (F.xxhash64(key) == F.col("_known_hash"))
    return rows.join(keys, match, how)


def on_selected_pages(listings: DataFrame, selected: DataFrame) -> DataFrame:
    """Listings of the (province, page) pairs in ``selected``; other pairs give no rows."""
    pairs = selected.select("province", "page")
    return listings.join(pairs, ["province", "page"], "left_semi")
