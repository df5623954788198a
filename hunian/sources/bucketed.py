"""Tables whose files are bucketed and sorted by a key, so that joins on it do not move them.

Spark knows a file's bucket from its name and a table's buckets from the session's catalog. ``attach`` names a folder as
such a table in a session; every batch that ``append`` adds has one file for each bucket. The number of buckets is part of the layout: a folder is
always attached with the number it was written with, which is kept beside the files.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .files import file_system

#: Buckets of a new table: with a row for each district some are enough.
BUCKETS = 64
_MARK = "_buckets"


def _name(path: str) -> str:
    return f"bucketed_{hashlib.md5(path.encode()).hexdigest()}"


def buckets_of(spark: SparkSession, path: str) -> int | None:
    """The number of buckets of a table that is there; None if there is none."""
    files, at = file_system(spark, f"{path}/{_MARK}")
    if not files.exists(at):
        return None
    return int(files.listStatus(at)[0].getPath().getName())


def attach(spark: SparkSession, path: str, schema: T.StructType, key: str) -> DataFrame | None:
    """The table at ``path``; None if nothing has been written."""
    buckets = buckets_of(spark, path)
    if buckets is None:
        return None
    name = _name(path)
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        location = path.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS "
                  f"LOCATION '{location}'")
    spark.catalog.refreshTable(name)
    return spark.table(name)


def append(rows: DataFrame, path: str, key: str, buckets: int = BUCKETS) -> None:
    """Add rows; a new table gets ``buckets``, one that is there keeps its own.

    Rows are dealt to tasks as the buckets are, so a batch adds at most one file to each.
    """
    spark = rows.sparkSession
    found = buckets_of(spark, path)
    if found is None:
        files, at = file_system(spark, f"{path}/{_MARK}/{buckets}")
        files.mkdirs(at.getParent())
        files.create(at).close()
        found = buckets
    attach(spark, path, rows.schema, key)
    rows.repartition(found, key).write.mode("append").format("parquet").bucketBy(found, key).sortBy(key).saveAsTable(_name(path))
