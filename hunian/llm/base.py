"""What the operators share: tables, the shared folder, Arrow batches, bounded hashing."""

from __future__ import annotations

import ctypes
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def with_shared_folder(spark: SparkSession) -> SparkSession:
    """The session with a checkpoint folder.

    A cluster names it in ``spark.checkpoint.dir``. Only a session on one machine
    without that setting gets a folder of its own.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not context.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="checkpoint-"))
    return spark


def shared_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder."""
    return f"{with_shared_folder(spark).sparkContext.getCheckpointDir()}/{name}"


def cut(df: DataFrame, small: bool = False) -> DataFrame:
    """``df`` written to the shared folder, so that a lost executor does not repeat what made it.

    A ``small`` table, of a few columns and far fewer rows than there are documents, is gathered to two
    partitions for each of the cluster's cores, as a step that runs over and over would write very many tiny files.
    """
    context = with_shared_folder(df.sparkSession).sparkContext
    return (df.coalesce(2 * context.defaultParallelism) if small else df).checkpoint()


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


_CACHES: list[Callable[[], None]] = []


def emptied_with_task(cache: dict) -> dict:
    """A module's cache that ``ending`` empties."""
    _CACHES.append(cache.clear)
    return cache


def give_back() -> None:
    """Empty the caches and give free memory back to the system: a worker outlives its task, idle beside those of later stages."""
    for clear in _CACHES:
        clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def ending(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` over a task's batches, with ``give_back`` when they end."""

    def ended(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            give_back()

    return ended


def series_udf(run: Callable[[Iterator[pd.Series]], Iterator[pd.Series]]) -> Callable[[Column], Column]:
    """A double column out of ``run`` over the series of a task's batches, with ``give_back`` at their end."""
    ended = ending(run)

    def made(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        yield from ended(batches)

    made.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(made, "double")


def map_batches(
    df: DataFrame, make: Callable[[pa.RecordBatch], dict[str, pa.Array | np.ndarray]], schema: str,
) -> DataFrame:
    """One output batch for each Arrow batch of ``df``; ``make`` returns the columns by name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                made = {k: v if isinstance(v, pa.Array) else pa.array(v) for k, v in make(batch).items()}
                yield pa.RecordBatch.from_pydict(made)

    return df.mapInArrow(ending(run), schema)


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The texts of a batch; null reads as empty."""
    return ["" if t is None else t for t in batch.column(name).to_pylist()]


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus
