"""Rows that meet blocks: each block of entries is gathered once, and what is asked of it streams past.

``entries`` have a ``block``; ``asked`` rows name the ``blocks`` they need. A task holds one block at a time, which
the caller bounds, and reads asked rows in Arrow batches, so their number is no matter of memory. A block that more than
``AT_MOST`` rows ask for is copied to several tasks. Blocks that nobody asks for are not moved.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import ending

#: Asked rows that one copy of a block serves.
AT_MOST = 1 << 16


def matrix(column: pa.Array | pa.ChunkedArray, kind: type = np.float64) -> np.ndarray:
    """Lists of equal length as the rows of a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.flatten(), kind).reshape(len(column), -1)


def meet(
    entries: DataFrame, asked: DataFrame, build: Callable[[pa.Table], object],
    work: Callable[[object, pa.RecordBatch], Iterator[dict]], schema: str, key: str,
) -> DataFrame:
    """Rows that ``work`` makes of a block, as ``build`` has prepared it, and some of the rows that ask for it.

    ``asked`` is read twice, so it should be a written table; ``key`` is its column by which copies of a block share the rows.
    """
    spark = entries.sparkSession
    entry = F.struct(*[c for c in entries.columns if c != "block"])
    question = F.struct(*[c for c in asked.columns if c != "blocks"])
    sent = asked.select(F.explode("blocks").alias("block"), question.alias("asked"))
    parts = asked.select(F.explode("blocks").alias("block")).groupBy("block").agg(
        F.ceil(F.count("*") / F.lit(AT_MOST)).cast("int").alias("parts"))
    kept = entries.select("block", entry.alias("entry"))
    left = kept.join(parts, "block").select(
        "block", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("kind"), "entry",
        F.lit(None).cast(sent.schema["asked"].dataType).alias("asked"))
    right = sent.join(parts, "block").select(
        "block", F.pmod(F.xxhash64(F.col("asked")[key]), F.col("parts")).cast("int").alias("part"), F.lit(1).alias("kind"),
        F.lit(None).cast(kept.schema["entry"].dataType).alias("entry"), "asked")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, built = None, [], None
        for batch in batches:
            names = [batch.column(n).to_numpy() for n in ("block", "part", "kind")]
            change = np.flatnonzero(np.any([n[1:] != n[:-1] for n in names], axis=0)) + 1 if batch.num_rows > 1 else []
            cuts = [0, *change, batch.num_rows]
            for start, end in zip(cuts, cuts[1:]):
                if start == end:
                    continue
                block, part, kind = (n[start] for n in names)
                piece = batch.slice(start, end - start)
                if (block, part) != now:
                    now, held, built = (block, part), [], None
                if kind == 0:
                    held.append(pa.RecordBatch.from_struct_array(piece.column("entry")))
                    continue
                if held:
                    built, held = build(pa.Table.from_batches(held)), []
                if built is not None:
                    for made in work(built, pa.RecordBatch.from_struct_array(piece.column("asked"))):
                        yield pa.RecordBatch.from_pydict(
                            {k: v if isinstance(v, pa.Array) else pa.array(v) for k, v in made.items()})

    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return left.union(right).repartition(tasks, "block", "part").sortWithinPartitions("block", "part", "kind").mapInArrow(
        ending(run), schema)
