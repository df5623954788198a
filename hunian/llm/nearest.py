"""Nearest vectors by an inverted multi-index.

Both halves of the vectors are quantised on their own, so ``CENTROIDS`` squared pairs of centroids cut the space
into cells. A query goes through the pairs in the order of their summed distance, taken from a heap, until the
cells it has met hold ``SHARE`` of all entries; what lies in them is ranked by the exact
inner product. The codebooks are fitted on at most ``FIT_ROWS`` vectors, every row is indexed.

Cells are laid out one after the other and cut into blocks of about ``BLOCK`` entries, so a cell
of any size is spread over blocks and small ones share one. Queries are sent to the blocks they need; a block is gathered once, or
a few times where very many queries need it, and the queries stream past. The driver holds a count for each cell.

Vectors that are null, zero, of another length than most, or that hold a null or a number that is
not finite, and rows without an id take no part. Rows count, not ids: every row that is asked is a query of its own and has all other rows as candidates.
Of rows with equal vectors only those that may be among the first by id are entries, as all score alike. Ties go to
the smaller id. An empty table gives no rows. Extra columns of the input are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .base import cut, map_batches
from .blocks import matrix, meet

CENTROIDS, FIT_ROWS, ROUNDS, SEED = 64, 20_000, 10, 5
#: Share of all entries in the cells that a query looks through. Measured recall: see README.
SHARE = 0.6
BLOCK = 4096
#: Query vectors scored against a block at a time.
AT_ONCE = 128


def usable(vectors: DataFrame, is_query: Column, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``row``, ``key``, ``vec array<double>`` and ``asked`` of the vectors that take part."""
    rows = vectors.select(
        F.col(key).cast("long").alias("key"), F.col(vector).cast("array<double>").alias("vec"), F.coalesce(is_query, F.lit(False)).alias("asked"))
    rows = rows.filter(
        F.col("key").isNotNull() & F.exists("vec", lambda x: x != 0)
        & F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    size = rows.agg(F.mode(F.size("vec"), True)).first()[0]
    return cut(rows.filter(F.size("vec") == F.lit(size)).select(F.monotonically_increasing_id().alias("row"), "key", "vec", "asked"))


def _centroids(half: np.ndarray) -> np.ndarray:
    """k-means from rows drawn without repetition; an empty cluster keeps its centroid."""
    distinct = np.unique(half, axis=0)
    random = np.random.default_rng(SEED)
    centres = distinct[random.choice(len(distinct), min(CENTROIDS, len(distinct)), replace=False)]
    for _ in range(ROUNDS):
        nearest = _nearest(half, centres)
        counts = np.bincount(nearest, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, half)
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
    return centres


def _nearest(half: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres * centres).sum(axis=1) - 2 * half @ centres.T, axis=1)


@dataclass
class Codebooks:
    """Centroids of the first and of the second half."""

    first: np.ndarray
    second: np.ndarray

    @property
    def cells(self) -> int:
        return len(self.first) * len(self.second)

    def cell(self, rows: np.ndarray) -> np.ndarray:
        split = self._split(rows)
        return _nearest(rows[:, :split], self.first) * len(self.second) + _nearest(rows[:, split:], self.second)

    def distances(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distance of each half to each centroid: the inner product, turned around."""
        split = self._split(rows)
        return -rows[:, :split] @ self.first.T, -rows[:, split:] @ self.second.T

    def _split(self, rows: np.ndarray) -> int:
        return rows.shape[1] // 2


def fit(entries: DataFrame) -> Codebooks | None:
    """Codebooks of at most ``FIT_ROWS`` entries, chosen by a hash of the id."""
    sample = entries.orderBy(F.xxhash64("key"), "key", "vec").limit(FIT_ROWS).select("vec").toArrow()
    if not sample.num_rows:
        return None
    rows = matrix(sample["vec"])
    half = rows.shape[1] // 2
    return Codebooks(_centroids(rows[:, :half]), _centroids(rows[:, half:]))


@dataclass
class Layout:
    """Where the cells lie in the row of all entries."""

    counts: np.ndarray

    def __post_init__(self):
        self.starts = np.cumsum(self.counts) - self.counts

    def blocks(self, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last block that hold entries of each cell."""
        return self.starts[cells] // BLOCK, (self.starts[cells] + np.maximum(self.counts[cells], 1) - 1) // BLOCK

    def block(self, cells: np.ndarray, share: np.ndarray) -> np.ndarray:
        """Block of entries of these cells; ``share`` from 0 to 1 spreads a cell over its blocks."""
        offset = np.minimum((share * self.counts[cells]).astype(np.int64), np.maximum(self.counts[cells] - 1, 0))
        return (self.starts[cells] + offset) // BLOCK


def traverse(first: np.ndarray, second: np.ndarray, counts: np.ndarray, wanted: int) -> tuple[list[int], float]:
    """Cells in the order of summed distance until they hold ``wanted`` entries, and the last sum.

    The heap holds for each started row of the sorted first distances its next pair.
    """
    rows, columns = np.argsort(first, kind="stable").tolist(), np.argsort(second, kind="stable").tolist()
    near, far = first[rows].tolist(), second[columns].tolist()
    width, sizes = len(columns), counts.tolist()
    heap, met, held, last = [(near[0] + far[0], 0, 0)], [], 0, -np.inf
    while heap:
        distance, i, j = heapq.heappop(heap)
        if held >= wanted and distance > last:
            break
        last = distance
        cell = rows[i] * width + columns[j]
        if sizes[cell]:
            met.append(cell)
            held += sizes[cell]
        if j + 1 < width:
            heapq.heappush(heap, (near[i] + far[j + 1], i, j + 1))
        if j == 0 and i + 1 < len(rows):
            heapq.heappush(heap, (near[i + 1] + far[0], i + 1, 0))
    return met, last


def search(
    vectors: DataFrame, is_query: Column, count: int = 20, share: float = SHARE, key: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """The ``count`` nearest entries found for each row that ``is_query`` selects (by ``key``).

    Returns ``query_id``, ``rank`` from 1, ``vec_id`` and ``score``, the inner product in double precision.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, is_query, key, vector)
    books = fit(rows)
    if books is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    shared = spark.sparkContext.broadcast(books)
    # One more than asked for, as the query's own row may be among them.
    copies = Window.partitionBy("vec").orderBy("key", "row")
    entries = rows.withColumn("_copy", F.row_number().over(copies)).filter(F.col("_copy") <= count + 1)

    placed = cut(map_batches(
        entries.select("row", "key", "vec", (F.pmod(F.xxhash64("row"), F.lit(1 << 20)) / (1 << 20)).alias("share")),
        lambda b: {"cell": pa.array(shared.value.cell(matrix(b.column("vec"))), pa.int32()),
                   **{n: b.column(n) for n in ("row", "key", "vec", "share")}},
        "cell int, row long, key long, vec array<double>, share double"))
    counts = np.zeros(books.cells, np.int64)
    for found in placed.groupBy("cell").count().collect():
        counts[found["cell"]] = found["count"]
    layout = Layout(counts)
    wanted = max(int(np.ceil(share * counts.sum())), count + 1)

    blocked = map_batches(
        placed,
        lambda b: {"block": pa.array(layout.block(np.asarray(b.column("cell")), np.asarray(b.column("share"))), pa.int64()),
                   **{n: b.column(n) for n in ("cell", "row", "key", "vec")}},
        "block long, cell int, row long, key long, vec array<double>")

    def visit(batch: pa.RecordBatch) -> dict:
        books = shared.value
        first, second = books.distances(matrix(batch.column("vec")))
        blocks, reach = [], []
        for a, b in zip(first, second):
            cells, last = traverse(a, b, layout.counts, wanted)
            start, end = layout.blocks(np.array(cells))
            blocks.append(np.unique(np.concatenate([start, end, *[
                np.arange(s, e) for s, e in zip(start, end) if e - s > 1]])))
            reach.append(last)
        return {"blocks": pa.array(blocks, pa.list_(pa.int64())), **{n: batch.column(n) for n in ("row", "key", "vec")},
                "reach": pa.array(reach, pa.float64())}

    # Spread as dealt, by another expression than rows are kept by: the traversal is the dear part, though its input is small.
    dealt = rows.filter("asked").select("row", "key", "vec").repartition(
        int(spark.conf.get("spark.sql.shuffle.partitions")), F.xxhash64(F.lit(SEED), "row"))
    asked = cut(map_batches(dealt, visit, "blocks array<long>, row long, key long, vec array<double>, reach double"))
    best = meet(
        blocked, asked, _Block.of, lambda block, batch: block.nearest(batch, shared.value, count),
        "query_row long, query_id long, row long, vec_id long, score double", "row")
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= count).select(
        "query_id", "rank", "vec_id", "score")


@dataclass
class _Block:
    cells: np.ndarray
    rows: np.ndarray
    keys: np.ndarray
    vectors: np.ndarray

    @classmethod
    def of(cls, entry: pa.Table) -> _Block:
        return cls(*[entry[n].to_numpy() for n in ("cell", "row", "key")], matrix(entry["vec"]))

    def nearest(self, batch: pa.RecordBatch, books: Codebooks, count: int) -> Iterator[dict]:
        """The nearest entries of the block, for some queries at a time."""
        asked, names, ids, reach = matrix(batch.column("vec")), *[batch.column(n).to_numpy() for n in ("row", "key", "reach")]
        width = len(books.second)
        for at in range(0, len(asked), AT_ONCE):
            part = slice(at, at + AT_ONCE)
            first, second = books.distances(asked[part])
            # A little slack, for a matrix product may round the same sum differently elsewhere.
            met = first[:, self.cells // width] + second[:, self.cells % width] <= reach[part, None] + 1e-9
            scores = np.where(met & (self.rows != names[part, None]), asked[part] @ self.vectors.T, -np.inf)
            made = [[], [], [], [], []]
            for n, score in enumerate(scores):
                kept = min(count, len(score))
                least = np.partition(score, len(score) - kept)[len(score) - kept]
                near = np.flatnonzero((score >= least - 1e-9 * max(1.0, abs(least))) & (score > -np.inf)) \
                    if least > -np.inf else np.flatnonzero(score > -np.inf)
                # Row by row, so that equal vectors get equal scores wherever they lie.
                exact = (self.vectors[near] * asked[at + n]).sum(axis=1)
                order = np.lexsort((self.rows[near], self.keys[near], -exact))[:count]
                for column, values in zip(made, (
                        np.full(len(order), names[at + n]), np.full(len(order), ids[at + n]), self.rows[near][order],
                        self.keys[near][order], exact[order])):
                    column.append(values)
            yield {n: np.concatenate(v) for n, v in zip(("query_row", "query_id", "row", "vec_id", "score"), made)}
