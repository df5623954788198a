"""Vectors of one label that are nearly alike: epsilon grid order join.

1. Vectors get length one, so a cosine of ``LIKE`` is a distance of ``sqrt(2 - 2 LIKE)``, the epsilon. Rows of equal label and
   vector are one vertex from here on.
2. Vertices are turned to the ``DIMS`` leading principal directions of all of them; turning never lengthens a distance. The
   cells of an epsilon wide grid over these numbers give the epsilon grid order: by label, then cell after cell.
3. The order is cut into blocks of at most ``BLOCK`` vertices of one label, with the box around each. Intervals of blocks are
   joined recursively, ``FAN`` parts of each at a time, from the whole order down to single blocks; two intervals whose boxes are
   farther apart than epsilon, or that have no label in common, are skipped with all that is in them.
4. A vertex meets the blocks that are left for its own. There the recursion goes on with halves of the two sequences
   down to ``LEAF`` vertices; what still is near enough is compared by the exact cosine of the whole vectors.
5. A task counts links and gives only links between what it has not joined yet: a vertex and the first of its
   component within the compared sequences, never all pairs. Links make components.

Every pair of cosine ``LIKE`` or more is found: blocks are skipped by bounds only. Vectors that are null, zero, of another length than
most, or that hold a null or a number that is not finite, and rows without a label link with nothing and are their own component;
a null id is a component without a name. Repeated rows are copies, which link with each other. An empty table gives no rows. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .base import cut, ending, map_batches
from .blocks import matrix, meet
from .neardup import roots

LIKE = 0.93
DIMS, BLOCK, FAN, LEAF = 16, 2048, 8, 128
#: By so much rounding may move a distance or a cosine.
SLACK = 1e-9


def unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length one; scaled first, as squares of very large or small numbers are not finite."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def vertices(rows: DataFrame) -> DataFrame:
    """``a`` (a 128-bit name as text), ``label``, ``vec``, ``copies`` and the smallest ``key`` of rows of equal label and vector."""
    return rows.groupBy("vertex").agg(
        F.first("label").alias("label"), F.first("vec").alias("vec"), F.count("*").alias("copies"), F.min("key").alias("least"))


def _rows(vectors: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """``key``, ``label``, ``vec`` and the name of the vertex, null for rows that link with nothing."""
    rows = vectors.select(
        F.col(key).cast("long").alias("key"), F.col(label).cast("long").alias("label"), F.col(vector).cast("array<double>").alias("vec"))
    taking = (F.col("label").isNotNull() & F.exists("vec", lambda x: x != 0)
              & F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    size = rows.filter(taking).agg(F.mode(F.size("vec"), True)).first()[0]
    name = F.concat(*[F.lpad(F.hex(h), 16, "0") for h in (
        F.xxhash64("label", "vec"), F.xxhash64(F.lit(1), "vec", "label"))])
    return rows.withColumn("vertex", F.when(taking & (F.size("vec") == F.lit(size)), name))


@dataclass
class Turn:
    """Leading principal directions; without any, one number that is the same for all."""

    centre: np.ndarray
    directions: np.ndarray

    def __call__(self, units: np.ndarray) -> np.ndarray:
        return (units - self.centre) @ self.directions


def principal(found: DataFrame, dims: int = DIMS) -> Turn | None:
    """From the sums over all vertices of the vectors' products; tasks return one sum each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                units = unit(matrix(batch.column("vec")))
                units = np.hstack([units, np.ones((len(units), 1))])
                total = units.T @ units + (0 if total is None else total)
        if total is not None:
            at = np.arange(total.size)
            yield pa.RecordBatch.from_pydict({"at": pa.array(at, pa.int32()), "value": pa.array(total.ravel())})

    sums = found.select("vec").mapInArrow(ending(run), "at int, value double").groupBy("at").agg(F.sum("value").alias("value")).toArrow()
    if not sums.num_rows:
        return None
    total = np.zeros(sums.num_rows)
    total[sums["at"].to_numpy()] = sums["value"].to_numpy()
    total = total.reshape(int(np.sqrt(len(total))), -1)
    centre = total[-1, :-1] / total[-1, -1]
    _, directions = np.linalg.eigh(total[:-1, :-1] / total[-1, -1] - np.outer(centre, centre))
    return Turn(centre, directions[:, ::-1][:, :dims])


def ordered(found: DataFrame, turn: Turn, eps: float) -> DataFrame:
    """Vertices in epsilon grid order with ``block`` numbers along it."""
    spark = found.sparkSession
    turned = map_batches(
        found, lambda b: {**{n: b.column(n) for n in ("vertex", "label", "copies", "vec")},
                          "low": pa.array(list(turn(unit(matrix(b.column("vec"))))), pa.list_(pa.float64()))},
        "vertex string, label long, copies long, vec array<double>, low array<double>")
    cells = F.transform("low", lambda x: F.floor(x / F.lit(eps)))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    along = turned.withColumn("cells", cells).repartitionByRange(tasks, "label", "cells", "vertex").sortWithinPartitions(
        "label", "cells", "vertex")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, block, held = None, -1, 0
        for batch in batches:
            made = []
            for label in batch.column("label").to_pylist():
                if label != last or held == BLOCK:
                    last, block, held = label, block + 1, 0
                held += 1
                made.append(block)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(made), TaskContext.get().partitionId()), pa.int32()), pa.array(made, pa.int64()), *batch.columns],
                ["task", "at", *batch.schema.names])

    numbered = cut(along.drop("cells").mapInArrow(
        ending(run), "task int, at long, vertex string, label long, copies long, vec array<double>, low array<double>"))
    # One row for each task: how many blocks lie before its first.
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = numbered.groupBy("task").agg((F.max("at") + 1).alias("n")).withColumn(
        "start", F.coalesce(F.sum("n").over(before), F.lit(0))).select("task", "start")
    return numbered.join(starts, "task").select(
        (F.col("start") + F.col("at")).alias("block"), "vertex", "label", "copies", "vec", "low")


def near_blocks(boxes: DataFrame, eps: float) -> DataFrame:
    """``a`` and ``b``, a at most b: blocks whose boxes are no farther apart than ``eps``, found from the whole order downwards.

    ``boxes`` has ``block, label, low, high``. Each step joins the parts of the pairs that are left with their boxes.
    """
    blocks = (boxes.agg(F.max("block")).first()[0] or 0) + 1
    levels = 1
    while FAN ** levels < blocks:
        levels += 1
    pairs = boxes.sparkSession.range(1).select(F.col("id").alias("a"), F.col("id").alias("b"))
    size = F.size(boxes["low"])
    dims = boxes.select(size).first()
    dims = dims[0] if dims else 0
    for level in range(levels - 1, -1, -1):
        node = F.floor(F.col("block") / F.lit(FAN ** level)).cast("long")
        nodes = boxes.groupBy(node.alias("node")).agg(
            F.min("label").alias("first"), F.max("label").alias("last"),
            F.array(*[F.min(F.col("low")[d]) for d in range(dims)]).alias("low"),
            F.array(*[F.max(F.col("high")[d]) for d in range(dims)]).alias("high"))
        nodes = cut(nodes, small=True)
        parts = [F.explode(F.sequence(F.col(n) * FAN, F.col(n) * FAN + FAN - 1)).alias(n) for n in "ab"]
        pairs = pairs.select(parts[0], "b").select("a", parts[1]).filter("a <= b")
        x, y = (nodes.select(F.col("node").alias(n), F.struct("first", "last", "low", "high").alias(m)) for n, m in (("a", "x"), ("b", "y")))
        pairs = cut(pairs.join(x, "a").join(y, "b").filter(_near(F.col("x"), F.col("y"), eps)).select("a", "b"), small=True)
    return pairs


def _near(x: Column, y: Column, eps: float) -> Column:
    """Whether two intervals share a label and their boxes are at most ``eps`` apart."""
    gaps = F.zip_with(
        F.zip_with(x["low"], y["high"], lambda low, high: low - high), F.zip_with(y["low"], x["high"], lambda low, high: low - high),
        lambda a, b: F.greatest(a, b, F.lit(0.0)))
    far = F.aggregate(gaps, F.lit(0.0), lambda total, gap: total + gap * gap)
    return (x["first"] <= y["last"]) & (y["first"] <= x["last"]) & (far <= F.lit(eps * eps + SLACK))


@dataclass
class Sequence:
    """Vertices in grid order with boxes of runs of ``LEAF``."""

    names: np.ndarray
    copies: np.ndarray
    vectors: np.ndarray
    units: np.ndarray
    low: np.ndarray

    @classmethod
    def of(cls, rows: pa.Table | pa.RecordBatch, eps: float) -> Sequence:
        low = matrix(rows.column("low"))
        order = np.lexsort(np.floor(low / eps).T[::-1])
        vectors = matrix(rows.column("vec"))[order]
        return cls(np.array(rows.column("vertex").to_pylist(), object)[order], rows.column("copies").to_numpy()[order], vectors,
                   unit(vectors), low[order])


def join(a: Sequence, b: Sequence, eps: float) -> Iterator[tuple[int, int, int, int]]:
    """Recursive join: (start, end) of ``a`` and of ``b`` for the short sequences that are not provably distant."""
    stack = [(0, len(a.low), 0, len(b.low))]
    while stack:
        i, j, k, m = stack.pop()
        x, y = a.low[i:j], b.low[k:m]
        gap = np.maximum(np.maximum(x.min(axis=0) - y.max(axis=0), y.min(axis=0) - x.max(axis=0)), 0)
        if gap @ gap > eps * eps + SLACK:
            continue
        if max(j - i, m - k) <= LEAF:
            yield i, j, k, m
        elif j - i >= m - k:
            half = (i + j) // 2
            stack += [(i, half, k, m), (half, j, k, m)]
        else:
            half = (k + m) // 2
            stack += [(i, j, k, half), (i, j, half, m)]


def alike(a: Sequence, b: Sequence, part: tuple[int, int, int, int], like: float) -> np.ndarray:
    """Which vertices of two short sequences reach ``like``; cosines at the limit are worked out pair by pair."""
    i, j, k, m = part
    cosine = a.units[i:j] @ b.units[k:m].T
    found = cosine >= like
    for x, y in np.argwhere(np.abs(cosine - like) < SLACK):
        p, q = a.vectors[i + x], b.vectors[k + y]
        p, q = p / np.abs(p).max(), q / np.abs(q).max()
        found[x, y] = (p * q).sum() / (np.sqrt((p * p).sum()) * np.sqrt((q * q).sum())) >= like
    return found


def first_of_component(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For the rows and columns of a link matrix the smallest row of their component; rows that are linked with none keep their own."""
    many = len(linked)
    rows, before = np.arange(many), None
    while before is None or (rows != before).any():
        before = rows
        columns = np.where(linked, rows[:, None], many).min(axis=0)
        rows = np.minimum(rows, np.where(linked, columns[None, :], many).min(axis=1))
    return rows, columns


def components(
    vectors: DataFrame, like: float = LIKE, key: str = "vec_id", vector: str = "embedding", label: str = "label",
) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` for each row of ``vectors``."""
    eps = float(np.sqrt(2 - 2 * like))
    rows = cut(_rows(vectors, key, vector, label))
    found = cut(vertices(rows.filter("vertex is not null")))
    turn = principal(found)
    if turn is None:
        return rows.select(F.col("key").alias(key), F.lit(0).cast("long").alias("n_links"), F.col("key").alias("component_id"),
                           F.lit(True).alias("kept"))
    placed = cut(ordered(found, turn, eps))
    dims = turn.directions.shape[1]
    boxes = placed.groupBy("block").agg(
        F.first("label").alias("label"), F.array(*[F.min(F.col("low")[d]) for d in range(dims)]).alias("low"),
        F.array(*[F.max(F.col("low")[d]) for d in range(dims)]).alias("high"))
    pairs = near_blocks(cut(boxes, small=True), eps)
    both = pairs.union(pairs.filter("a != b").select(F.col("b").alias("a"), F.col("a").alias("b")))
    # The blocks that a block has to meet: as many as are near it, which on vectors without any order is all of its label.
    near = both.groupBy(F.col("a").alias("block")).agg(F.collect_list("b").alias("blocks"))
    asked = placed.join(near, "block").select("blocks", "vertex", "copies", "vec", "low")

    def work(entry: Sequence, batch: pa.RecordBatch) -> Iterator[dict]:
        query = Sequence.of(batch, eps)
        counts = np.zeros(len(query.names), np.int64)
        links: set[tuple[str, str]] = set()
        for part in join(query, entry, eps):
            i, j, k, m = part
            linked = alike(query, entry, part, like) & (query.names[i:j, None] != entry.names[None, k:m])
            if not linked.any():
                continue
            counts[i:j] += linked @ entry.copies[k:m]
            rows, columns = first_of_component(linked)
            for names, first in ((query.names[i:j], rows), (entry.names[k:m], columns)):
                links.update((names[n], query.names[i + first[n]]) for n in np.flatnonzero(first < j - i)
                             if names[n] != query.names[i + first[n]])
        some = np.flatnonzero(counts)
        yield {"vertex": pa.array(query.names[some], pa.string()), "near": pa.array(counts[some], pa.int64()),
               "other": pa.array([None] * len(some), pa.string())}
        yield {"vertex": pa.array([a for a, _ in links], pa.string()), "near": pa.array([None] * len(links), pa.int64()),
               "other": pa.array([b for _, b in links], pa.string())}

    met = cut(meet(
        placed.select("block", "vertex", "copies", "vec", "low"), asked, lambda t: Sequence.of(t, eps), work,
        "vertex string, near long, other string", "vertex"))
    counts = met.filter("near is not null").groupBy("vertex").agg(F.sum("near").alias("near"))
    joined = roots(met.filter("other is not null").select(F.col("vertex").alias("a"), F.col("other").alias("b"))).select(
        F.col("ident").alias("vertex"), "root")
    classed = cut(found.select("vertex", "copies", "least").join(counts, "vertex", "left").join(joined, "vertex", "left").select(
        "vertex", (F.col("copies") - 1 + F.coalesce("near", F.lit(0))).alias("n_links"), F.coalesce("root", "vertex").alias("root"), "least"))
    named = classed.join(classed.groupBy("root").agg(F.min("least").alias("component_id")), "root").select(
        "vertex", "n_links", "component_id")
    return rows.select("key", "vertex").join(named, "vertex", "left").select(
        F.col("key").alias(key), F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce("component_id", "key").alias("component_id"), F.coalesce(F.col("key") == F.coalesce("component_id", "key"), F.lit(True)).alias("kept"))
