"""Hard negatives: an inverted multi-index whose cells are visited until their bounds certify the answer.

Components become whole numbers, so scores are exact. Both halves of the vectors are quantised on their own, and
the pairs of ``CENTROIDS`` centroids are cells. An anchor's score with anything in a cell is at most the sum of two half bounds: the score
with the half's centroid plus the anchor's length times the largest distance of an entry's half from that centroid.

1. Positives: each anchor visits cells by falling bound, taken from a heap, some entries at a time; it is done once its last positive's
   score is strictly above the bound of the next cell.
2. Negatives: each positive gives a window of scores. Cells are visited likewise until for every window the last negative wanted is
   strictly above the next bound, or the next bound lies below the window.

A round visits ``GROWTH`` times the entries of the one before, and only anchors that are not certified go on. Bounds are whole
numbers worked out alike everywhere, so a cell belongs to exactly one round. Cells lie in blocks of ``BLOCK`` entries, which
are gathered once a round, with the anchors that need them streaming past.

Rows of equal label and vector score alike, so of each such group only the rows that may be among the first wanted are entries; no
answer is lost, as ties go to the smaller id. Every row whose id is divisible by ``anchors`` is an anchor of its own, and rows, not ids, are told
apart. Rows with a null id, label or vector, with another length than most, with any null or not finite component, or one of
magnitude ``LARGEST`` or more take no part. Anchors without positives or negatives give no rows, nor does an empty table. Extra columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .base import cut, map_batches
from .blocks import matrix, meet

SCALE, LARGEST = 256, 4096.0
CENTROIDS, FIT_ROWS, ROUNDS, SEED = 32, 20_000, 10, 11
BLOCK, GROWTH = 4096, 8
#: Anchors scored against a block at a time.
AT_ONCE = 256
POSITIVES, NEGATIVES = 5, 3
_LEAST, _MOST = np.iinfo(np.int64).min, np.iinfo(np.int64).max


def whole_numbers(vectors: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """``row``, ``key``, ``label`` and ``vec array<long>`` of the rows that take part, labels of every seventh id moved on."""
    rows = vectors.select(
        F.col(key).cast("long").alias("key"), F.col(label).cast("long").alias("label"), F.col(vector).cast("array<double>").alias("vec"))
    rows = rows.filter(
        F.col("key").isNotNull() & F.col("label").isNotNull() & (F.size("vec") > 0)
        & F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < LARGEST)))
    size = rows.agg(F.mode(F.size("vec"), True)).first()[0]
    rows = rows.filter(F.size("vec") == F.lit(size))
    return cut(rows.select(
        F.monotonically_increasing_id().alias("row"), "key",
        F.when(F.col("key") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"),
        F.transform("vec", lambda x: F.floor(x * SCALE)).alias("vec")))


def _nearest(half: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres * centres).sum(axis=1) - 2 * half @ centres.T, axis=1)


def _centroids(half: np.ndarray) -> np.ndarray:
    """k-means with centroids of whole numbers; an empty cluster keeps its centroid."""
    distinct = np.unique(half, axis=0)
    random = np.random.default_rng(SEED)
    centres = distinct[random.choice(len(distinct), min(CENTROIDS, len(distinct)), replace=False)]
    for _ in range(ROUNDS):
        nearest = _nearest(half, centres)
        counts = np.bincount(nearest, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, half)
        centres = np.where(counts[:, None] > 0, np.rint(sums / np.maximum(counts, 1)[:, None]), centres)
    return centres


@dataclass
class Index:
    """Centroids and radii of both halves and how many entries each cell has."""

    first: np.ndarray
    second: np.ndarray
    radii: tuple[np.ndarray, np.ndarray]
    counts: np.ndarray

    def __post_init__(self):
        self.starts = np.cumsum(self.counts) - self.counts

    def bounds(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each vector the most that a half can add to a score, for each centroid; whole numbers."""
        split = vectors.shape[1] // 2
        made = []
        for half, centres, radius in ((vectors[:, :split], self.first, self.radii[0]), (vectors[:, split:], self.second, self.radii[1])):
            length = np.sqrt((half * half).sum(axis=1))
            made.append((half @ centres.T + np.ceil(length[:, None] * radius * (1 + 1e-9))).astype(np.int64))
        return made[0], made[1]

    def block(self, cells: np.ndarray, share: np.ndarray) -> np.ndarray:
        """Block of entries of these cells; ``share`` from 0 to 1 spreads a cell over its blocks."""
        offset = np.minimum((share * self.counts[cells]).astype(np.int64), np.maximum(self.counts[cells] - 1, 0))
        return (self.starts[cells] + offset) // BLOCK

    def blocks(self, cells: list[int]) -> np.ndarray:
        """Blocks that hold entries of the cells."""
        cells = np.array(cells, np.int64)
        first, last = self.starts[cells] // BLOCK, (self.starts[cells] + np.maximum(self.counts[cells], 1) - 1) // BLOCK
        size = last - first + 1
        at = np.repeat(first - np.cumsum(size) + size, size) + np.arange(size.sum())
        return np.unique(at)


def visit(
    first: np.ndarray, second: np.ndarray, counts: np.ndarray, after: int, least: int, wanted: int,
) -> tuple[list[int], int, int]:
    """Cells by falling sum of half bounds: those below ``after`` and not below ``least``, until they hold ``wanted`` entries.

    Returns the cells that hold any, the last bound visited, and the bound of the next cell (the smallest number if there is none).
    All cells of one bound come together.
    """
    rows, columns = np.argsort(-first, kind="stable").tolist(), np.argsort(-second, kind="stable").tolist()
    near, far = first[rows].tolist(), second[columns].tolist()
    width, sizes = len(columns), counts.tolist()
    heap, met, held, last = [(-near[0] - far[0], 0, 0)], [], 0, after
    while heap:
        bound, i, j = heapq.heappop(heap)
        bound = -bound
        if bound < least:
            return met, last, _LEAST
        if bound < after:
            if held >= wanted and bound < last:
                return met, last, bound
            cell = rows[i] * width + columns[j]
            if sizes[cell]:
                met.append(cell)
                held += sizes[cell]
                last = bound
        if j + 1 < width:
            heapq.heappush(heap, (-near[i] - far[j + 1], i, j + 1))
        if j == 0 and i + 1 < len(rows):
            heapq.heappush(heap, (-near[i + 1] - far[0], i + 1, 0))
    return met, last, _LEAST


def index(rows: DataFrame, copies: int) -> tuple[DataFrame, Index]:
    """Entries by block, and the index over them.

    Of rows that are equal in label and vector the first ``copies`` by id are entries.
    """
    spark = rows.sparkSession
    order = Window.partitionBy("label", "vec").orderBy("key", "row")
    kept = rows.withColumn("_copy", F.row_number().over(order)).filter(F.col("_copy") <= copies).drop("_copy")
    sample = rows.orderBy(F.xxhash64("key"), "key", "row").limit(FIT_ROWS).select("vec").toArrow()
    fitted = matrix(sample["vec"])
    split = fitted.shape[1] // 2
    first, second = _centroids(fitted[:, :split]), _centroids(fitted[:, split:])

    def place(batch: pa.RecordBatch) -> dict:
        vectors = matrix(batch.column("vec"))
        a, b = _nearest(vectors[:, :split], first), _nearest(vectors[:, split:], second)
        off = [((half - centres[n]) ** 2).sum(axis=1) for half, centres, n in (
            (vectors[:, :split], first, a), (vectors[:, split:], second, b))]
        return {**{n: batch.column(n) for n in ("row", "key", "label", "vec", "share")},
                "cell": pa.array(a * len(second) + b, pa.int32()), "off_first": pa.array(off[0]), "off_second": pa.array(off[1])}

    share = (F.pmod(F.xxhash64("row"), F.lit(1 << 20)) / (1 << 20)).alias("share")
    placed = cut(map_batches(
        kept.select("row", "key", "label", "vec", share), place,
        "row long, key long, label long, vec array<long>, share double, cell int, off_first double, off_second double"))
    counts, off = np.zeros(len(first) * len(second), np.int64), np.zeros((2, len(first) * len(second)))
    for c in placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("off_first").alias("a"), F.max("off_second").alias("b")).collect():
        counts[c["cell"]], off[0, c["cell"]], off[1, c["cell"]] = c["n"], c["a"], c["b"]
    shape = (len(first), len(second))
    made = Index(first, second, (np.sqrt(off[0].reshape(shape).max(axis=1)), np.sqrt(off[1].reshape(shape).max(axis=0))), counts)
    shared = spark.sparkContext.broadcast(made)
    entries = map_batches(
        placed.select("row", "key", "label", "vec", "share", "cell"),
        lambda b: {"block": pa.array(shared.value.block(np.asarray(b.column("cell")), np.asarray(b.column("share"))), pa.int64()),
                   **{n: b.column(n) for n in ("row", "key", "label", "vec", "cell")}},
        "block long, row long, key long, label long, vec array<long>, cell int")
    return cut(entries), made


_FOUND = "struct<w:int,score:bigint,key:bigint,row:bigint>"


def certified(anchors: DataFrame, entries: DataFrame, made: Index, wanted: int, same: bool) -> DataFrame:
    """``anchors`` with ``found``: for each of its ``windows`` the first ``wanted`` entries with a score in it, all of the
    anchor's label (``same``) or all of another, never the anchor's own row.

    Rounds of visits, until each anchor is certified or has no cells left.
    """
    spark = anchors.sparkSession
    shared = spark.sparkContext.broadcast(made)
    spread = int(spark.conf.get("spark.sql.shuffle.partitions"))
    quota = max(BLOCK, int(made.counts.sum()) // GROWTH ** 2)
    columns = ["row", "label", "vec", "windows", "extra"]
    active = anchors.withColumn("after", F.lit(_MOST)).withColumn("found", F.array().cast(f"array<{_FOUND}>"))
    done = []
    while True:
        def ask(batch: pa.RecordBatch, quota: int = quota) -> dict:
            index = shared.value
            first, second = index.bounds(matrix(batch.column("vec")))
            blocks, reach, following = [], [], []
            for a, b, after, windows in zip(first, second, batch.column("after").to_pylist(), batch.column("windows").to_pylist()):
                least = min((w["low"] for w in windows), default=_MOST)
                met, last, after = visit(a, b, index.counts, after, least, quota)
                blocks.append(index.blocks(met) if met else np.zeros(0, np.int64))
                reach.append(last)
                following.append(after)
            return {"blocks": pa.array(blocks, pa.list_(pa.int64())), "reach": pa.array(reach, pa.int64()),
                    "following": pa.array(following, pa.int64()), **{n: batch.column(n) for n in [*columns, "after", "found"]}}

        fields = ", ".join(f"{n} {active.schema[n].dataType.simpleString()}" for n in [*columns, "after", "found"])
        # Dealt by another expression than the row, and by number, so that few anchors are still many tasks.
        dealt = active.select(*columns, "after", "found").repartition(spread, F.xxhash64(F.lit(SEED), "row"))
        visited = cut(map_batches(dealt, ask, f"blocks array<long>, reach long, following long, {fields}"))
        hits = meet(
            entries, visited.select("blocks", "row", "label", "vec", "windows", "after", "reach"), _Block.of,
            lambda block, batch: block.hits(batch, shared.value, wanted, same),
            "anchor long, w int, score long, key long, row long", "row")
        old = visited.select(F.col("row").alias("anchor"), F.inline("found").alias("w", "score", "key", "row"))
        order = Window.partitionBy("anchor", "w").orderBy(F.desc("score"), "key", "row")
        best = hits.union(old.select("anchor", "w", "score", "key", "row")).withColumn("_n", F.row_number().over(order)).filter(
            F.col("_n") <= wanted)
        best = best.groupBy(F.col("anchor").alias("row")).agg(F.collect_list(F.struct("w", "score", "key", "row")).alias("now"))
        state = visited.drop("blocks", "reach", "after", "found").join(best, "row", "left").withColumn(
            "found", F.coalesce("now", F.array().cast(f"array<{_FOUND}>"))).drop("now")

        def settled(window):
            own = F.filter("found", lambda f: f["w"] == window["w"])
            return (F.col("following") < window["low"]) | (
                (F.size(own) == wanted) & (F.array_min(F.transform(own, lambda f: f["score"])) > F.col("following")))

        state = cut(state.withColumn("settled", (F.col("following") == _LEAST) | F.forall("windows", settled)))
        done.append(state.filter("settled").select(*columns, "found"))
        active = state.filter("not settled").withColumnRenamed("following", "after")
        if active.isEmpty():
            break
        # ``after`` is the bound of the next cell, which is to be visited.
        active = active.withColumn("after", F.col("after") + 1)
        quota *= GROWTH
    result = done[0]
    for more in done[1:]:
        result = result.union(more)
    return result


@dataclass
class _Block:
    rows: np.ndarray
    keys: np.ndarray
    labels: np.ndarray
    cells: np.ndarray
    vectors: np.ndarray

    @classmethod
    def of(cls, entry: pa.Table) -> _Block:
        return cls(*[entry[n].to_numpy() for n in ("row", "key", "label", "cell")], matrix(entry["vec"]))

    def hits(self, batch: pa.RecordBatch, index: Index, wanted: int, same: bool) -> Iterator[dict]:
        """The first ``wanted`` entries of each anchor's windows, in the cells that the anchor visits this round."""
        rows, labels, after, reach = (batch.column(n).to_numpy() for n in ("row", "label", "after", "reach"))
        windows, vectors = batch.column("windows").to_pylist(), matrix(batch.column("vec"))
        width = len(index.second)
        for at in range(0, len(rows), AT_ONCE):
            part = slice(at, at + AT_ONCE)
            first, second = index.bounds(vectors[part])
            bound = first[:, self.cells // width] + second[:, self.cells % width]
            open_ = (bound >= reach[part, None]) & (bound < after[part, None]) & (rows[part, None] != self.rows)
            open_ &= (labels[part, None] == self.labels) == same
            scores = (vectors[part] @ self.vectors.T).astype(np.int64)
            made = []
            for n in range(len(scores)):
                places = np.flatnonzero(open_[n])
                own = scores[n, places]
                for window in windows[at + n]:
                    inside = np.flatnonzero((own >= window["low"]) & (own <= window["high"]))
                    if len(inside) > wanted:
                        least = np.partition(own[inside], len(inside) - wanted)[len(inside) - wanted]
                        inside = inside[own[inside] >= least]
                    spots = places[inside]
                    order = np.lexsort((self.rows[spots], self.keys[spots], -own[inside]))[:wanted]
                    made += [(rows[at + n], window["w"], s, k, r) for s, k, r in zip(
                        own[inside][order].tolist(), self.keys[spots][order].tolist(), self.rows[spots][order].tolist())]
            names = ("anchor", "w", "score", "key", "row")
            yield {name: pa.array([m[i] for m in made], pa.int32() if name == "w" else pa.int64()) for i, name in enumerate(names)}


def mined(
    vectors: DataFrame, anchors: int = 50, positives: int = POSITIVES, negatives: int = NEGATIVES, key: str = "vec_id",
    vector: str = "embedding", label: str = "label",
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank`` from 1, ``negative_id``, ``positive_score`` and ``negative_score``."""
    spark = vectors.sparkSession
    rows = whole_numbers(vectors, key, vector, label)
    asked = rows.filter(F.col("key") % anchors == 0).select("row", "label", "vec", F.col("key").alias("extra"))
    if asked.isEmpty():
        return spark.createDataFrame(
            [], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    # A row more than wanted, as the anchor's own may be among them.
    entries, made = index(rows, max(positives, negatives) + 1)
    everything = F.array(F.struct(F.lit(0).alias("w"), F.lit(_LEAST).alias("low"), F.lit(_MOST).alias("high")))
    near = certified(asked.withColumn("windows", everything), entries, made, positives, same=True)
    # From 50 p <= 100 n <= 95 p; a positive below 0 leaves no room.
    ordered = F.array_sort("found", lambda a, b: F.when(a["score"] != b["score"], F.when(a["score"] > b["score"], -1).otherwise(1)).when(
        a["key"] != b["key"], F.when(a["key"] < b["key"], -1).otherwise(1)).otherwise(F.when(a["row"] < b["row"], -1).otherwise(1)))
    near = near.withColumn("found", ordered).select(
        "row", "label", "vec", F.struct(F.col("extra").alias("key"), F.col("found").alias("positives")).alias("extra"))
    windows = F.transform(F.filter("extra.positives", lambda p: p["score"] >= 0), lambda p, i: F.struct(
        i.cast("int").alias("w"), F.floor((p["score"] + 1) / 2).cast("long").alias("low"),
        F.floor(p["score"].cast("decimal(30,0)") * 95 / 100).cast("long").alias("high")))
    mined_ = certified(near.withColumn("windows", windows), entries, made, negatives, same=False)
    flat = mined_.select("row", "extra", F.inline("found").alias("w", "negative_score", "negative_id", "negative_row"))
    order = Window.partitionBy("row", "w").orderBy(F.desc("negative_score"), "negative_id", "negative_row")
    positive = F.col("extra.positives")[F.col("w")]
    return flat.select(
        F.col("extra.key").alias("anchor_id"), positive["key"].alias("positive_id"), F.row_number().over(order).alias("rank"),
        "negative_id", positive["score"].alias("positive_score"), "negative_score")
