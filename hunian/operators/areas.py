"""Places inside the area of a district: points and polygons meet in the cells of a grid.

A polygon is cut to the cells it touches. A cell that no edge passes is inside or outside as a whole, and outside
ones are dropped; a cell on the border keeps the edges that a ray from it to the right can cross. Points are joined by their cell, and only those
in border cells are tested edge by edge (even-odd rule, so rings may be holes). Everything is an expression; points are shuffled once, by
cell, or not at all where the cells are few enough for a broadcast. A cell with very many points is split by AQE, as both
sides come straight from their shuffle.

A point is inside if an odd number of edges cross its ray, an edge from (x1, y1) to (x2, y2) where ``(y1 > y) <> (y2 > y)`` and
``x < (x2 - x1) * (y - y1) / (y2 - y1) + x1``. So of two areas with a common border a point on it is in one.
Counting needs no pairs: ``counts_within`` quarters border cells until few points are in one, takes the totals of
whole cells, and tests points, each place of several rows once, in the last border cells only. Its cells are never broadcast.

Points without coordinates, areas without rings and rings of null corners are in no area or hold no points.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Side of a grid cell in the unit of the coordinates; districts are some cells wide.
CELL = 0.05
#: By so much of a cell's side rounding may move where an edge leaves a band.
SLACK = 1e-6
#: Border cells are quartered until about so many points are in one, and so often at most.
POINTS, LEVELS = 8, 10


def _crosses(edge: Column, x: Column, y: Column) -> Column:
    """Whether the ray from the point to the right crosses the edge."""
    spans = (edge["y1"] > y) != (edge["y2"] > y)
    at = (edge["x2"] - edge["x1"]) * (y - edge["y1"]) / F.nullif(edge["y2"] - edge["y1"], F.lit(0.0)) + edge["x1"]
    return F.when(spans, x < at).otherwise(False)


def _odd(edges: Column, x: Column, y: Column) -> Column:
    return F.aggregate(edges, F.lit(False), lambda inside, edge: inside != _crosses(edge, x, y))


def edges_of(areas: DataFrame, key: str = "kecamatan", rings: str = "rings") -> DataFrame:
    """``key`` and the edges ``x1, y1, x2, y2`` of every ring (an array of points ``x``, ``y``), closed or not."""
    corners = areas.select(key, F.explode(rings).alias("_ring")).select(
        key, F.filter("_ring", lambda p: p["x"].isNotNull() & p["y"].isNotNull()).alias("_ring")).filter(F.size("_ring") > 2)
    after = F.concat(F.slice("_ring", 2, F.size("_ring") - 1), F.slice("_ring", 1, 1))
    return corners.select(key, F.inline(F.zip_with("_ring", after, lambda a, b: F.struct(
        a["x"].cast("double").alias("x1"), a["y"].cast("double").alias("y1"),
        b["x"].cast("double").alias("x2"), b["y"].cast("double").alias("y2")))))


def cells_of(areas: DataFrame, key: str = "kecamatan", rings: str = "rings", cell: float = CELL) -> DataFrame:
    """``cx, cy, key, whole, edges``: the cells that hold a part of an area.

    Edges are cut to the rows of the grid first and gathered by area and row, so nothing holds a whole area's border.
    """
    side, slack = F.lit(cell), F.lit(cell * SLACK)
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    rows = edges_of(areas, key, rings).withColumn("cy", F.explode(F.sequence(F.floor(low / side), F.floor(high / side))))
    # Where the edge enters and leaves the row, a little wider.
    slope = (F.col("x2") - F.col("x1")) / F.nullif(F.col("y2") - F.col("y1"), F.lit(0.0))
    bottom, top = F.greatest(low, F.col("cy") * side), F.least(high, (F.col("cy") + 1) * side)
    ends = [F.coalesce(F.col("x1") + (y - F.col("y1")) * slope, x) for y, x in ((bottom, F.col("x1")), (top, F.col("x2")))]
    rows = rows.withColumns({"from": F.least(*ends) - slack, "to": F.greatest(*ends) + slack})
    bands = rows.groupBy(key, "cy").agg(
        F.collect_list(F.struct("x1", "y1", "x2", "y2", "from", "to")).alias("edges"), F.min("from").alias("from"), F.max("to").alias("to"))
    cells = bands.withColumn("cx", F.explode(F.sequence(F.floor(F.col("from") / side), F.floor(F.col("to") / side))))
    left, right = F.col("cx") * side, (F.col("cx") + 1) * side
    border = F.exists("edges", lambda e: (e["from"] <= right) & (e["to"] >= left))
    middle = _odd(F.col("edges"), left + side / 2, (F.col("cy") + F.lit(0.5)) * side)
    kept = F.transform(F.filter("edges", lambda e: e["to"] >= left), lambda e: F.struct(
        e["x1"].alias("x1"), e["y1"].alias("y1"), e["x2"].alias("x2"), e["y2"].alias("y2")))
    return cells.withColumn("whole", ~border).filter(~F.col("whole") | middle).select(
        "cx", "cy", key, "whole", F.when(~F.col("whole"), kept).alias("edges"))


def _quartered(cells: DataFrame, level: int, side: float) -> DataFrame:
    """Border cells of ``cells`` (as of ``cells_of``, with ``level``) cut to the cells of half their side, now ``side``; whole ones stay."""
    cells = cells.withColumn("_part", F.explode(F.when(F.col("whole"), F.array(F.lit(0))).otherwise(F.array(*map(F.lit, range(4))))))
    half = {c: F.when(F.col("whole"), F.col(c)).otherwise(2 * F.col(c) + part) for c, part in (
        ("cx", F.col("_part") % 2), ("cy", F.floor(F.col("_part") / 2)))}
    cells = cells.withColumns({**half, "level": F.when(F.col("whole"), F.col("level")).otherwise(F.lit(level))})
    left, right = F.col("cx") * F.lit(side), (F.col("cx") + 1) * F.lit(side)
    bottom, top = F.col("cy") * F.lit(side), (F.col("cy") + 1) * F.lit(side)
    slack = F.lit(side * SLACK)

    def ends(edge: Column) -> list[Column]:
        """Where the edge enters and leaves the row, as in ``cells_of``."""
        low, high = F.least(edge["y1"], edge["y2"]), F.greatest(edge["y1"], edge["y2"])
        slope = (edge["x2"] - edge["x1"]) / F.nullif(edge["y2"] - edge["y1"], F.lit(0.0))
        return [F.coalesce(edge["x1"] + (y - edge["y1"]) * slope, x) for y, x in (
            (F.greatest(low, bottom), edge["x1"]), (F.least(high, top), edge["x2"]))]

    def met(edge: Column) -> Column:
        low, high = F.least(edge["y1"], edge["y2"]), F.greatest(edge["y1"], edge["y2"])
        return (F.floor(low / side) <= F.col("cy")) & (F.floor(high / side) >= F.col("cy")) & (F.greatest(*ends(edge)) + slack >= left)

    cells = cells.withColumn("edges", F.when(~F.col("whole"), F.filter("edges", met)))
    border = F.exists("edges", lambda edge: F.least(*ends(edge)) - slack <= right)
    middle = _odd(F.col("edges"), left + F.lit(side / 2), bottom + F.lit(side / 2))
    cells = cells.withColumn("_state", F.when(F.col("whole"), 1).when(border, 0).when(middle, 1))
    return cells.filter("_state is not null").withColumn("whole", F.col("_state") == 1).withColumn(
        "edges", F.when(~F.col("whole"), F.col("edges"))).drop("_part", "_state")


def counts_within(
    places: DataFrame, areas: DataFrame, sums: tuple[str, ...] = (), x: str = "lon", y: str = "lat", key: str = "kecamatan",
    rings: str = "rings", cell: float = CELL, levels: int | None = None,
) -> DataFrame:
    """``key``, ``n_places`` and the sum of each column of ``sums`` for every area that holds places.

    As many as a count by ``key`` over ``places_within`` gives, without a row for each place and area: the cells of an area's
    border are met with the points in them, all others with the totals of their places. ``levels`` is how often border cells are quartered;
    without it the mean number of points in a cell decides.
    """
    at = {"_x": F.col(x).cast("double"), "_y": F.col(y).cast("double")}
    rows = places.withColumns(at).filter(F.col("_x").isNotNull() & F.col("_y").isNotNull() & ~F.isnan("_x") & ~F.isnan("_y"))

    def cell_of(side: float) -> dict[str, Column]:
        return {"_cx": F.floor(F.col("_x") / F.lit(side)), "_cy": F.floor(F.col("_y") / F.lit(side))}

    if levels is None:
        seen = rows.withColumns(cell_of(cell)).agg(
            F.approx_count_distinct(F.xxhash64("_x", "_y")).alias("points"), F.approx_count_distinct(F.xxhash64("_cx", "_cy")).alias("cells")).first()
        mean = seen["points"] / max(seen["cells"], 1)
        levels = min(LEVELS, max(0, round(math.log(max(mean, 1) / POINTS, 4))))
    names = {f"_sum{n}": c for n, c in enumerate(sums)}
    folded = [F.sum("_n").alias("_n"), *[F.sum(s).alias(s) for s in names]]
    points = rows.groupBy("_x", "_y").agg(F.count("*").alias("_n"), *[F.sum(c).alias(s) for s, c in names.items()]).withColumns(
        cell_of(cell / 2**levels))
    finest = points.groupBy("_cx", "_cy").agg(*folded)
    # Sides are halved, so a cell's number is that of the cell of the level above, twice over.
    up = F.explode(F.sequence(F.lit(0), F.lit(levels)))
    totals = finest.withColumn("_up", up).groupBy(
        (F.lit(levels) - F.col("_up")).alias("_level"), F.expr("shiftright(_cx, _up)").alias("_cx"), F.expr("shiftright(_cy, _up)").alias("_cy")).agg(*folded)
    # A border cell meets points, which have a level of their own.
    met = totals.withColumns({"_x": F.lit(None).cast("double"), "_y": F.lit(None).cast("double")}).unionByName(points.withColumn("_level", F.lit(-1)))
    cells = cells_of(areas, key, rings, cell).withColumn("level", F.lit(0))
    for level in range(1, levels + 1):
        cells = _quartered(cells, level, cell / 2**level)
    cells = cells.withColumn("level", F.when(F.col("whole"), F.col("level")).otherwise(F.lit(-1)))
    inside = F.col("whole") | _odd(F.col("edges"), F.col("_x"), F.col("_y"))
    # Spark takes the cells for as few as the areas, whose rings it was given; a broadcast of them could be far larger than the driver.
    found = met.join(cells.hint("merge"), (F.col("_level") == F.col("level")) & (F.col("_cx") == F.col("cx")) & (F.col("_cy") == F.col("cy"))).filter(inside)
    return found.groupBy(key).agg(F.sum("_n").alias("n_places"), *[F.sum(s).alias(c) for s, c in names.items()])


def places_within(
    places: DataFrame, areas: DataFrame, x: str = "lon", y: str = "lat", key: str = "kecamatan", rings: str = "rings",
    cell: float = CELL,
) -> DataFrame:
    """``places`` with the ``key`` of each area they lie in: a row for each area, none for places in no area.

    Pass only the areas that are asked for (``places_in`` picks a country and level). A ``key`` column of the places is replaced.
    """
    side = F.lit(cell)
    at = {n: F.col(f"_place.{c}").cast("double") for n, c in (("_x", x), ("_y", y))}
    points = places.drop(key).select(F.struct("*").alias("_place")).withColumns(at).filter(
        F.col("_x").isNotNull() & F.col("_y").isNotNull() & ~F.isnan("_x") & ~F.isnan("_y")).withColumns(
        {"_cx": F.floor(F.col("_x") / side), "_cy": F.floor(F.col("_y") / side)})
    cells = cells_of(areas, key, rings, cell)
    inside = F.col("whole") | _odd(F.col("edges"), F.col("_x"), F.col("_y"))
    return points.join(cells, (F.col("_cx") == F.col("cx")) & (F.col("_cy") == F.col("cy"))).filter(inside).select("_place.*", key)
