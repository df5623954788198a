"""Places inside areas against the plain even-odd rule."""

import math
import random

import pytest
from pyspark.sql import functions as F

from hunian.operators import areas as AR, facilities as A
from tests.test_operators import conf, final_plan, plan  # noqa: F401

AREAS = "kecamatan string, rings array<array<struct<x double, y double>>>"
PLACES = "id int, lon double, lat double, kecamatan string, cx int"


def inside(rings, x, y):
    odd = False
    for ring in rings:
        ring = [p for p in ring if p[0] is not None and p[1] is not None]
        if len(ring) < 3:
            continue
        for (x1, y1), (x2, y2) in zip(ring, [*ring[1:], ring[0]]):
            if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                odd = not odd
    return odd


def made_areas(seed):
    random.seed(seed)
    made = []
    for n in range(12):
        cx, cy, corners = random.uniform(-5, 5), random.uniform(-5, 5), random.randint(3, 14)
        ring = [(cx + r * math.cos(2 * math.pi * i / corners), cy + r * math.sin(2 * math.pi * i / corners))
                for i in range(corners) for r in [random.uniform(0.1, 4)]]
        made.append((f"d{n}", [ring, [(cx - 0.3, cy - 0.3), (cx + 0.3, cy - 0.3), (cx, cy + 0.3)]]))
    made += [("square", [[(0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 2.0), (0.0, 0.0)]]), ("beside", [[(2.0, 0.0), (4.0, 0.0), (4.0, 2.0), (2.0, 2.0)]]),
             ("none", None), ("empty", []), ("line", [[(0.0, 0.0), (1.0, 1.0)]]), ("gap", [[(0.0, 0.0), (None, 1.0), (1.0, 0.0), (1.0, 1.0)]])]
    return made


@pytest.mark.parametrize("cell", [0.05, 0.7, 100.0])
def test_places_within_equals_the_plain_rule(spark, cell):
    made = made_areas(3)
    points = [(i, random.uniform(-9, 9), random.uniform(-9, 9)) for i in range(400)]
    points += [(1000 + i, *p) for i, p in enumerate([(0.0, 0.0), (2.0, 1.0), (2.0, 0.0), (1.0, 2.0), (0.0, 1.0), (4.0, 2.0), (0.7, 0.7), (-0.7, 1.4)])]
    areas = spark.createDataFrame(made, AREAS)
    places = spark.createDataFrame(
        [(*p, "old", 7) for p in points] + [(-1, None, 1.0, None, None), (-2, 1.0, None, None, None), (-3, float("nan"), 1.0, None, None)], PLACES)
    found = AR.places_within(places, areas, cell=cell)
    assert found.columns == ["id", "lon", "lat", "cx", "kecamatan"]
    got = sorted((r["id"], r["kecamatan"]) for r in found.collect())
    assert got == sorted((i, name) for i, x, y in points for name, rings in made if rings and inside(rings, x, y))
    assert sum(1 for i, name in got if i == 1001 and name in ("square", "beside")) == 1
    assert AR.places_within(places.limit(0), areas, cell=cell).count() == 0 and AR.places_within(places, areas.limit(0), cell=cell).count() == 0


def test_counts_of_places_by_area(spark):
    areas = spark.createDataFrame([("A", [[(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0)]])], AREAS)
    places = spark.createDataFrame([(0.5, 0.5, "school"), (0.2, 0.9, "driving_school"), (2.0, 0.5, "school")], "lon double, lat double, amenity string")
    counts = A.count_places(AR.places_within(places, areas), filters=[("n", "amenity", "school")])
    assert [tuple(r) for r in counts.collect()] == [("A", 2)]


def test_points_are_shuffled_once(spark, conf):  # noqa: F811
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")
    places = spark.range(100).select(F.col("id").cast("double").alias("lon"), F.lit(0.5).alias("lat"))
    areas = spark.createDataFrame(made_areas(1), AREAS)
    text = plan(AR.places_within(places, areas)).split("Physical Plan")[1]
    assert text.count("Exchange hashpartitioning(_cx") == 1 and "CartesianProduct" not in text and "Python" not in text
    conf(spark__sql__autoBroadcastJoinThreshold="10MB")
    text = plan(AR.places_within(places, areas.limit(3))).split("Physical Plan")[1]
    assert "Exchange hashpartitioning(_cx" not in text


def test_hot_cell_is_split(spark, conf, tmp_path):  # noqa: F811
    """A third of all places in one cell are spread over several tasks."""
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__advisoryPartitionSizeInBytes="64KB",
         spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="64KB",
         spark__sql__adaptive__skewJoin__skewedPartitionFactor="2", spark__sql__shuffle__partitions="16",
         spark__sql__adaptive__coalescePartitions__parallelismFirst="false")
    spark.range(90_000, numPartitions=12).select(
        F.when(F.col("id") % 3 == 0, 1.5).otherwise(F.col("id") % 97 / F.lit(10.0)).alias("lon"),
        F.when(F.col("id") % 3 == 0, 1.5).otherwise(F.col("id") % 89 / F.lit(10.0)).alias("lat"),
        F.sha1(F.col("id").cast("string")).alias("v")).write.parquet(str(tmp_path / "places"))
    places = spark.read.parquet(str(tmp_path / "places"))
    areas = spark.createDataFrame([("A", [[(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0)]])], AREAS)
    got, text = final_plan(AR.places_within(places, areas, cell=0.5))
    assert "skew=true" in text and "SortMergeJoin" in text
    assert len(got) == places.filter("lon < 4 and lat < 4").count()


@pytest.mark.parametrize("cell,levels", [(0.7, 0), (0.7, 3), (100.0, 4), (2.0, None)])
def test_counts_within_equal_those_of_the_pairs(spark, cell, levels):
    """Places on borders, on cell corners and many on one spot; negative coordinates; sums with nulls."""
    made = made_areas(5) + [(None, [[(-3.0, -3.0), (3.0, -3.0), (0.0, 3.0)]])]
    points = [(random.uniform(-9, 9), random.uniform(-9, 9), n % 5 or None) for n in range(600)]
    points += [(0.7, -0.7, 2), (2.0, 1.0, 3), (0.0, 0.0, None), (None, 1.0, 4), (float("nan"), 1.0, 4)] * 30
    places = spark.createDataFrame(points, "lon double, lat double, lines int").withColumn("other", F.lit("x"))
    areas = spark.createDataFrame(made, AREAS)
    pairs = AR.places_within(places, areas, cell=0.7).groupBy("kecamatan").agg(F.count("*"), F.sum("lines"))
    found = AR.counts_within(places, areas, ("lines",), cell=cell, levels=levels)
    assert found.columns == ["kecamatan", "n_places", "lines"]
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, map(tuple, pairs.collect())))
    assert AR.counts_within(places.limit(0), areas, cell=cell, levels=levels).count() == 0


def test_counts_within_broadcast_no_cells(spark, conf, tmp_path):  # noqa: F811
    """A file of few bytes may hold areas of very many cells, which Spark cannot foresee."""
    conf(spark__sql__autoBroadcastJoinThreshold="10MB")
    spark.createDataFrame(made_areas(1), AREAS).write.parquet(str(tmp_path / "areas"))
    places = spark.range(100).select(F.col("id").cast("double").alias("lon"), F.lit(0.5).alias("lat"))
    got, text = final_plan(AR.counts_within(places, spark.read.parquet(str(tmp_path / "areas")), cell=0.7, levels=1))
    assert got and "SortMergeJoin" in text and "Broadcast" not in text
