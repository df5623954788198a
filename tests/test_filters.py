"""Counts by a table of filters against counts by patterns."""

import random

import pytest
from pyspark.sql import functions as F

from hunian.operators import facilities as A
from tests.test_operators import conf, plan  # noqa: F401

TABLE = "filter int, category string, tag string, literal string"


@pytest.mark.parametrize("whole", [False, True])
def test_table_equals_patterns(spark, whole):
    random.seed(8)
    values = ["park", "parking", "school", "driving_school", "university|x", "mall", "shopping_mall", "", None, "taxi", "station", "halt station"]
    tags = ["amenity", "shop", "aeroway", "railway", "leisure"]
    rows = [(random.choice(["A", "A", "B", None]), *[random.choice(values) for _ in tags]) for _ in range(400)]
    places = spark.createDataFrame(rows, "kecamatan string, " + ", ".join(f"{t} string" for t in tags))
    filters = spark.createDataFrame(A.filter_rows() + A.filter_rows()[:3] + [(99, "none", "unknown", "park"), (98, "none", "shop", "")], TABLE)
    found = {(r["kecamatan"], r["category"]): r["n"] for r in A.count_by_table(places, filters, whole_value=whole).collect()}
    wanted = {}
    for r in A.count_places(places, whole_value=whole).collect():
        wanted |= {(r["kecamatan"], c): n for c, n in r.asDict().items() if c != "kecamatan" and n}
    assert found == wanted and len(found) >= 8


def test_the_plan_does_not_grow_with_the_filters(spark, conf):  # noqa: F811
    conf(spark__sql__adaptive__enabled="false")
    places = spark.createDataFrame([("A", "school", "mall")], "kecamatan string, amenity string, shop string")
    sizes = []
    for many in (9, 1000):
        filters = spark.range(many).select(
            F.col("id").cast("int").alias("filter"), F.concat(F.lit("c"), F.col("id") % 5).alias("category"), F.get(F.array(F.lit("amenity"), F.lit("shop")), F.col("id") % 2).alias("tag"),
            F.concat(F.lit("sch"), F.col("id")).alias("literal"))
        text = plan(A.count_by_table(places, filters)).split("Physical Plan")[1]
        assert "RLIKE" not in text and "CartesianProduct" not in text and "NestedLoop" not in text
        sizes.append(text.count("\n"))
    assert sizes[0] == sizes[1]
