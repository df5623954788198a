"""The province dimension joined to stored listings."""

from pyspark.sql import functions as F

from hunian.operators import provinces as PV
from hunian.schemas import PROVINCES
from tests.test_operators import final_plan


def test_slugs(spark):
    names = [p.replace("-", " ").title() for p in PROVINCES] + ["  DKI  Jakarta ", "Nusa-Tenggara (Barat)", None, ""]
    rows = spark.createDataFrame([(n,) for n in names], "n string").select(PV.slug(F.col("n"))).collect()
    assert [r[0] for r in rows] == [*PROVINCES, "dki-jakarta", "nusa-tenggara-barat", None, ""]


def test_a_condition_on_the_dimension_prunes_folders(spark, tmp_path):
    root = str(tmp_path / "listings")
    spark.range(340).select("id", F.get(F.array(*map(F.lit, PROVINCES)), F.col("id") % 34).alias("province"), F.lit(1).alias("ump")).write.partitionBy(
        "province").parquet(root)
    spark.createDataFrame([(p.replace("-", " ").title(), n, n * 10) for n, p in enumerate(PROVINCES)], "provinsi string, ump int, pdrb int").write.parquet(
        str(tmp_path / "provinces"))
    provinces = spark.read.parquet(str(tmp_path / "provinces")).filter("pdrb > 300")
    made = PV.with_province(spark.read.parquet(root), provinces)
    assert made.columns == ["id", "ump", "province", "pdrb"]
    rows, text = final_plan(made)
    assert "dynamicpruning" in text and "BroadcastHashJoin" in text
    assert {(r["province"], r["pdrb"]) for r in rows} == {(PROVINCES[n], n * 10) for n in (31, 32, 33)} and len(rows) == 30
    scan = made._jdf.queryExecution().executedPlan()
    opened = [leaf for leaf in _leaves(scan) if "dynamicpruning" in leaf.toString()]
    assert opened and opened[0].metrics().apply("numPartitions").value() == 3


def _leaves(plan):
    if "AdaptiveSparkPlan" in plan.getClass().getSimpleName():
        plan = plan.executedPlan()
    found = plan.collectLeaves()
    leaves = []
    for n in range(found.size()):
        leaf = found.apply(n)
        leaves += _leaves(leaf.plan()) if "QueryStage" in leaf.getClass().getSimpleName() else [leaf]
    return leaves
