"""Bucketed tables: joins that leave the stored side where it is, and the jobs on them."""

import re
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from hunian.operators import keys as K
from hunian.plans.batch import run_batch
from hunian.plans.store import Store, raw_facilities
from hunian.sources import bucketed
from hunian.streaming import progress
from tests.html_fixtures import SITE
from tests.test_batch import NOW, pages_table, places_table
from tests.test_operators import conf, plan  # noqa: F401


def stored(spark, root, batches=3):
    rows = spark.range(300).select(F.concat(F.lit("d"), "id").alias("kecamatan"), F.col("id").alias("n"))
    for b in range(batches):
        bucketed.append(rows.filter(F.col("n") % batches == b), root, "kecamatan", 8)
    return bucketed.attach(spark, root, rows.schema, "kecamatan")


def above(text, node):
    """Lines of the plan's nodes that the rows of ``node`` pass through."""
    lines = text.split("\n")
    at = next(n for n, line in enumerate(lines) if node in line)
    depth, found = len(re.match(r"[\s:+\-]*", lines[at])[0]), []
    for line in reversed(lines[:at]):
        if (own := len(re.match(r"[\s:+\-]*", line)[0])) < depth:
            found.append(line)
            depth = own
    return found


@pytest.mark.parametrize("join", [
    lambda stored, wanted: K.stored_rows(stored, wanted, "kecamatan"),
    lambda stored, wanted: K.missing_keys(wanted, stored, "kecamatan"),
])
def test_the_stored_side_is_not_exchanged(spark, conf, tmp_path, join):  # noqa: F811
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")
    table = stored(spark, str(tmp_path / "t"))
    wanted = spark.range(0, 900, 2).select(F.concat(F.lit("d"), F.col("id")).alias("kecamatan"))
    made = join(table, wanted)
    text = plan(made).split("Physical Plan")[1]
    assert "Bucketed: true" in text and not any("Exchange" in line for line in above(text, "FileScan"))
    got = sorted(r["kecamatan"] for r in made.collect())
    names = [f"d{i}" for i in (range(0, 300, 2) if "n" in made.columns else range(300, 900, 2))]
    assert got == sorted(names)


def test_batches_add_a_file_to_a_bucket_at_most(spark, tmp_path):
    table = stored(spark, str(tmp_path / "t"), 3)
    assert table.count() == 300 and len(table.inputFiles()) <= 3 * 8
    assert bucketed.buckets_of(spark, str(tmp_path / "t")) == 8 and bucketed.attach(spark, str(tmp_path / "none"), table.schema, "kecamatan") is None
    spark.sql(f"DROP TABLE {bucketed._name(str(tmp_path / 't'))}")
    again = bucketed.attach(spark, str(tmp_path / "t"), table.schema, "kecamatan")
    assert again.count() == 300


def test_jobs_on_a_bucketed_store_give_the_same_tables(spark, tmp_path):
    results = []
    for name, fmt in (("plain", ""), ("bucketed", "bucketed")):
        store = replace(Store.under(str(tmp_path / name)), facilities_format=fmt)
        progress.init_progress(spark, store.progress, ["bali", "riau", "aceh"])
        done = [run_batch(spark, store, pages_table(spark), places_table(spark), SITE, now=NOW) for _ in range(2)]
        clean = spark.read.parquet(store.clean_facilities)
        results.append((done, sorted(map(str, raw_facilities(spark, store).collect())), sorted(map(str, clean.collect()))))
    assert results[0] == results[1] and results[0][1]
