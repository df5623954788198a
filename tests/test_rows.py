"""Bad rows beside good ones, file names, and what the entry module leaves out."""

import os
import subprocess
import sys
from collections import Counter

import pytest
from pyspark.sql import functions as F

from hunian.plans.store import Store, adopt_csv_tree
from hunian.schemas import LISTING_REQUIRED
from hunian.sources import files, listings, sinks

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


@pytest.fixture
def tree(tmp_path):
    write(tmp_path / "t" / "a.csv", 'k,v\n1,x\n2\n3,y,z\n,w\n"4","a ""q"",\nb"\n5,\n')
    write(tmp_path / "t" / "b.csv", "v,more,k\nx,,6\nx,7\n")
    write(tmp_path / "t" / "c.csv", "other,v\n1,2\n\n3,4\n")
    return str(tmp_path / "t")


def test_rows_are_good_or_bad_with_a_reason(spark, tree, tmp_path):
    rows = files.read_rows(spark, tree, ["k"])
    counts = sinks.write_split(rows, str(tmp_path / "split"))
    good = spark.read.parquet(sinks.split_path(str(tmp_path / "split"), True))
    bad = spark.read.parquet(sinks.split_path(str(tmp_path / "split"), False))
    assert sorted((r["k"], r["v"], r["more"]) for r in good.collect()) == [
        ("1", "x", None), ("4", 'a "q",\nb', None), ("5", None, None), ("6", "x", None)]
    found = sorted((r["_file"][-5:], r["_reason"], r["_line"]) for r in bad.collect())
    assert found == [("a.csv", "fields", "2"), ("a.csv", "fields", "3,y,z"), ("a.csv", "no value of k", ",w"), ("b.csv", "fields", "x,7"),
                     ("c.csv", "no column k", "1,2"), ("c.csv", "no column k", "3,4")]
    by_file = Counter()
    for r in counts.collect():
        by_file[r["file"][-5:]] += r["rows"]
    assert by_file == {"a.csv": 6, "b.csv": 2, "c.csv": 2}


def test_adopting_a_tree_with_bad_rows(spark, tmp_path):
    header = ",".join(LISTING_REQUIRED)
    filled = ",".join(["x"] * (len(LISTING_REQUIRED) - 1))
    write(tmp_path / "csv" / "raw_listings" / "bali" / "page_1_bali.csv", f"{header}\nVilla,{filled}\nshort,row\n,{filled}\n")
    write(tmp_path / "csv" / "raw_listings" / "riau" / "page_2_riau.csv", f"nothing,useful\n1,2\n")
    source, target = Store.under(str(tmp_path / "csv"), raw_format="csv"), Store.under(str(tmp_path / "store"))
    for _ in range(2):
        assert adopt_csv_tree(spark, source, target, str(tmp_path / "split")) == (1, 0)
    rows = listings.read_all(spark, target.raw_listings).select("judul_iklan", "province", "page").collect()
    assert [tuple(r) for r in rows] == [("Villa", "bali", 1)]
    reasons = spark.read.parquet(sinks.split_path(str(tmp_path / "split"), False)).select("_reason").collect()
    assert sorted(r[0] for r in reasons) == ["fields", "no column judul_iklan", "no value of judul_iklan"]


def test_file_names_differ_as_texts_do(spark):
    texts = ["A/B", "A_B", "A\\B", "A:B", "A%2FB", "A%B", ".hidden", "_hidden", "hidden", "", "%", "Kebon Jeruk", "é", "."]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", files.file_name(F.col("t")).alias("n")).collect()
    names = {r["t"]: r["n"] for r in rows}
    assert len(set(names.values())) == len(texts)
    assert not any(set(n) & set("/\\:") or n[0] in "._" for n in names.values())
    assert names["Kebon Jeruk"] == "Kebon Jeruk" and names["A/B"] == "A%2FB" and names["A%2FB"] == "A%252FB"


def test_entry_without_what_the_numbered_operators_need():
    """A missing library costs the numbered queries only."""
    code = ("import sys; sys.modules['public_tokenizers'] = None\n"
            "import __spark_entry__ as e; print(len(e.queries()), any(n.startswith('op') for n in e.queries()))")
    said = subprocess.run([sys.executable, "-c", code], cwd=REPO, capture_output=True, text=True, timeout=120)
    count, numbered = said.stdout.split()
    assert int(count) > 50 and numbered == "False"


def test_broken_tree_is_written_by_many_tasks(spark, tmp_path, monkeypatch):
    """Files of a status come from all tasks that read its orders, each with its header; lines are as they were made."""
    from hunian.plans import guards
    from hunian.sources.files import fresh
    rows = [(n, n % 50, "FOP"[n % 3]) for n in range(300)]
    orders = spark.createDataFrame(rows, "o_orderkey long, o_custkey long, o_orderstatus string")
    orders.repartition(4).write.parquet(str(tmp_path / "orders.parquet"))
    monkeypatch.setattr(guards, "_scratch", lambda spark, name: fresh(str(tmp_path), name))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1KB")
    try:
        tree = guards._broken_tree(spark, str(tmp_path))
        assert tree.select("_file").distinct().count() > 3
        assert tree.count() == 300
        counts = {(r["file"], r["reason"]): r["rows"] for r in guards.split_counts(spark, str(tmp_path)).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sum(counts.values()) == 300 and counts["P", "no column judul_iklan"] == 100 and len(counts) == 7
