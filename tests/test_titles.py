"""The title store against sets, what it opens, and the extract job with it."""

from dataclasses import replace

from pyspark.sql import functions as F

from hunian.plans.extract import extract_page, index_titles
from hunian.plans.store import Store
from hunian.sources import listings, titles as T
from hunian.streaming import progress
from tests.html_fixtures import BASE, SITE, card, detail, search
from tests.test_batch import NOW, pages_table


def named(spark, names):
    return spark.createDataFrame([(n,) for n in names], "judul_iklan string")


def known(spark, root, names):
    return sorted(r[0] for r in T.known_among(spark, root, named(spark, names)).collect())


def test_store_like_a_set(spark, tmp_path):
    root = str(tmp_path / "titles")
    assert known(spark, root, ["a", None]) == []
    T.add(spark, root, named(spark, ["a", "b", None, "a", "", "é"]))
    T.add(spark, root, named(spark, ["b", "c d", "a"]))
    T.add(spark, root, named(spark, ["b"]))
    assert known(spark, root, ["a", "a", "c d", "é", "", "x", None, "A"]) == ["", "a", "c d", "é"]
    assert sorted(r[0] for r in spark.read.parquet(f"{root}/titles").select("judul_iklan").collect()) == ["", "a", "b", "c d", "é"]
    assert known(spark, root, []) == []


def test_many_titles_at_once(spark, tmp_path):
    """More than go to the scan as literals; bits of a title may come from several batches."""
    root = str(tmp_path / "titles")
    for start in (0, 300):
        T.add(spark, root, named(spark, [f"t{i}" for i in range(start, start + 500)]))
    asked = [f"t{i}" for i in range(700, 1300)]
    assert known(spark, root, asked) == sorted(f"t{i}" for i in range(700, 800))
    assert known(spark, root, [f"t{i}" for i in range(2000)]) == sorted(f"t{i}" for i in range(800))


def test_only_buckets_that_may_hold_a_title_are_read(spark, tmp_path):
    root = str(tmp_path / "titles")
    T.add(spark, root, named(spark, [f"t{i}" for i in range(4000)]))
    everything = len(spark.read.parquet(f"{root}/titles").inputFiles())
    assert everything > 200
    asked = named(spark, ["t1", "t2", *[f"new{i}" for i in range(300)]])
    assert {"t1", "t2"} <= {r[0] for r in T.may_hold(spark, root, asked).collect()}
    assert T.may_hold(spark, root, asked).count() < 8
    found = T.known_among(spark, root, asked)
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(title_bucket" in text or "title_bucket#" in text.split("PartitionFilters")[1][:200]
    assert "PushedFilters: [In(hash" in text or "In(hash" in text or "EqualTo(hash" in text
    found.write.format("noop").mode("overwrite").save()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert sorted(r[0] for r in found.collect()) == ["t1", "t2"], plan
    opened = spark.read.parquet(f"{root}/titles").filter(F.col(T.BUCKET).isin([r[0] for r in T.may_hold(spark, root, asked).select(T.BUCKET).collect()]))
    assert opened.select(F.col("_metadata.file_path")).distinct().count() < 8


def test_extract_with_a_title_store_equals_the_plain_job(spark, tmp_path):
    stores = [Store.under(str(tmp_path / "plain")), Store.under(str(tmp_path / "indexed"), titles=str(tmp_path / "indexed" / "titles"))]
    for store in stores:
        progress.init_progress(spark, store.progress, ["bali", "riau", "aceh"])
        assert extract_page(spark, replace(store, titles=""), pages_table(spark).filter(F.col("url").contains("riau") | F.col("url").endswith("/r")), SITE, NOW) == 1
    index_titles(spark, stores[1])
    counts = [extract_page(spark, store, pages_table(spark), SITE, NOW) for store in stores]
    again = [extract_page(spark, store, pages_table(spark), SITE, NOW) for store in stores]
    assert counts[0] == counts[1] > 0 and again == [0, 0]
    rows = [sorted(map(str, listings.read_all(spark, store.raw_listings).collect())) for store in stores]
    assert rows[0] == rows[1]


def test_a_run_that_died_before_its_titles_were_added(spark, tmp_path):
    store = Store.under(str(tmp_path), titles=str(tmp_path / "titles"))
    progress.init_progress(spark, store.progress, ["bali"])
    pages = spark.createDataFrame([
        (f"{BASE}/jual/bali/rumah/?page=1", search(card("Villa A", "/properti/a"))), (f"{BASE}/properti/a", detail("Villa A"))], "url string, html string")
    assert extract_page(spark, replace(store, titles=""), pages, SITE, NOW) == 1
    assert extract_page(spark, store, pages, SITE, NOW) == 0
    assert known(spark, store.titles, ["Villa A"]) == ["Villa A"]


def test_first_add_looks_nothing_up(spark, tmp_path, monkeypatch):
    """New titles are looked up only where some are stored, and what is written between goes."""
    asked = []
    known = T.known_among
    monkeypatch.setattr(T, "known_among", lambda *args: asked.append(1) or known(*args))
    root = str(tmp_path / "store")
    for n, expected in ((5, 0), (8, 1)):
        T.add(spark, root, spark.range(n).selectExpr("concat('t', id) as judul_iklan"))
        assert len(asked) == expected
        assert spark.read.parquet(f"{root}/titles").count() == n
    assert sorted(p.name for p in (tmp_path / "store").iterdir()) == ["sketch", "titles"]
