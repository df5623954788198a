"""Arriving pages: whole runs, runs that die between a write and the stream's commit, and the batch job beside them."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from hunian.plans.extract import new_listings
from hunian.streaming import arrivals as AV
from tests.html_fixtures import BASE, SITE, card, detail, search
from tests.test_batch import NOW


def pages():
    made = []
    for n in range(6):
        made.append((f"{BASE}/jual/bali/rumah/?page={n + 1}", search(
            card(f"Villa {n}", f"/properti/{n}"), card(f"Again {n}", f"/properti/{(n + 2) % 6}"), card("Known", f"/properti/{n}"))))
        made.append((f"{BASE}/properti/{(n + 3) % 6}", detail(f"Villa {(n + 3) % 6}")))
    return [*made, (f"{BASE}/properti/x", None), (f"{BASE}/elsewhere", "<p>no listing</p>")]


@pytest.fixture
def folder(spark, tmp_path):
    """One file for each two pages."""
    rows = pages()
    for n in range(0, len(rows), 2):
        spark.createDataFrame(rows[n:n + 2], AV.PAGES).coalesce(1).write.mode("append").parquet(str(tmp_path / "pages"))
    return str(tmp_path / "pages")


def known(titles):
    return titles.filter("judul_iklan = 'Known'")


def wanted(spark, tmp_path):
    """What the batch job makes of the same pages."""
    table = spark.createDataFrame(pages(), AV.PAGES)
    province, page = AV.of_search_url(F.col("url"), SITE)
    searched = table.withColumns({"province": province, "page": page}).filter("province is not null").select("province", "page", "html", "url")
    made = new_listings(searched, table, spark.createDataFrame([("Known",)], "judul_iklan string"), SITE, str(tmp_path / "scratch"), NOW)
    return sorted(map(str, made.collect()))


def found(spark, tables):
    return sorted(map(str, AV.listings(spark, tables).drop("batch").collect()))


@pytest.mark.parametrize("files", [None, 1, 3])
def test_stream_equals_the_batch_job(spark, tmp_path, folder, files):
    tables = AV.Arrivals.under(str(tmp_path / "t"))
    AV.follow(spark, folder, tables, SITE, known, NOW, files)
    rows = found(spark, tables)
    assert rows == wanted(spark, tmp_path) and len(rows) == 12
    AV.follow(spark, folder, tables, SITE, known, NOW, files)
    assert found(spark, tables) == rows
    spark.createDataFrame([(f"{BASE}/jual/riau/rumah/?page=9", search(card("Late", "/properti/0")))], AV.PAGES).write.mode("append").parquet(folder)
    AV.follow(spark, folder, tables, SITE, known, NOW, files)
    assert len(found(spark, tables)) == 13


@pytest.mark.parametrize("when", ["before the listings", "after the listings"])
def test_killed_between_a_write_and_the_commit(spark, tmp_path, folder, monkeypatch, when):
    tables = AV.Arrivals.under(str(tmp_path / "t"))
    write, died = AV._write, []

    def dying(rows, root, batch):
        last = batch == 2 and root == tables.listings and not died
        if last and when == "before the listings":
            died.append(batch)
            raise RuntimeError("killed")
        write(rows, root, batch)
        if last:
            died.append(batch)
            raise RuntimeError("killed")

    monkeypatch.setattr(AV, "_write", dying)
    with pytest.raises(Exception, match="killed"):
        AV.follow(spark, folder, tables, SITE, known, NOW, 1)
    assert died == [2]
    AV.follow(spark, folder, tables, SITE, known, NOW, 1)
    assert found(spark, tables) == wanted(spark, tmp_path)


def test_search_urls(spark):
    urls = [f"{BASE}/jual/jawa-barat/rumah/?page=12", f"{BASE}/jual/jawa-barat/rumah/?page=12&x=1", f"{BASE}/properti/1", None, f"{BASE}/jual//rumah/?page=1"]
    province, page = AV.of_search_url(F.col("url"), SITE)
    rows = spark.createDataFrame([(u,) for u in urls], "url string").select(province.alias("p"), page.alias("n")).collect()
    assert [tuple(r) for r in rows] == [("jawa-barat", 12), (None, None), (None, None), (None, None), (None, None)]
    turned = replace(SITE, search_path="/list/{page}/{province}")
    province, page = AV.of_search_url(F.lit(f"{BASE}/list/3/bali"), turned)
    assert tuple(spark.range(1).select(province, page).first()) == ("bali", 3)
