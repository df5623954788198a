"""The three jobs end to end on small written tables."""

import csv
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from hunian.plans import clean as clean_job
from hunian.plans.batch import run_batch
from hunian.plans.clean import clean_page
from hunian.plans.extract import extract_page, new_cards, new_listings
from hunian.plans.store import Store, adopt_csv_tree, select_batch
from hunian.schemas import FACILITY_COUNTS, FACILITY_REQUIRED, LISTING, LISTING_REQUIRED
from hunian.sources import listings, sinks
from hunian.streaming import progress
from tests.html_fixtures import BASE, SITE, card, detail, search

NOW = datetime(2024, 5, 2, 10)


def state(spark, store):
    row = progress.read_progress(spark, store.progress).first()
    return row["current_page"], row["provinces"]


def pages_table(spark):
    rows = [
        (f"{BASE}/jual/bali/rumah/?page=1", search(
            card("Villa A", "/properti/a"), card("Villa A", "/properti/a2"), card(None, "/properti/none"),
            card("No link", None), card("Lost", "/properti/lost"))),
        (f"{BASE}/jual/riau/rumah/?page=1", search(card("Rumah R", "/properti/r"))),
        (f"{BASE}/jual/aceh/rumah/?page=2", search(card("Rumah Ahead", "/properti/ahead"))),
        (f"{BASE}/properti/a", detail("Villa A", pairs=[("Kamar Tidur", "3"), ("Daya Listrik", "2200 Watt")])),
        (f"{BASE}/properti/a2", detail("Villa A", price="Rp 850,5 Juta", location="Kuta")),
        (f"{BASE}/properti/r", detail("Rumah R", location="Tampan, Kota, Pekanbaru", update=None)),
        (f"{BASE}/properti/ahead", detail("Rumah Ahead")),
        (f"{BASE}/properti/lost", None),
    ]
    return spark.createDataFrame(rows, "url string, html string")


def places_table(spark):
    rows = [
        (1, "Indonesia", 6, "Cibeunying", "school", None, None, None, None),
        (2, "Indonesia", 6, "Cibeunying", "marketplace", "mall", None, None, None),
        (3, "Indonesia", 6, "Kuta", "parking", None, None, None, None),
        (4, "Indonesia", 5, "Kuta", "school", None, None, None, None),
        (5, "Malaysia", 6, "Kuta", "school", None, None, None, None),
    ]
    return spark.createDataFrame(
        rows, "place_id bigint, country string, admin_level int, kecamatan string, amenity string, shop string, "
        "aeroway string, railway string, leisure string")


def test_batch_chain_and_state(spark, tmp_path):
    store = Store.under(str(tmp_path))
    progress.init_progress(spark, store.progress, ["bali", "riau", "aceh", "jambi"])
    progress.write_progress(
        spark.createDataFrame([(1, {"bali": 1, "riau": 1, "aceh": 2, "jambi": 1})], "current_page int, provinces map<string,int>"),
        store.progress + "-x")
    store = Store.under(str(tmp_path))
    progress_path = store.progress + "-x"
    store = Store(store.raw_listings, store.raw_facilities, store.clean_listings, store.clean_facilities, progress_path)
    result = run_batch(spark, store, pages_table(spark), places_table(spark), SITE, now=NOW)
    # Both cards titled "Villa A" are new: copies within a batch stay.
    assert result.new_listings == 3
    assert result.new_facilities == 3
    assert (result.clean.page, result.clean.listings, result.clean.facilities) == (1, 3, 3)
    assert state(spark, store) == (2, {"bali": 2, "riau": 2, "aceh": 2, "jambi": 2})

    clean = spark.read.parquet(store.clean_listings)
    assert clean.columns == LISTING.names + ["page"]
    rows = {r["link_rumah123"]: r for r in clean.collect()}
    a = rows[f"{BASE}/properti/a"]
    assert (a["harga"], a["kamar_tidur"], a["daya_listrik"]) == (1_500_000_000, 3, None)
    assert (a["kecamatan"], a["kabupaten_kota"], a["provinsi"]) == ("Cibeunying", "Bandung", "bali")
    assert (a["terakhir_diperbarui"], a["agen"]) == ("2024-05-01", "Sari")
    assert a["waktu_scraping"].isoformat() == "2024-05-02T10:00:00"
    a2 = rows[f"{BASE}/properti/a2"]
    assert (a2["harga"], a2["kecamatan"], a2["kabupaten_kota"]) == (850_500_000, "Kuta", None)
    r = rows[f"{BASE}/properti/r"]
    assert (r["kabupaten_kota"], r["terakhir_diperbarui"], r["agen"]) == ("Pekanbaru", None, None)

    counts = {r["kecamatan"]: [r[c] for c in FACILITY_COUNTS] for r in spark.read.parquet(store.clean_facilities).collect()}
    assert counts == {"Cibeunying": [1, 0, 2, 0, 0], "Kuta": [0, 0, 0, 0, 1], "Tampan": [0, 0, 0, 0, 0]}

    # Page 2: only aceh has a search page; its district is known already.
    second = run_batch(spark, store, pages_table(spark), places_table(spark), SITE, now=NOW)
    assert (second.new_listings, second.new_facilities) == (1, 0)
    assert (second.clean.page, second.clean.listings, second.clean.facilities) == (2, 1, 1)
    # Page 3: nothing is there, the state still advances.
    third = run_batch(spark, store, pages_table(spark), places_table(spark), SITE, now=NOW)
    assert (third.new_listings, third.new_facilities, third.clean.listings) == (0, 0, 0)
    assert state(spark, store)[0] == 4
    assert spark.read.parquet(store.clean_listings).groupBy("page").count().count() == 2


def test_extract_again_adds_nothing_and_loses_nothing(spark, tmp_path):
    store = Store.under(str(tmp_path))
    progress.init_progress(spark, store.progress, ["bali", "riau"])
    pages = pages_table(spark)
    assert extract_page(spark, store, pages, SITE, NOW) == 3
    assert extract_page(spark, store, pages, SITE, NOW) == 0
    assert listings.read_all(spark, store.raw_listings).count() == 3
    more = pages.filter("url NOT LIKE '%bali/rumah%'").union(spark.createDataFrame(
        [(f"{BASE}/jual/bali/rumah/?page=1", search(card("Villa B", "/properti/b"))), (f"{BASE}/properti/b", detail("Villa B"))],
        "url string, html string"))
    assert extract_page(spark, store, more, SITE, NOW) == 1
    assert listings.read_all(spark, store.raw_listings).count() == 4


def test_error_before_state_leaves_page_to_redo(spark, tmp_path, monkeypatch):
    store = Store.under(str(tmp_path))
    progress.init_progress(spark, store.progress, ["bali", "riau"])
    extract_page(spark, store, pages_table(spark), SITE, NOW)

    def fail(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(clean_job.progress, "write_progress", fail)
        with pytest.raises(OSError):
            clean_page(spark, store)
    assert state(spark, store)[0] == 1
    first = sorted(map(str, spark.read.parquet(store.clean_listings).collect()))
    assert clean_page(spark, store).listings == 3
    assert sorted(map(str, spark.read.parquet(store.clean_listings).collect())) == first
    assert state(spark, store) == (2, {"bali": 2, "riau": 2})


def test_no_state_raises(spark, tmp_path):
    os.makedirs(tmp_path / "progress")
    with pytest.raises(Exception):
        select_batch(spark, Store.under(str(tmp_path)))


def write_csv(path, header, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="", encoding="utf-8") as f:
        out = csv.writer(f, lineterminator="\n")
        out.writerow(header)
        out.writerows(rows)


def listing_row(header, **values):
    return [values.get(c, "") for c in header]


@pytest.fixture
def csv_store(spark, tmp_path):
    root = str(tmp_path)
    store = Store.under(root, raw_format="csv")
    header = LISTING.names
    other = ["extra", *reversed(LISTING_REQUIRED)]
    write_csv(f"{store.raw_listings}/bali/page_1_bali.csv", header, [
        listing_row(header, judul_iklan='Rumah, "baru"\nluas', harga="Rp 2,25 Miliar", kecamatan="Kuta Utara",
                    kamar_tidur="3.7", lebar_jalan="1.50", luas_tanah="120.5", waktu_scraping="2024-05-01T01:02:03.5"),
        listing_row(header, judul_iklan="No district", harga="15", kamar_tidur="2200 Watt", luas_tanah="12 m2"),
    ])
    write_csv(f"{store.raw_listings}/riau/page_1_riau.csv", other, [
        listing_row(other, judul_iklan="Reversed", harga="Rp 1,5 Juta", kecamatan="A/[b]", extra="kept"),
    ])
    write_csv(f"{store.raw_listings}/aceh/page_1_aceh.csv", header, [listing_row(header, judul_iklan="Behind")])
    counts = ["3", "x", "1.9", "", "4"]
    for name, district in (("Kuta Utara", "Kuta Utara"), ("odd", "A/[b]"), ("None", ""), ("Elsewhere", "Elsewhere")):
        write_csv(f"{store.raw_facilities}/{name}.csv", [*FACILITY_COUNTS, "kecamatan", "timestamp", "status"],
                  [[*counts, district, "2024-05-01T00:00:00", "success"]])
    progress.init_progress(spark, store.progress, ["bali", "riau", "jambi", "aceh"])
    os.makedirs(store.progress, exist_ok=True)
    progress.new_progress(spark, ["bali", "riau", "jambi"]).withColumn(
        "provinces", F.map_concat("provinces", F.create_map(F.lit("aceh"), F.lit(0)))).write.mode("overwrite").json(store.progress)
    return store


@pytest.mark.parametrize("clean_format", ["parquet", "csv"])
def test_clean_from_csv_tree(spark, csv_store, clean_format):
    from dataclasses import replace
    store = replace(csv_store, clean_format=clean_format)
    result = clean_page(spark, store)
    assert (result.listings, result.facilities) == (3, 2)
    assert state(spark, store) == (2, {"bali": 2, "riau": 2, "jambi": 2, "aceh": 0})
    if clean_format == "csv":
        assert spark.read.csv(store.clean_listings + "/page_1", header=True, multiLine=True, escape='"').count() == 3
        return
    rows = {r["judul_iklan"]: r for r in spark.read.parquet(store.clean_listings).collect()}
    first = rows['Rumah, "baru"\nluas']
    assert (first["harga"], first["kamar_tidur"], first["luas_tanah"]) == (2_250_000_000, 3, 120.5)
    assert first["lebar_jalan"] == "1.50"
    assert rows["No district"]["harga"] is None and rows["No district"]["kamar_tidur"] is None
    assert rows["No district"]["luas_tanah"] is None
    assert rows["Reversed"]["harga"] == 1_500_000 and rows["Reversed"]["extra"] == "kept"
    facilities = {r["kecamatan"]: r for r in spark.read.parquet(store.clean_facilities).collect()}
    assert set(facilities) == {"Kuta Utara", "A/[b]"}
    assert [facilities["A/[b]"][c] for c in FACILITY_COUNTS] == [3, None, 1, None, 4]


def test_missing_column_is_an_error_and_state_stays(spark, csv_store):
    header = [c for c in LISTING.names if c != "kecamatan"]
    write_csv(f"{csv_store.raw_listings}/jambi/page_1_jambi.csv", header, [listing_row(header, judul_iklan="x")])
    with pytest.raises(ValueError, match="kecamatan"):
        clean_page(spark, csv_store)
    assert state(spark, csv_store)[0] == 1
    # The known-title scan takes what it can read.
    titles = {r[0] for r in listings.read_titles_csv(spark, csv_store.raw_listings).select("judul_iklan").collect()}
    assert titles == {'Rumah, "baru"\nluas', "No district", "Reversed", "Behind", "x"}


def test_adopted_csv_tree_cleans_alike(spark, csv_store, tmp_path):
    target = Store.under(str(tmp_path / "adopted"))
    assert adopt_csv_tree(spark, csv_store, target) == (4, 4)
    progress.write_progress(progress.read_progress(spark, csv_store.progress), target.progress)
    # A second time changes nothing, and columns beyond the known ones are kept.
    adopt_csv_tree(spark, csv_store, target)
    assert listings.read_all(spark, target.raw_listings).count() == 4
    assert spark.read.parquet(target.raw_facilities).count() == 4
    assert "extra" in listings.read_page(spark, target.raw_listings, ["riau"], 1).columns
    for store in (csv_store, target):
        clean_page(spark, store)
    names = LISTING.names
    one, two = (sorted(map(str, spark.read.parquet(s.clean_listings).select(*names).collect())) for s in (csv_store, target))
    assert one == two and len(one) == 3


def test_new_listings_of_unknown_titles(spark, tmp_path):
    pages = pages_table(spark)
    searched = pages.filter("url LIKE '%/rumah/%'").withColumns({"province": F.lit("bali"), "page": F.lit(1)})
    known = spark.createDataFrame([("Rumah R",), (None,)], "judul_iklan string")
    rows = new_listings(searched, pages, known, SITE, str(tmp_path), NOW).collect()
    assert sorted(r["link_rumah123"][-2:] for r in rows) == ["/a", "a2", "ad"]


def test_newest_fetch_of_a_page_counts(spark, tmp_path):
    pages = spark.createDataFrame([
        (f"{BASE}/properti/a", detail("Old"), 1), (f"{BASE}/properti/a", detail("New", pairs=[("Hook", "Ya")]), 2)],
        "url string, html string, fetched int")
    searched = spark.createDataFrame([("bali", 1, search(card("A", "/properti/a"), card("A", "/properti/a")))], "province string, page int, html string")
    known = spark.createDataFrame([], "judul_iklan string")
    rows = new_listings(searched, pages, known, SITE, str(tmp_path), NOW, "fetched").collect()
    assert [(r["judul_iklan"], r["hook"], r["provinsi"], r["page"]) for r in rows] == [("New", "Ya", "bali", 1)] * 2


def test_page_read_but_empty_replaces_old_page(spark, tmp_path):
    store = Store.under(str(tmp_path), raw_format="csv")
    path = f"{store.raw_listings}/bali/page_1_bali.csv"
    write_csv(path, LISTING.names, [listing_row(LISTING.names, judul_iklan="x")])
    progress.init_progress(spark, store.progress, ["bali"])
    assert clean_page(spark, store).listings == 1
    write_csv(path, LISTING.names, [])
    progress.init_progress(spark, store.progress, ["bali"])
    assert clean_page(spark, store).listings == 0
    assert spark.read.schema(LISTING).parquet(store.clean_listings).count() == 0
    assert set(FACILITY_REQUIRED) >= set(FACILITY_COUNTS)


def test_adopting_a_file_without_a_required_column_raises(spark, csv_store, tmp_path):
    header = [c for c in LISTING.names if c != "hook"]
    write_csv(f"{csv_store.raw_listings}/riau/page_1_riau.csv", header, [listing_row(header, judul_iklan="x")])
    with pytest.raises(ValueError, match="hook"):
        adopt_csv_tree(spark, csv_store, Store.under(str(tmp_path / "adopted")))


def test_batch_on_a_csv_tree(spark, tmp_path):
    store = Store.under(str(tmp_path), raw_format="csv")
    progress.init_progress(spark, store.progress, ["bali", "riau", "aceh", "jambi"])
    write_csv(f"{store.raw_listings}/bali/page_1_bali.csv", LISTING.names, [
        listing_row(LISTING.names, judul_iklan="There before", kecamatan="Old")])
    result = run_batch(spark, store, pages_table(spark), places_table(spark), SITE, now=NOW)
    assert (result.new_listings, result.new_facilities, result.clean.listings) == (3, 4, 4)
    assert sorted(os.listdir(f"{store.raw_listings}/bali")) == [".page_1_bali.csv.crc", "page_1_bali.csv"] or \
        "page_1_bali.csv" in os.listdir(f"{store.raw_listings}/bali")
    assert {"Kuta.csv", "Tampan.csv", "Old.csv"} <= set(os.listdir(store.raw_facilities))
    assert extract_page(spark, store, pages_table(spark), SITE, NOW) == 0 or state(spark, store)[0] == 2


@pytest.mark.parametrize("name", ["a=b", "x%y", "p [1]", "q{2}", "c:d", "it's"])
def test_odd_province_names_are_read_back(spark, tmp_path, name):
    from hunian.sources import sinks
    rows = spark.createDataFrame([(name, 1, "t")], "province string, page int, judul_iklan string")
    sinks.append_rows(rows, str(tmp_path), ["province", "page"])
    assert [r["province"] for r in listings.read_page(spark, str(tmp_path), [name], 1).collect()] == [name]


def test_state_in_one_file(spark, tmp_path):
    path = tmp_path / "progress.json"
    path.write_text('{"current_page": 1,\n "provinces": {"bali": 1, "riau": 2}}')
    store = Store(*[f"{tmp_path}/{n}" for n in "abcd"], str(path))
    clean_page(spark, store)
    assert path.is_file() and state(spark, store) == (2, {"bali": 2, "riau": 2})
    clean_page(spark, store)
    assert state(spark, store) == (3, {"bali": 3, "riau": 3})


def test_old_states_go(spark, tmp_path):
    store = Store.under(str(tmp_path))
    progress.init_progress(spark, store.progress, ["bali"])
    for _ in range(6):
        clean_page(spark, store)
    assert state(spark, store)[0] == 7
    assert sum(f.endswith(".json") for f in os.listdir(store.progress)) == progress.KEPT


def test_scratch_is_under_the_root_and_goes(spark, tmp_path):
    store = Store.under(str(tmp_path))
    progress.init_progress(spark, store.progress, ["bali"])
    extract_page(spark, store, pages_table(spark), SITE, NOW)
    assert store.scratch_folder.startswith(str(tmp_path)) and not any(os.scandir(store.scratch_folder))


def test_pages_in_folders_are_pruned(spark, tmp_path):
    from hunian.sources.pages import BUCKET, fetched, read_pages, write_pages
    write_pages(pages_table(spark), str(tmp_path / "pages"))
    pages = read_pages(spark, str(tmp_path / "pages"))
    urls = spark.createDataFrame([(f"{BASE}/properti/a",)], "url string")
    found = fetched(pages, urls)
    assert found.count() == 1
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(" + BUCKET in text.replace("`", "") or BUCKET in text.split("PartitionFilters")[1][:200]
    store = Store.under(str(tmp_path))
    progress.init_progress(spark, store.progress, ["bali", "riau"])
    assert extract_page(spark, store, pages, SITE, NOW) == 3


def test_newest_fetch_in_the_job(spark, tmp_path):
    old = pages_table(spark).withColumn("html", F.lit("<html><h1>Old</h1></html>")).withColumn("fetched", F.lit(1))
    pages = pages_table(spark).withColumn("fetched", F.lit(2)).union(old)
    store = Store.under(str(tmp_path))
    progress.init_progress(spark, store.progress, ["bali", "riau"])
    # The newest fetch of one page failed, so its last good one counts.
    assert extract_page(spark, store, pages, SITE, NOW, "fetched") == 4
    titles = [r[0] for r in listings.read_all(spark, store.raw_listings).select("judul_iklan").collect()]
    assert sorted(titles) == ["Old", "Rumah R", "Villa A", "Villa A"]


def test_known_titles_are_cut_before_the_anti_join(spark, tmp_path, capsys):
    known = spark.range(1000).select(F.concat(F.lit("t"), F.col("id").cast("string")).alias("judul_iklan"))
    known.write.parquet(str(tmp_path / "known"))
    searched = pages_table(spark).filter("url LIKE '%/rumah/%'").withColumns({"province": F.lit("bali"), "page": F.lit(1)})
    fresh_cards = new_cards(searched, spark.read.parquet(str(tmp_path / "known")), SITE, str(tmp_path))
    fresh_cards.explain("formatted")
    text = capsys.readouterr().out
    # The history is scanned once and joined map-side with the cards' titles before any exchange.
    assert "LeftSemi" in text and "BroadcastHashJoin" in text and "SortMergeJoin LeftSemi" not in text


def test_places_are_cut_before_they_are_counted(spark, tmp_path):
    from hunian.operators import facilities, keys
    from hunian.plans import count
    store = Store.under(str(tmp_path))
    progress.init_progress(spark, store.progress, ["bali", "riau"])
    extract_page(spark, store, pages_table(spark), SITE, NOW)
    near = keys.keep_known(facilities.places_in(places_table(spark), "Indonesia"), spark.createDataFrame([("Kuta",)], "kecamatan string"), "kecamatan")
    plan = facilities.count_places(near)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate [kecamatan") < plan.index("LeftSemi")
    assert count.count_districts(spark, store, places_table(spark), now=NOW) == 3
    assert count.count_districts(spark, store, places_table(spark), now=NOW) == 0


def test_all_search_pages_of_a_table_are_read(spark, tmp_path):
    """A province with several search pages: the newest fetch of each counts, those of provinces that wait elsewhere do not."""
    store = Store.under(str(tmp_path))
    progress.write_progress(spark.createDataFrame([(1, {"bali": 1, "riau": 1, "aceh": 2})], "current_page int, provinces map<string,int>"), store.progress)
    lists = [(p, f"{BASE}/jual/{p}/rumah/?page=1&list={n}") for p, n in (("bali", 1), ("bali", 2), ("riau", 3), ("aceh", 4))]
    rows = [(url, 1, search(card(f"Villa {url[-1]}", f"/properti/{url[-1]}"))) for _, url in lists]
    rows += [(url, 0, search(card("Old", "/properti/1"))) for _, url in lists]
    rows += [(f"{BASE}/properti/{n}", 1, detail(f"Villa {n}")) for n in range(1, 5)]
    pages = spark.createDataFrame(rows, "url string, fetched int, html string")
    searches = spark.createDataFrame([*lists, lists[0]], "province string, url string")
    assert extract_page(spark, store, pages, SITE, NOW, "fetched", searches) == 3
    found = listings.read_all(spark, store.raw_listings).collect()
    assert sorted((r["province"], r["page"], r["judul_iklan"]) for r in found) == [("bali", 1, "Villa 1"), ("bali", 1, "Villa 2"), ("riau", 1, "Villa 3")]


def test_large_csv_names_are_folders_of_parts(spark, tmp_path, monkeypatch):
    """A name with many rows is written by several tasks and read like a file; large and small replace each other."""
    monkeypatch.setattr(sinks, "FILE_ROWS", 50)
    # As little as this AQE would leave to one task.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    root, scratch = str(tmp_path / "raw_listings"), str(tmp_path / "scratch")

    def write(bali, riau):
        rows = spark.range(bali + riau).withColumn("province", F.when(F.col("id") < bali, "bali").otherwise("riau"))
        rows = rows.select(*[(F.concat(F.lit("t"), F.col("id").cast("string")) if n == "judul_iklan" else F.lit("x")).alias(n)
                             for n in LISTING.names], "province").withColumn("_into", F.format_string("%s/page_1_%s.csv", "province", "province"))
        assert sinks.write_csv_files(rows.drop("province"), root, F.col("_into"), scratch) == bali + riau
        for found in (listings.read_page_csv(spark, root, ["bali", "riau"], 1), listings.read_titles_csv(spark, root)):
            got = [(r["province"], r["page"], r["judul_iklan"]) for r in found.collect()]
            assert sorted(got) == sorted(("bali" if n < bali else "riau", 1, f"t{n}") for n in range(bali + riau))

    try:
        write(400, 10)
        parts = [n for n in os.listdir(f"{root}/bali/page_1_bali.csv") if n.endswith(".csv")]
        assert len(parts) > 1 and os.path.isfile(f"{root}/riau/page_1_riau.csv")
        write(300, 200)
        write(20, 10)
        assert os.path.isfile(f"{root}/bali/page_1_bali.csv") and os.path.isfile(f"{root}/riau/page_1_riau.csv")
        write(10, 300)
        assert not os.listdir(scratch)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_large_csv_names_may_be_packed(spark, tmp_path, monkeypatch):
    """Large names become folders of packed parts, small ones stay files; both are read, adopted and replaced alike."""
    monkeypatch.setattr(sinks, "FILE_ROWS", 50)
    store = Store.under(str(tmp_path), raw_format="csv")

    def write(**rows):
        made = [(f"t{province}{n}\n\"", province) for province, count in rows.items() for n in range(count)]
        frame = spark.createDataFrame(made, "judul_iklan string, province string").select(
            *[(F.col(n) if n == "judul_iklan" else F.lit("x")).alias(n) for n in LISTING.names],
            F.format_string("%s/page_1_%s.csv", "province", "province").alias("_into"))
        assert sinks.write_csv_files(frame, store.raw_listings, F.col("_into"), store.scratch_folder, packed="gzip") == len(made)
        for found in (listings.read_page_csv(spark, store.raw_listings, list(rows), 1), listings.read_titles_csv(spark, store.raw_listings)):
            assert sorted((r["judul_iklan"], r["province"], r["page"]) for r in found.collect()) == sorted((t, p, 1) for t, p in made)
        return {p: os.path.isdir(f"{store.raw_listings}/{p}/page_1_{p}.csv") for p in rows}

    assert write(bali=200, riau=10) == {"bali": True, "riau": False}
    parts = [n for n in os.listdir(f"{store.raw_listings}/bali/page_1_bali.csv") if not n.startswith((".", "_"))]
    assert parts and all(n.endswith(".csv.gz") for n in parts)
    target = Store.under(str(tmp_path / "adopted"))
    for _ in range(2):
        assert adopt_csv_tree(spark, store, target) == (210, 0)
        assert listings.read_all(spark, target.raw_listings).groupBy("province").count().orderBy("province").collect() == [("bali", 200), ("riau", 10)]
    assert write(bali=120, riau=130) == {"bali": True, "riau": True}
    assert write(bali=20, riau=90) == {"bali": False, "riau": True}
    assert write(bali=20, riau=1) == {"bali": False, "riau": False}
    assert not os.listdir(store.scratch_folder)


def test_adopted_pages_are_not_moved(spark, csv_store, tmp_path, monkeypatch):
    """Rows come page by page, so they are written where they are read; a page of a file is one file in the store, whatever the session's codec."""
    moved = []
    monkeypatch.setattr(sinks, "_gathered", lambda df, by: moved.append(by) or df)
    target = Store.under(str(tmp_path / "adopted"))
    for _ in range(2):
        assert adopt_csv_tree(spark, csv_store, target)[0] == 4
    assert ["province", "page"] not in moved
    written = [(d, n) for d, _, names in os.walk(target.raw_listings) for n in names if n.startswith("part-")]
    assert len(written) == len({d for d, _ in written}) > 1 and all(".zstd." in n for _, n in written)
