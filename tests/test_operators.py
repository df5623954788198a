"""Joins, counts, cards, sources and plans."""

import os
import random

import pytest
from pyspark.sql import functions as F

from hunian.operators import clean as C, facilities as A, keys as K, pages as P
from hunian.schemas import FACILITY_COUNTS, LISTING, LISTING_REQUIRED, PROVINCES, RAW_LISTING
from hunian.sources import files, listings, provinces, sinks
from hunian.streaming import progress
from tests.html_fixtures import BASE, SITE, card, detail, search


def plan(df):
    return df._jdf.queryExecution().toString()


def final_plan(df):
    """Plan after the run, with what AQE changed. ``count`` would prune columns."""
    df.write.format("noop").mode("overwrite").save()
    rows = df.collect()
    return rows, df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def conf(spark):
    """Set options for one test."""
    before = {}

    def set_(**options):
        for key, value in options.items():
            name = key.replace("__", ".")
            before.setdefault(name, spark.conf.get(name, None))
            spark.conf.set(name, value)

    yield set_
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_membership_like_python_sets(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice([None, "hot", "hot", *map(str, range(30))])) for i in range(600)]
    known = [(rng.choice([None, "hot", *map(str, range(0, 30, 2))]),) for _ in range(300)]
    left, right = spark.createDataFrame(rows, "i int, key string"), spark.createDataFrame(known, "key string")
    stored = {k for (k,) in known if k is not None}
    new, old = K.keep_new(left, right, "key"), K.keep_known(left, right, "key")
    assert new.columns == old.columns == ["i", "key"]
    assert sorted(r[0] for r in new.collect()) == [i for i, k in rows if k not in stored]
    assert sorted(r[0] for r in old.collect()) == [i for i, k in rows if k in stored]
    missing = {r[0] for r in K.missing_keys(left, right, "key").collect()}
    assert missing == {k for _, k in rows if k is not None} - stored
    assert {r[0] for r in K.distinct_keys(left, "key", keep_null=True).collect()} == {k for _, k in rows}
    assert {r[0] for r in K.union_keys([left, right], "key").collect()} == ({k for _, k in rows} | stored) - {None}


@pytest.mark.parametrize("keep", [K.keep_new, K.keep_known])
def test_heavy_key_is_split(spark, conf, tmp_path, keep):
    """A key with a third of all rows is spread over several tasks, on either side."""
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__advisoryPartitionSizeInBytes="64KB",
         spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="64KB",
         spark__sql__adaptive__skewJoin__skewedPartitionFactor="2", spark__sql__shuffle__partitions="16",
         spark__sql__adaptive__coalescePartitions__parallelismFirst="false",
         spark__sql__optimizer__runtime__bloomFilter__enabled="false")
    n = 90_000
    rows = spark.range(n, numPartitions=12).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("key"), F.sha1(F.col("id").cast("string")).alias("v"))
    rows.write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    known = rows.filter("v < '8'").select("key")
    result = keep(rows, known, "key")
    got, text = final_plan(result)
    assert "skew=true" in text and "SortMergeJoin" in text
    stored = {r[0] for r in known.distinct().collect()}
    expected = sum((r[0] in stored) == (keep is K.keep_known) for r in rows.select("key").collect())
    assert len(got) == expected


def test_missing_keys_needs_two_shuffles(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")
    df = spark.range(100).select(F.col("id").cast("string").alias("key"))
    text = plan(K.missing_keys(df, df.filter("key > '5'"), "key")).split("Physical Plan")[1]
    assert text.count("Exchange hashpartitioning") == 2


def test_counts_join_needs_two_shuffles(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")
    places = spark.createDataFrame([("a", "school")], "kecamatan string, amenity string")
    filters = [("n", "amenity", "school")]
    keys = K.distinct_keys(places, "kecamatan")
    text = plan(A.counts_for(keys, A.count_places(places, filters=filters))).split("Physical Plan")[1]
    assert text.count("Exchange hashpartitioning") == 2 and "partial_count_if" in text or "partial_count" in text


def test_facility_counts(spark):
    schema = "country string, admin_level int, kecamatan string, amenity string, shop string, aeroway string, railway string, leisure string"
    places = spark.createDataFrame([
        ("Indonesia", 6, "A", "parking", None, None, None, None),
        ("Indonesia", 6, "A", "marketplace", "mall", None, None, None),
        ("Indonesia", 6, "A", "driving_school", None, None, "station", None),
        ("Indonesia", 6, "A", None, None, None, None, None),
        ("Indonesia", 6, "B", "bus_station", None, "terminal", "halt", "park"),
        ("Indonesia", 6, None, "school", None, None, None, None),
        ("Indonesia", 7, "B", "school", None, None, None, None),
        ("Other", 6, "B", "school", None, None, None, None)], schema)
    keys = spark.createDataFrame([("A",), ("B",), ("C",)], "kecamatan string")
    kept = A.places_in(places, "Indonesia")
    rows = {r["kecamatan"]: [r[c] for c in FACILITY_COUNTS] for r in A.counts_for(keys, A.count_places(kept)).collect()}
    assert rows == {"A": [1, 0, 2, 1, 1], "B": [0, 0, 0, 3, 1], "C": [0, 0, 0, 0, 0]}
    whole = {r["kecamatan"]: [r[c] for c in FACILITY_COUNTS] for r in A.count_places(kept, whole_value=True).collect()}
    assert whole == {"A": [0, 0, 2, 1, 0], "B": [0, 0, 0, 3, 1]}
    stamped = A.facility_rows(A.count_places(kept).withColumn(FACILITY_COUNTS[0], F.nullif(FACILITY_COUNTS[0], F.lit(1))), None)
    assert [(r["kecamatan"], r["status"]) for r in stamped.collect()] == [("B", "success")]


def test_cards(spark):
    nested = ('<div class="ui-organism-intersection__element"><a href="/other/1"><h2>Other</h2></a>'
              "<a href='/properti/img'><img></a><a href=\"/properti/2?a=1&amp;b=2\">Foto <h2 class='t'> A &amp; <b>B</b> </h2></a></div>")
    pages = spark.createDataFrame([
        ("p", search(card("One", "/properti/1", extra="<div>x</div>"), card("One", "/properti/1b"), card("  ", "/properti/blank"),
                     card(None, "/properti/n"), card("No link", None), card("Elsewhere", "/blog/1"))),
        ("q", search(nested)), ("empty", "<html></html>"), ("null", None)], "page string, html string")
    rows = [(r["page"], r["pos"], r["judul_iklan"], r["link"]) for r in P.page_cards(pages, SITE).collect()]
    assert sorted(rows) == [
        ("p", 0, "One", f"{BASE}/properti/1"), ("p", 1, "One", f"{BASE}/properti/1b"),
        ("q", 0, "A & B", f"{BASE}/properti/img")]


def test_detail_record(spark):
    pairs = [("Kamar Tidur Pembantu", "1"), ("Kamar Tidur", "3"), ("Konsep dan Gaya Rumah", "Modern"), ("Luas Tanah", "120 m&sup2;")]
    pages = spark.createDataFrame([
        ("u1", "bali", detail("T", price="<b>Rp</b> 1,5 Miliar", pairs=pairs)),
        ("u2", "riau", detail("T2", location=None, update="Diperbarui")), ("u3", "riau", None)],
        "url string, province string, html string")
    got = {r["link_rumah123"]: r for r in P.detail_records(pages, SITE, None).collect()}
    assert set(got) == {"u1", "u2"}
    r = got["u1"]
    assert list(r.asDict()) == LISTING.names
    assert (r["harga"], r["kamar_tidur"], r["kamar_tidur_pembantu"], r["konsep_dan_gaya_rumah"], r["luas_tanah"]) == (
        "Rp 1,5 Miliar", "1", "1", "Modern", "120 m²")
    assert (r["provinsi"], r["kecamatan"], r["agen"], r["hook"]) == ("bali", "Cibeunying", "Sari", None)
    assert (got["u2"]["kecamatan"], got["u2"]["terakhir_diperbarui"]) == (None, None)
    digits = P.detail_records(pages, P.Site(BASE, exact_labels=True), None, digits_price=True)
    r = digits.filter("link_rumah123 = 'u1'").first()
    assert (r["harga"], r["kamar_tidur"]) == ("15", "3")


def test_required_columns_name_the_first_missing(spark):
    df = spark.createDataFrame([], RAW_LISTING).drop("agen", "hook")
    with pytest.raises(ValueError, match="agen"):
        C.clean_listings(df)
    clean = C.clean_listings(spark.createDataFrame([], RAW_LISTING))
    assert clean.schema == LISTING
    assert C.clean_listings(clean.withColumn("harga", F.lit("x"))).schema["kamar_tidur"] == LISTING["kamar_tidur"]
    assert LISTING_REQUIRED == LISTING.names[:34]


def test_progress(spark, tmp_path):
    path = str(tmp_path / "p")
    progress.init_progress(spark, path)
    state = progress.read_progress(spark, path)
    assert progress.selected(state).count() == len(PROVINCES) == 34
    progress.write_progress(progress.advance(state), path)
    assert progress.read_progress(spark, path).first()["current_page"] == 2
    single = tmp_path / "progress.json"
    single.write_text('{\n"current_page": 3, "provinces": {"bali": 3, "riau": 4, "aceh": 2}}')
    rows = progress.selected(progress.read_progress(spark, str(single))).collect()
    assert [tuple(r) for r in rows] == [(3, "bali", 3)]
    single.write_text("{broken")
    with pytest.raises(Exception):
        progress.read_progress(spark, str(single)).first()


def test_sinks(spark, tmp_path):
    root = str(tmp_path / "t")
    df = spark.createDataFrame([("a", 1, "x"), ("b", 1, " y ,\n\"q\""), ("b", 2, "")], "province string, page int, v string")
    assert sinks.overwrite_partitions(df, root, ["province", "page"]) == 3
    assert sinks.overwrite_partitions(df.filter("page = 2").withColumn("v", F.lit("new")), root, ["province", "page"]) == 1
    assert sinks.overwrite_partitions(df.filter("page = 9"), root, ["province", "page"]) == 0
    assert {r["v"] for r in spark.read.parquet(root).collect()} == {"x", " y ,\n\"q\"", "new"}
    assert sinks.append_rows(df, root, ["province", "page"]) == 3
    assert spark.read.parquet(root).count() == 6
    one = str(tmp_path / "one")
    assert sinks.write_page(df, one, 4, "csv") == 3
    assert os.path.isdir(f"{one}/page_4")
    back = files.read_csv_by_name(spark, f"{one}/page_4", ["v"]).select("v").collect()
    assert {r["v"] for r in back} == {"x", " y ,\n\"q\"", None}


def test_page_read_opens_only_its_folders(spark, tmp_path):
    root = str(tmp_path / "raw")
    base = spark.createDataFrame([tuple([None] * 35)], RAW_LISTING)
    many = base.crossJoin(spark.range(6).selectExpr("concat('p', id % 2) province", "cast(id div 2 as int) page"))
    sinks.append_rows(many, root, ["province", "page"])
    found = listings.read_page(spark, root, ["p0", "nowhere"], 1)
    assert {(r["province"], r["page"]) for r in found.select("province", "page").collect()} == {("p0", 1)}
    assert all("province=p0/page=1" in f for f in found.inputFiles())
    assert listings.read_page(spark, root, ["nowhere"], 1) is None
    assert listings.read_page(spark, root, [], 1) is None
    assert listings.read_all(spark, root).count() == 6


def test_bad_file_is_skipped_in_the_title_scan(spark, tmp_path):
    os.makedirs(tmp_path / "bali")
    (tmp_path / "bali" / "page_1_bali.csv").write_text("judul_iklan,kecamatan\nA,x\n")
    (tmp_path / "bali" / "page_2_bali.csv").write_text("other\n1\n")
    (tmp_path / "bali" / "page_3_bali.csv").write_text("")
    rows = listings.read_titles_csv(spark, str(tmp_path)).collect()
    assert [(r["judul_iklan"], r["province"], r["page"]) for r in rows] == [("A", "bali", 1)]


def test_provinces(spark, tmp_path):
    header = ("Provinsi,UMP,populasi (ribu),kepadatan(/km^2),PDRB (miliar),tingkat_pengangguran,"
              "tingkat_penyelesaian_pendidikan_SD,tingkat_penyelesaian_pendidikan_SMP,tingkat_penyelesaian_pendidikan_SMA")
    path = tmp_path / "p.csv"
    path.write_bytes((header + "\r\nAceh,3460672,5554.8,98,227110,5.75,99.08,94.55,74.46\r\n").encode())
    row = provinces.read_provinces(spark, str(path)).first()
    assert tuple(row) == ("Aceh", 3460672, 5554.8, 98, 227110, 5.75, 99.08, 94.55, 74.46)
    path.write_text(header.replace("Provinsi,UMP", "UMP,Provinsi") + "\n1,Aceh,1,1,1,1,1,1,1\n")
    with pytest.raises(Exception):
        provinces.read_provinces(spark, str(path)).collect()
