"""Queries of the guards: bad rows and files, failed fetches, missing columns, empty results, jobs that stop half-way.

Registered with those of ``catalog`` over the same tables.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import clean as C, facilities as A, keys as K, pages as P, provinces as PV
from ..schemas import FACILITY_COUNTS, LISTING, PROVINCES, RAW_FACILITY
from ..sources import facilities as RF, listings as L, pages as PG, sinks
from ..sources.files import file_system, read_rows
from ..streaming import arrivals as AV, progress as G
from .catalog import (
    _COUNT_FILTERS, _COUNT_SUMS, _DETAILS, _EXTRACTED, SITE, _event_places, _extract_store, _fetched_pages, _named_listings, _query, _raw_facilities,
    _raw_listings, _read, _scratch,
)
from .clean import clean_page
from .count import count_districts
from .extract import extract_page
from .store import Store

# Bad rows -------------------------------------------------------------------

_LINE = """
    CASE o_orderkey % 7 WHEN 0 THEN concat('t', CAST(o_orderkey AS STRING)) WHEN 1 THEN concat(',', CAST(o_custkey AS STRING), ',x')
      WHEN 2 THEN concat('t', CAST(o_orderkey AS STRING), ',1,x,more,fields')
      ELSE concat('t', CAST(o_orderkey AS STRING), ',', CAST(o_custkey AS STRING), ',"a, ""quoted"" x"') END"""


def _broken_tree(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as lines of files by status, each with a header; that of status P lacks the title."""
    root = _scratch(spark, "broken")
    orders = _read(spark, folder, "orders").select("o_orderstatus", F.expr(_LINE).alias("line"))
    # Lines go out as they are: one column named by the header, no quotes, a separator that no line has.
    plain = {"header": True, "sep": "\x01", "quote": "\x00", "emptyValue": "", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    untitled = F.col("o_orderstatus").eqNullSafe("P")
    for rows, header in ((orders.filter(untitled), "other,harga,kecamatan"), (orders.filter(~untitled), "judul_iklan,harga,kecamatan")):
        rows.withColumnRenamed("line", header).write.options(**plain).mode("append").partitionBy("o_orderstatus").csv(root)
    return read_rows(spark, root, ["judul_iklan"])


_REASON = """
    CASE WHEN o_orderstatus = 'P' THEN 'no column judul_iklan' WHEN o_orderkey % 7 IN (0, 2) THEN 'fields'
         WHEN o_orderkey % 7 = 1 THEN 'no value of judul_iklan' END"""


@_query(f"""
    WITH x AS (SELECT *, {_REASON} AS reason, {_LINE} AS text FROM orders)
    SELECT CASE WHEN reason IS NULL THEN concat('t', CAST(o_orderkey AS STRING)) END AS judul_iklan,
           CASE WHEN reason IS NULL THEN CAST(o_custkey AS STRING) END AS harga, CASE WHEN reason IS NULL THEN 'a, "quoted" x' END AS kecamatan,
           reason, CASE WHEN reason IS NOT NULL THEN text END AS line FROM x""")
def split_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Good and bad rows of a broken CSV tree, from the two folders they are split into."""
    root = _scratch(spark, "split")
    rows = _broken_tree(spark, folder)
    sinks.write_split(rows, root)
    parts = [spark.read.schema(rows.schema).parquet(sinks.split_path(root, good)) for good in (True, False)]
    return K.union_pages(parts).select("judul_iklan", "harga", "kecamatan", F.col("_reason").alias("reason"), F.col("_line").alias("line"))


@_query(f"SELECT o_orderstatus AS file, {_REASON} AS reason, count(*) AS rows FROM orders GROUP BY ALL")
def split_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Rows by file and reason."""
    counts = sinks.write_split(_broken_tree(spark, folder), _scratch(spark, "split"))
    # A status is a folder of files.
    return counts.groupBy(F.regexp_extract("file", "o_orderstatus=([^/]+)", 1).alias("file"), "reason").agg(F.sum("rows").alias("rows"))


# Failed fetches and counts ----------------------------------------------------

@_query(f"SELECT x.* EXCLUDE (link_rumah123), x.link_rumah123 AS url FROM ({_DETAILS}) x JOIN pages p ON p.url = x.link_rumah123 WHERE length(p.html) % 3 <> 0")
def failed_details(spark: SparkSession, folder: str) -> DataFrame:
    """Detail records where the fetch of every third page, by its length, failed and left no markup."""
    pages = _read(spark, folder, "pages").select("url", F.when(F.length("html") % 3 != 0, F.col("html")).alias("html"))
    records = P.detail_records(pages, SITE, None).drop("provinsi", "waktu_scraping")
    names = ["judul_iklan", "harga", "kecamatan", "kabupaten_kota", "terakhir_diperbarui", "agen", *SITE.labels]
    return records.select(*names, F.col("link_rumah123").alias("url"))


@_query("""
    SELECT c_custkey, c_nationkey AS a, CAST(floor(c_acctbal) AS BIGINT) AS b, '2024-05-01T00:00:00.000000' AS timestamp, 'success' AS status
    FROM customer WHERE c_mktsegment <> 'BUILDING' AND c_nationkey <> 3""")
def failed_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Districts of which any count failed give no row."""
    counts = _read(spark, folder, "customer").select(
        "c_custkey", F.nullif("c_nationkey", F.lit(3)).alias("a"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.floor("c_acctbal")).alias("b"))
    return A.facility_rows(counts, datetime(2024, 5, 1))


# Missing columns, empty results and stops ---------------------------------------

def _refusal(act) -> str:
    try:
        act()
    except ValueError as error:
        return str(error)
    return "accepted"


@_query("""
    SELECT 'listings' AS kind, 'agen' AS lacking, (SELECT count(*) FROM orders) AS rows, true AS refused, true AS named
    UNION ALL SELECT 'facilities', 'jumlah_fasilitas_kesehatan', (SELECT count(*) FROM customer), true, true
    UNION ALL SELECT 'none', 'none', (SELECT count(*) FROM orders), false, false""")
def required_columns(spark: SparkSession, folder: str) -> DataFrame:
    """Raw tables without a column that cleaning needs are refused by its name; whole ones are not."""
    listings, found = _raw_listings(spark, folder), _raw_facilities(spark, folder)
    cases = [("listings", "agen", listings, C.clean_listings), ("facilities", "jumlah_fasilitas_kesehatan", found, C.clean_facilities),
             ("none", "none", listings, C.clean_listings)]
    frames = []
    for kind, lacking, rows, clean in cases:
        said = _refusal(lambda: clean(rows.drop(lacking)))
        frames.append(rows.agg(F.count("*").alias("rows")).select(
            F.lit(kind).alias("kind"), F.lit(lacking).alias("lacking"), "rows", F.lit(said != "accepted").alias("refused"),
            F.lit(lacking in said).alias("named")))
    return K.union_pages(frames)


def _listing_store(spark: SparkSession, folder: str, name: str, **options) -> Store:
    store = Store.under(_scratch(spark, name), **options)
    raw = _raw_listings(spark, folder, F.col("o_orderstatus").alias("province"), F.lit(1).alias("page"))
    sinks.append_rows(raw.select(*L.STORED.names), store.raw_listings, ["province", "page"])
    G.init_progress(spark, store.progress, ["F", "O", "P"])
    return store


def _exists(spark: SparkSession, path: str) -> bool:
    files, at = file_system(spark, path)
    return files.exists(at)


@_query("SELECT count(*) AS listings, 0 AS facilities, false AS facility_page, 2 AS current_page FROM orders")
def empty_facilities(spark: SparkSession, folder: str) -> DataFrame:
    """A page whose districts have no stored facilities: listings are written, no facility page is."""
    store = _listing_store(spark, folder, "empty_facilities")
    others = _raw_facilities(spark, folder).withColumn("kecamatan", F.concat(F.lit("nowhere "), "kecamatan"))
    sinks.append_rows(others.select(*RAW_FACILITY.names), store.raw_facilities, [])
    done = clean_page(spark, store)
    written = spark.read.parquet(store.clean_listings).agg(F.count("*").alias("listings"))
    return written.select(
        "listings", F.lit(done.facilities).alias("facilities"), F.lit(_exists(spark, f"{store.clean_facilities}/page=1")).alias("facility_page"),
        F.lit(G.newest_state(spark, store.progress)["current_page"]).alias("current_page"))


@_query("""
    SELECT n AS step, CASE n WHEN 0 THEN 1 ELSE 2 END AS current_page, (SELECT count(*) FROM orders) AS listings,
           CASE n WHEN 0 THEN 0 ELSE (SELECT count(*) FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)) END AS facilities
    FROM (SELECT 0 AS n UNION ALL SELECT 1)""")
def stopped_batch(spark: SparkSession, folder: str) -> DataFrame:
    """A clean job that stops between its two tables, as the facilities cannot be read, and the run after the repair.

    The first run leaves the state as it is; the second replaces what the first has written.
    """
    store = Store.under(_scratch(spark, "stopped"))
    raw = _named_listings(spark, folder)
    sinks.append_rows(raw.select(*L.STORED.names), store.raw_listings, ["province", "page"])
    G.init_progress(spark, store.progress, ["F", "O", "P"])
    facilities = _raw_facilities(spark, folder).select(*RAW_FACILITY.names)
    broken = facilities.withColumns({c: F.lit(1.5) for c in FACILITY_COUNTS})
    steps = []
    for step, stored in enumerate((broken, facilities)):
        stored.write.mode("overwrite").parquet(store.raw_facilities)
        stopped = False
        try:
            clean_page(spark, store)
        except Exception:  # noqa: BLE001  whatever stops the first run
            stopped = True
        if stopped != (step == 0):
            raise RuntimeError(f"step {step} should {'not ' if step else ''}have stopped")
        counts = [spark.read.parquet(path).count() if _exists(spark, path) else 0 for path in (store.clean_listings, store.clean_facilities)]
        steps.append((step, G.newest_state(spark, store.progress)["current_page"], *counts))
    return spark.createDataFrame(steps, "step int, current_page int, listings long, facilities long")


# Layouts ---------------------------------------------------------------------

@_query("SELECT page_id, url, md5(html) AS markup, 2 AS fetched FROM pages WHERE url IN (SELECT url FROM pages WHERE length(html) % 2 = 0)")
def pages_in_folders(spark: SparkSession, folder: str) -> DataFrame:
    """Pages laid out in folders by url, in two fetches; the newest of those that are asked for."""
    root = _scratch(spark, "pages")
    pages = _read(spark, folder, "pages")
    keyed = pages.select("url", F.struct("page_id", "html").alias("_row"))
    for fetch in (1, 2):
        html = F.concat(F.col("_row.page_id").cast("string"), F.lit(" "), F.col("_row.html")) if fetch == 2 else F.lit("old")
        PG.write_pages(keyed.select("url", html.alias("html"), F.lit(fetch).alias("fetched")), root)
    asked = pages.filter(F.length("html") % 2 == 0).select("url").distinct()
    found = PG.newest(PG.fetched(PG.read_pages(spark, root, "fetched"), asked, "fetched"), "url", "fetched")
    space = F.instr("html", " ")
    return found.select(F.substring("html", 1, space - 1).cast("long").alias("page_id"), "url",
                        F.md5(F.substring("html", space + 1, F.length("html"))).alias("markup"), "fetched")


_CSV_NAME = "concat(CASE c_nationkey % 4 WHEN 0 THEN 'A/' WHEN 1 THEN 'A_' WHEN 2 THEN '.A%' ELSE '_' END, CAST(c_nationkey - c_nationkey % 4 AS STRING))"


@_query(f"""
    WITH named AS (SELECT c_custkey, {_CSV_NAME} AS kecamatan FROM customer),
         wanted AS (SELECT DISTINCT n.kecamatan FROM named n JOIN orders ON o_custkey = c_custkey),
         places AS (SELECT n.kecamatan, e.event_type FROM events e JOIN named n ON e.user_id = n.c_custkey)
    SELECT {_COUNT_SUMS}, w.kecamatan, '2024-05-01T00:00:00.000000' AS timestamp, 'success' AS status
    FROM wanted w LEFT JOIN places p ON p.kecamatan = w.kecamatan GROUP BY w.kecamatan""")
def count_files(spark: SparkSession, folder: str) -> DataFrame:
    """Count job into one CSV file a district, in two batches; names differ in characters that paths cannot hold."""
    store = Store.under(_scratch(spark, "count_files"), raw_format="csv")
    customers = _read(spark, folder, "customer").select("c_custkey", F.expr(_CSV_NAME).alias("kecamatan"))
    rows = _read(spark, folder, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey"))
    plain = rows.select(
        *[(F.col("kecamatan") if n == "kecamatan" else F.lit("x")).alias(n) for n in LISTING.names],
        F.when(F.col("o_orderstatus") == "P", "bali").otherwise("riau").alias("province"))
    # The districts of the one province come a batch later, beside those that are stored then.
    for province in ("bali", "riau"):
        sinks.write_csv_files(
            plain.filter(F.col("province") == province).select(*LISTING.names, F.lit(f"{province}/page_1_{province}.csv").alias("_into")),
            store.raw_listings, F.col("_into"), store.scratch_folder)
        G.init_progress(spark, store.progress, ["bali", "riau"])
        places = _read(spark, folder, "events").join(customers, F.col("user_id") == F.col("c_custkey")).select(
            "kecamatan", "event_type", F.lit("Indonesia").alias("country"), F.lit(6).alias("admin_level"))
        count_districts(spark, store, places, now=datetime(2024, 5, 1), filters=_COUNT_FILTERS)
    return RF.read_facilities_csv(spark, store.raw_facilities).select(*RAW_FACILITY.names)


# CSV files do not tell an empty text from none.
@_query(f"SELECT * REPLACE ({', '.join(f'nullif({c}, {chr(39) * 2}) AS {c}' for c in ('harga', 'kecamatan', 'kabupaten_kota', 'terakhir_diperbarui', 'agen', *SITE.labels))}) FROM ({_EXTRACTED})")
def extract_files(spark: SparkSession, folder: str) -> DataFrame:
    """The extract job into CSV files of provinces, known titles in a file as well."""
    store = _extract_store(spark, folder, "extract_files")
    known = L.read_all(spark, store.raw_listings).select(
        *[(F.col(n) if n == "judul_iklan" else F.lit(None).cast("string")).alias(n) for n in LISTING.names], F.lit("known/page_0_known.csv").alias("_into"))
    store = Store.under(_scratch(spark, "extract_files"), raw_format="csv")
    G.init_progress(spark, store.progress)
    sinks.write_csv_files(known, store.raw_listings, F.col("_into"), store.scratch_folder)
    extract_page(spark, store, _fetched_pages(spark, folder), SITE, datetime(2024, 5, 1), "fetched")
    rows = L.read_all_csv(spark, store.raw_listings).filter("province <> 'known'")
    return rows.select(
        "judul_iklan", "harga", "kecamatan", "kabupaten_kota", "terakhir_diperbarui", "agen", *SITE.labels, "link_rumah123",
        "provinsi", "province", "page", "waktu_scraping")


# Arrivals --------------------------------------------------------------------

_ARRIVED = _EXTRACTED.replace("1 AS page,", f"CAST(1 + c.page_id // {len(PROVINCES)} AS INT) AS page,").split("AND c.page_id IN")[0]


@_query(_ARRIVED)
def pages_arriving(spark: SparkSession, folder: str) -> DataFrame:
    """Every page as a search page and as the page behind its first link, arriving file by file; the details come in another order."""
    root = _scratch(spark, "arrivals")
    pages = _read(spark, folder, "pages").select("page_id", "html")
    number = F.col("page_id")
    province = F.get(F.array(*map(F.lit, PROVINCES)), number % len(PROVINCES))
    search = F.concat(F.lit(f"{SITE.base_url}/jual/"), province, F.lit("/rumah/?page="), F.floor(number / len(PROVINCES) + 1).cast("string"))
    cards = P.page_cards(pages, SITE)
    links = cards.filter("pos = 0").groupBy("link").agg(F.min("page_id").alias("page_id"))
    details = links.join(pages, "page_id").select("page_id", F.col("link").alias("url"), "html")
    parts = (pages.select(search.alias("url"), "html", (number % 3).alias("part")), details.select("url", "html", ((number + 1) % 3).alias("part")))
    K.union_pages(parts).repartition("part").write.partitionBy("part").parquet(f"{root}/pages")
    known = cards.filter("pos = 5").select("judul_iklan")
    tables = AV.Arrivals.under(root)
    AV.follow(spark, f"{root}/pages/part=*", tables, SITE, lambda titles: known.join(titles, "judul_iklan", "left_semi"), datetime(2024, 5, 1), 1)
    return AV.listings(spark, tables).select(
        "judul_iklan", "harga", "kecamatan", "kabupaten_kota", "terakhir_diperbarui", "agen", *SITE.labels, "link_rumah123",
        "provinsi", "province", "page", "waktu_scraping")


# Provinces -------------------------------------------------------------------

@_query("""
    SELECT trim(regexp_replace(lower(n_name), '[^a-z0-9]+', '-', 'g'), '-') AS province, n_regionkey AS kepadatan_per_km2,
           count(*) AS listings, CAST(sum(o_custkey) AS BIGINT) AS keys
    FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey WHERE n_regionkey IN (1, 3) GROUP BY ALL""")
def listings_of_provinces(spark: SparkSession, folder: str) -> DataFrame:
    """Stored listings of the provinces that a condition on the dimension leaves; other folders are not opened."""
    root = _scratch(spark, "by_province")
    nations = _read(spark, folder, "nation").select("n_nationkey", "n_name", F.col("n_regionkey").cast("int").alias("kepadatan_per_km2"))
    customers = _read(spark, folder, "customer").select("c_custkey", "c_nationkey")
    rows = _read(spark, folder, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey")).join(
        nations, F.col("c_nationkey") == F.col("n_nationkey")).select("o_custkey", PV.slug(F.col("n_name")).alias("province"))
    sinks.append_rows(rows, root, ["province"])
    provinces = nations.filter(F.col("kepadatan_per_km2").isin(1, 3)).select(F.col("n_name").alias("provinsi"), "kepadatan_per_km2")
    stored = spark.read.schema("o_custkey long, province string").parquet(root)
    return PV.with_province(stored, provinces).groupBy("province", "kepadatan_per_km2").agg(
        F.count("*").alias("listings"), F.sum("o_custkey").alias("keys"))


# Filters as a table ----------------------------------------------------------

def _made_filters(spark: SparkSession, folder: str) -> DataFrame:
    """Brands, types and beginnings of names of all parts as filters, those of a brand's parts in its category."""
    parts = _read(spark, folder, "part")
    made = [parts.select(F.col("p_brand").alias("category"), F.lit(tag).alias("tag"), literal.alias("literal")) for tag, literal in (
        ("p_name", F.substring("p_name", 1, 5)), ("p_type", F.substring("p_type", 2, 3)), ("p_name", F.substring("p_name", 3, 4)))]
    return K.union_pages(made).distinct().withColumn("filter", F.concat_ws("|", "category", "tag", F.substring("literal", 1, 2)))


@_query("""
    WITH filters AS (
        SELECT DISTINCT category, tag, literal, concat(category, '|', tag, '|', substr(literal, 1, 2)) AS filter FROM (
            SELECT p_brand AS category, 'p_name' AS tag, substr(p_name, 1, 5) AS literal FROM part
            UNION ALL SELECT p_brand, 'p_type', substr(p_type, 2, 3) FROM part
            UNION ALL SELECT p_brand, 'p_name', substr(p_name, 3, 4) FROM part)),
    values_ AS (SELECT p_size, 'p_name' AS tag, p_name AS value, count(*) AS n FROM part GROUP BY ALL
                UNION ALL SELECT p_size, 'p_type', p_type, count(*) FROM part GROUP BY ALL),
    hits AS (SELECT DISTINCT v.tag, v.value, f.filter, f.category FROM (SELECT DISTINCT tag, value FROM values_) v
             JOIN filters f ON f.tag = v.tag AND contains(v.value, f.literal))
    SELECT v.p_size AS kecamatan, h.category, CAST(sum(v.n) AS BIGINT) AS n FROM values_ v JOIN hits h ON h.tag = v.tag AND h.value = v.value
    GROUP BY ALL""")
def counts_by_filter_table(spark: SparkSession, folder: str) -> DataFrame:
    """Places counted by hundreds of filters that are a table."""
    places = _read(spark, folder, "part").select(F.col("p_size").alias("kecamatan"), "p_name", "p_type")
    return A.count_by_table(places, _made_filters(spark, folder))
