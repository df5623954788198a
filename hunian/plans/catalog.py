"""Queries over the given tables, one or more per operator, with equal SQL.

The tables stand in for the domain: orders are listings, their customers the
districts, events and parts the places, pages the fetched pages. ``QUERIES``
maps a name to ``(spark, folder) -> DataFrame``; ``SQL`` holds what an SQL engine
without Spark gives for the same tables. Every query reads its tables whole.
"""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import html as H
from ..functions import scalars as S
from ..functions.scalars import WHITESPACE
from ..operators import areas as AR, clean as C, facilities as A, keys as K, pages as P, similar as SM
from ..schemas import FACILITY_COUNTS, LISTING, PROVINCE_COLUMNS, PROVINCES, RAW_FACILITY
from ..sources import bucketed as BK, facilities as RF, listings as L, provinces as PR, sinks, titles as TI
from ..sources.files import fresh, read_csv_by_name
from ..streaming import progress as G
from .batch import run_batch
from .clean import clean_page
from .count import count_districts
from .extract import extract_page, index_titles, new_listings
from .store import Store, adopt_csv_tree

QUERIES: dict = {}
SQL: dict[str, str] = {}


def _query(sql: str | None = None):
    def register(build):
        QUERIES[build.__name__] = build
        if sql is not None:
            SQL[build.__name__] = sql
        return build
    return register


def _scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder for tables that a query writes, in the one all executors share."""
    return fresh(spark.conf.get("spark.checkpoint.dir"), name)


def _read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


# Facility counts ------------------------------------------------------------

EVENT_FILTERS = (
    ("cat_a", "event_type", "error|click"),
    ("cat_a", "event_type", "view|click"),
    ("cat_b", "event_type", "signup|purchase"),
)

_EVENT_COUNTS = """
    SELECT user_id AS kecamatan,
           CAST(sum(CASE WHEN regexp_matches(event_type, 'error|click') THEN 1 ELSE 0 END)
              + sum(CASE WHEN regexp_matches(event_type, 'view|click') THEN 1 ELSE 0 END) AS BIGINT) AS cat_a,
           CAST(sum(CASE WHEN regexp_matches(event_type, 'signup|purchase') THEN 1 ELSE 0 END) AS BIGINT) AS cat_b
    FROM events WHERE user_id IS NOT NULL GROUP BY user_id"""


def _event_counts(spark: SparkSession, folder: str) -> DataFrame:
    places = _read(spark, folder, "events").select(F.col("user_id").alias("kecamatan"), "event_type")
    return A.count_places(places, filters=EVENT_FILTERS)


def _order_listings(spark: SparkSession, folder: str) -> DataFrame:
    return _read(spark, folder, "orders").select(
        F.col("o_orderstatus").alias("page"), F.col("o_custkey").alias("kecamatan"), "o_orderkey")


@_query(f"""
    SELECT l.page, l.kecamatan, c.cat_a, c.cat_b
    FROM (SELECT DISTINCT o_orderstatus AS page, o_custkey AS kecamatan FROM orders) l
    JOIN ({_EVENT_COUNTS}) c ON c.kecamatan = l.kecamatan""")
def batch_facility_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Flagship: facility counts of the districts listed on each page, all pages at once."""
    districts = _order_listings(spark, folder).select("page", "kecamatan").distinct()
    return districts.join(_event_counts(spark, folder), "kecamatan").select("page", "kecamatan", "cat_a", "cat_b")


@_query(f"""
    SELECT k.kecamatan, coalesce(c.cat_a, 0) AS cat_a, coalesce(c.cat_b, 0) AS cat_b
    FROM (SELECT DISTINCT o_custkey AS kecamatan FROM orders WHERE o_custkey IS NOT NULL) k
    LEFT JOIN ({_EVENT_COUNTS}) c ON c.kecamatan = k.kecamatan""")
def counts_with_zeros(spark: SparkSession, folder: str) -> DataFrame:
    """Count job: every district gets a row, without places the counts are zero."""
    districts = K.distinct_keys(_order_listings(spark, folder), "kecamatan")
    return A.counts_for(districts, _event_counts(spark, folder))


PART_FILTERS = (
    ("cat_a", "p_name", "ring|hot"),
    ("cat_a", "p_type", "LARGE|SMALL"),
    ("cat_b", "p_name", "bolt|gear"),
)


def _part_sql(full: bool) -> str:
    def count(tag: str, pattern: str) -> str:
        test = f"regexp_full_match({tag}, '{pattern}')" if full else f"regexp_matches({tag}, '{pattern}')"
        return f"sum(CASE WHEN {test} THEN 1 ELSE 0 END)"
    sums: dict[str, list[str]] = {}
    for category, tag, pattern in PART_FILTERS:
        sums.setdefault(category, []).append(count(tag, pattern))
    columns = ", ".join(f"CAST({' + '.join(s)} AS BIGINT) AS {c}" for c, s in sums.items())
    return f"SELECT p_brand, {columns} FROM part WHERE p_brand IS NOT NULL GROUP BY p_brand"


@_query(_part_sql(full=False))
def category_counts(spark: SparkSession, folder: str) -> DataFrame:
    return A.count_places(_read(spark, folder, "part"), "p_brand", PART_FILTERS)


@_query(_part_sql(full=True))
def category_counts_whole_value(spark: SparkSession, folder: str) -> DataFrame:
    return A.count_places(_read(spark, folder, "part"), "p_brand", PART_FILTERS, whole_value=True)


@_query("""
    SELECT k.kecamatan, p.n_places
    FROM (SELECT DISTINCT s_suppkey AS kecamatan FROM supplier) k
    JOIN (SELECT l_suppkey AS kecamatan, count(*) AS n_places FROM lineitem
          WHERE l_returnflag = 'R' AND l_linenumber = 6 GROUP BY l_suppkey) p ON p.kecamatan = k.kecamatan""")
def places_of_districts(spark: SparkSession, folder: str) -> DataFrame:
    """Places of the right country and admin level, counted per known district."""
    places = _read(spark, folder, "lineitem").select(
        F.col("l_suppkey").alias("kecamatan"), F.col("l_returnflag").alias("country"),
        F.col("l_linenumber").alias("admin_level"))
    counts = A.places_in(places, "R").groupBy("kecamatan").agg(F.count(F.lit(1)).alias("n_places"))
    districts = _read(spark, folder, "supplier").select(F.col("s_suppkey").alias("kecamatan")).distinct()
    return counts.join(districts, "kecamatan").select("kecamatan", "n_places")


# Fixed shape of the made districts: a star of eight corners, and a square hole in every third.
_STAR = ((4, 0), (1, 1), (0, 4), (-1, 1), (-4, 0), (-1, -1), (0, -4), (1, -1))
_HOLE = ((-0.5, -0.5), (0.5, -0.5), (0.5, 0.5), (-0.5, 0.5))
_DISTRICT_X, _DISTRICT_Y = "CAST(s_suppkey * 37 % 100 AS DOUBLE)", "CAST(s_suppkey * 61 % 100 AS DOUBLE)"
_DISTRICT_SIZE = "CAST(1 + s_nationkey % 4 AS DOUBLE)"
# A third of the places and more lie on two spots.
_PLACE_X = "CASE WHEN l_linenumber <= 2 THEN 37.5 + l_linenumber ELSE CAST(l_partkey * 13 % 1000 AS DOUBLE) / 10 + l_quantity / 100 END"
_PLACE_Y = "CASE WHEN l_linenumber <= 2 THEN 61.0 ELSE CAST((l_suppkey * 29 + l_orderkey * 7) % 1000 AS DOUBLE) / 10 + l_discount END"


def _edges_sql() -> str:
    made = []
    for ring, only in ((_STAR, "true"), (_HOLE, "s_suppkey % 3 = 0")):
        for (a, b), (c, d) in zip(ring, (*ring[1:], ring[0])):
            made.append(f"SELECT s_suppkey, {_DISTRICT_X} + ({a}) * {_DISTRICT_SIZE} AS x1, {_DISTRICT_Y} + ({b}) * {_DISTRICT_SIZE} AS y1, "
                        f"{_DISTRICT_X} + ({c}) * {_DISTRICT_SIZE} AS x2, {_DISTRICT_Y} + ({d}) * {_DISTRICT_SIZE} AS y2 "
                        f"FROM supplier WHERE s_nationkey % 2 = 0 AND {only}")
    return " UNION ALL ".join(made)


@_query(f"""
    WITH edges AS MATERIALIZED ({_edges_sql()}),
    places AS (SELECT l_orderkey, l_linenumber, {_PLACE_X} AS x, {_PLACE_Y} AS y FROM lineitem),
    points AS MATERIALIZED (SELECT x, y, count(*) AS n, CAST(sum(l_linenumber) AS BIGINT) AS lines FROM places GROUP BY x, y),
    inside AS (
        SELECT p.x, p.y, p.n, p.lines, e.s_suppkey FROM points p JOIN edges e
        ON (e.y1 > p.y) <> (e.y2 > p.y) AND p.x < (e.x2 - e.x1) * (p.y - e.y1) / nullif(e.y2 - e.y1, 0) + e.x1
        GROUP BY ALL HAVING count(*) % 2 = 1)
    SELECT s_suppkey AS kecamatan, CAST(sum(n) AS BIGINT) AS n_places, CAST(sum(lines) AS BIGINT) AS n_lines FROM inside GROUP BY s_suppkey""")
def places_by_area(spark: SparkSession, folder: str) -> DataFrame:
    """Places counted by the district whose area they lie in, districts being areas with holes that overlap."""
    def ring(corners):
        return F.array(*[F.struct((F.expr(_DISTRICT_X) + F.lit(float(a)) * F.expr(_DISTRICT_SIZE)).alias("x"),
                                  (F.expr(_DISTRICT_Y) + F.lit(float(b)) * F.expr(_DISTRICT_SIZE)).alias("y")) for a, b in corners])

    areas = _read(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("kecamatan"), F.lit("Indonesia").alias("country"), (F.col("s_nationkey") % 2 + 6).alias("admin_level"),
        F.when(F.col("s_suppkey") % 3 == 0, F.array(ring(_STAR), ring(_HOLE))).otherwise(F.array(ring(_STAR))).alias("rings"))
    places = _read(spark, folder, "lineitem").select("l_linenumber", F.expr(_PLACE_X).alias("lon"), F.expr(_PLACE_Y).alias("lat"))
    counts = AR.counts_within(places, A.places_in(areas, "Indonesia"), ("l_linenumber",), cell=1.0)
    return counts.withColumnRenamed("l_linenumber", "n_lines")


# Scalars --------------------------------------------------------------------

_PRICE_TEXT = """
    CASE o_orderpriority
      WHEN '1-URGENT' THEN concat('Rp ', CAST(CAST(floor(o_totalprice / 1000) AS BIGINT) AS STRING), ' Juta')
      WHEN '2-HIGH' THEN concat('Rp ', CAST(CAST(floor(o_totalprice / 1000) AS BIGINT) AS STRING), ',5 Miliar')
      WHEN '3-MEDIUM' THEN concat('Mulai Rp ', CAST(CAST(floor(o_totalprice / 1000) AS BIGINT) AS STRING), ',25 Juta')
      WHEN '4-NOT SPECIFIED' THEN concat('Hubungi agen ', CAST(o_custkey AS STRING))
    END"""


def _price_sql(number: str, text: str) -> str:
    def amount(unit: str, worth: int) -> str:
        return (f"WHEN regexp_matches({text}, 'Rp {number} {unit}') THEN CAST(TRY_CAST(replace("
                f"regexp_extract({text}, 'Rp ({number}) {unit}', 1), ',', '.') AS DECIMAL(18,6)) * {worth} AS BIGINT)")
    return f"CASE {amount('Miliar', 1000000000)} {amount('Juta', 1000000)} END"


@_query(f"""
    SELECT o_orderkey, {_price_sql('[0-9]+,[0-9]+', 't')} AS harga,
           {_price_sql('[0-9]+(?:,[0-9]+)?', 't')} AS harga_whole
    FROM (SELECT o_orderkey, {_PRICE_TEXT} AS t FROM orders)""")
def price_parse(spark: SparkSession, folder: str) -> DataFrame:
    text = F.expr(_PRICE_TEXT)
    return _read(spark, folder, "orders").select(
        "o_orderkey", S.price(text).alias("harga"), S.price(text, allow_whole=True).alias("harga_whole"))


@_query("""
    SELECT c_custkey, TRY_CAST(nullif(regexp_replace(c_name, '[^0-9]', '', 'g'), '') AS BIGINT) AS number,
           TRY_CAST(nullif(regexp_replace(c_mktsegment, '[^0-9]', '', 'g'), '') AS BIGINT) AS none
    FROM customer""")
def digits_only(spark: SparkSession, folder: str) -> DataFrame:
    return _read(spark, folder, "customer").select(
        "c_custkey", S.digits_only(F.col("c_name")).alias("number"),
        S.digits_only(F.col("c_mktsegment")).alias("none"))


def _int_sql(text: str) -> str:
    """Guarded integer cast in DuckDB; its own cast would round and take exponents."""
    return (f"CASE WHEN regexp_full_match({text}, '\\s*[+-]?[0-9]+(\\.[0-9]*)?\\s*') "
            f"THEN TRY_CAST(regexp_extract({text}, '([+-]?[0-9]+)', 1) AS INTEGER) END")


_ODD_INT = """
    CASE l_linenumber WHEN 1 THEN concat(q, '.7') WHEN 2 THEN concat(' ', q, ' ') WHEN 3 THEN concat(q, ' Watt')
      WHEN 4 THEN concat(q, 'e3') WHEN 5 THEN concat('-', q, '.') WHEN 6 THEN concat(q, '000000000') ELSE '' END"""


@_query(f"""
    SELECT l_orderkey, l_linenumber, l_partkey, {_int_sql('t')} AS n
    FROM (SELECT *, {_ODD_INT} AS t FROM (SELECT *, CAST(CAST(l_quantity AS INT) AS STRING) AS q FROM lineitem))""")
def guarded_int_cast(spark: SparkSession, folder: str) -> DataFrame:
    rows = _read(spark, folder, "lineitem").withColumn("q", F.expr("CAST(CAST(l_quantity AS INT) AS STRING)"))
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", S.to_int(F.expr(_ODD_INT)).alias("n"))


@_query(f"SELECT event_id, {_int_sql(chr(40) + 'json_extract_string(props, ' + chr(39) + '$.k' + chr(39) + '))')} AS k FROM events")
def typed_json(spark: SparkSession, folder: str) -> DataFrame:
    return _read(spark, folder, "events").select("event_id", S.json_int(F.col("props"), "$.k").alias("k"))


@_query("SELECT doc_id, CAST(len(string_split(text, ' ')) AS INT) AS n_elements FROM documents")
def json_elements(spark: SparkSession, folder: str) -> DataFrame:
    """Length of the ``elements`` array of a JSON reply, one element per word."""
    reply = F.to_json(F.struct(F.split("text", " ").alias("elements")))
    return _read(spark, folder, "documents").select("doc_id", S.json_size(reply, "$.elements").alias("n_elements"))


@_query("SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS ts_text FROM events")
def iso_text(spark: SparkSession, folder: str) -> DataFrame:
    return _read(spark, folder, "events").select("event_id", S.iso_text(F.col("ts")).alias("ts_text"))


@_query(f"""
    SELECT page_id, trim(s[1], '{WHITESPACE}') AS first_part,
           CASE WHEN len(s) > 1 THEN trim(s[-1], '{WHITESPACE}') END AS last_part, s[3] AS host
    FROM (SELECT page_id, string_split(url, '/') AS s FROM pages)""")
def split_parts(spark: SparkSession, folder: str) -> DataFrame:
    url = F.col("url")
    return _read(spark, folder, "pages").select(
        "page_id", S.first_part(url, "/").alias("first_part"), S.last_part(url, "/").alias("last_part"),
        S.part(url, "/", 2).alias("host"))


@_query(f"""
    SELECT doc_id, string_split(s[1], ' ')[2] AS updated, trim(s[2], '{WHITESPACE}') AS agent
    FROM (SELECT doc_id, string_split(text, 'the') AS s FROM documents)""")
def update_and_agent(spark: SparkSession, folder: str) -> DataFrame:
    """The two halves of an update line, here around the word ``the``; whole texts."""
    text = F.col("text")
    return _read(spark, folder, "documents").select(
        "doc_id", S.update_date(text, "the").alias("updated"), S.update_agent(text, "the").alias("agent"))


# Typed tables ---------------------------------------------------------------

def _raw_listing_columns() -> dict[str, str]:
    """SQL text of every raw listing column over ``orders``, odd values included."""
    columns = {}
    for i, field in enumerate(LISTING):
        kind = field.dataType.simpleString()
        if field.name == "harga":
            text = _PRICE_TEXT
        elif kind == "int":
            tail = ["''", "'.9'", "' m'"]
            text = (f"CASE o_orderstatus WHEN 'F' THEN concat(CAST(o_custkey + {i} AS STRING), {tail[i % 3]}) "
                    f"WHEN 'O' THEN concat(' ', CAST(o_orderkey + {i} AS STRING)) END")
        elif kind == "float":
            text = f"CASE WHEN o_orderstatus = 'P' THEN '12 m2' ELSE concat(CAST(o_custkey + {i} AS STRING), '.5') END"
        elif kind == "timestamp":
            text = "CASE WHEN o_orderstatus = 'P' THEN 'never' ELSE concat('2024-05-01T00:00:0', substr(o_orderpriority, 1, 1)) END"
        else:
            text = f"concat('{field.name} ', o_orderpriority, ' ', CAST(o_orderkey AS STRING))"
        columns[field.name] = text
    return columns


def _clean_listing_sql() -> str:
    raw = ", ".join(f"{text} AS {name}" for name, text in _raw_listing_columns().items())
    clean = []
    for field in LISTING:
        kind = field.dataType.simpleString()
        if field.name == "harga":
            clean.append(f"{_price_sql('[0-9]+,[0-9]+', 'harga')} AS harga")
        elif kind == "int":
            clean.append(f"{_int_sql(field.name)} AS {field.name}")
        elif kind == "float":
            clean.append(f"CAST(TRY_CAST({field.name} AS FLOAT) AS DOUBLE) AS {field.name}")
        elif kind == "timestamp":
            clean.append(f"strftime(TRY_CAST({field.name} AS TIMESTAMP), '%Y-%m-%dT%H:%M:%S.%f') AS {field.name}")
        else:
            clean.append(field.name)
    return f"SELECT {', '.join(clean)} FROM (SELECT {raw} FROM orders)"


def _raw_listings(spark: SparkSession, folder: str, *more) -> DataFrame:
    columns = [F.expr(text).alias(name) for name, text in _raw_listing_columns().items()]
    return _read(spark, folder, "orders").select(*columns, *more)


def _named_listings(spark: SparkSession, folder: str) -> DataFrame:
    """Raw listings of orders with their status as province and the customer's name as district; joined before rows get wide."""
    customers = _read(spark, folder, "customer").select("c_custkey", "c_name")
    texts = {**_raw_listing_columns(), "kecamatan": "c_name"}
    rows = _read(spark, folder, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey"))
    return rows.select(
        *[F.expr(text).alias(name) for name, text in texts.items()], F.col("o_orderstatus").alias("province"), F.lit(1).alias("page"))


def _comparable(clean: DataFrame) -> DataFrame:
    """Floats as doubles and times as text, which both engines print alike."""
    return clean.withColumns({
        "luas_tanah": F.col("luas_tanah").cast("double"), "luas_bangunan": F.col("luas_bangunan").cast("double"),
        "waktu_scraping": S.iso_text(F.col("waktu_scraping"))})


@_query(_clean_listing_sql())
def typed_listings(spark: SparkSession, folder: str) -> DataFrame:
    return _comparable(C.clean_listings(_raw_listings(spark, folder)))


_FACILITY_TEXT = {
    name: f"CASE c_mktsegment WHEN 'BUILDING' THEN 'n/a' ELSE CAST(c_acctbal + {i} AS STRING) END"
    for i, name in enumerate(FACILITY_COUNTS)
}
_FACILITY_RAW = ", ".join(f"{text} AS {name}" for name, text in _FACILITY_TEXT.items())


def _raw_facilities(spark: SparkSession, folder: str) -> DataFrame:
    return _read(spark, folder, "customer").select(
        *[F.expr(text).alias(name) for name, text in _FACILITY_TEXT.items()],
        F.col("c_name").alias("kecamatan"), F.lit("2024-05-01T00:00:00").alias("timestamp"),
        F.lit("success").alias("status"))


_CLEAN_FACILITIES = (
    f"SELECT {', '.join(f'{_int_sql(c)} AS {c}' for c in FACILITY_COUNTS)}, kecamatan, "
    "strftime(TIMESTAMP '2024-05-01', '%Y-%m-%dT%H:%M:%S.%f') AS timestamp, 'success' AS status "
    f"FROM (SELECT {_FACILITY_RAW}, c_name AS kecamatan FROM customer)")


@_query(_CLEAN_FACILITIES)
def typed_facilities(spark: SparkSession, folder: str) -> DataFrame:
    clean = C.clean_facilities(_raw_facilities(spark, folder))
    return clean.withColumn("timestamp", S.iso_text(F.col("timestamp")))


# Pages ----------------------------------------------------------------------

SITE = P.Site(
    "http://site", card=H.Selector("li"), card_link=H.Selector("a", href_prefix="/"), card_heading=None,
    price=H.Selector("title"), location=H.Selector("div", ("ad",)), update=H.Selector("footer"),
    labels={"kamar_tidur": "The", "kamar_mandi": "que", "dapur": "der", "garasi": "Es"})

_MARKUP = ("regexp_replace(html, '(?s)<!--.*?-->|<script[\\s>].*?</script\\s*>|<style[\\s>].*?</style\\s*>', "
           "'', 'g')")


def _text_sql(inner: str) -> str:
    """Tags dropped, the entities of the test pages decoded, ends trimmed."""
    text = f"regexp_replace({inner}, '</?[a-zA-Z][^>]*>', '', 'g')"
    for entity, character in (("&copy;", "©"), ("&middot;", "·"), ("&quot;", '"'), ("&amp;", "&")):
        text = f"replace({text}, '{entity}', '{character}')"
    return f"trim({text}, '{WHITESPACE}')"


def _first_sql(pattern: str) -> str:
    return f"CASE WHEN regexp_matches(m, '{pattern}') THEN {_text_sql(f'regexp_extract(m, {chr(39)}{pattern}{chr(39)}, 1)')} END"


_H1, _TITLE = "(?s)<h1[^>]*>(.*?)</h1>", "(?s)<title[^>]*>(.*?)</title>"
_AD, _FOOTER = '(?s)<div class="ad">(.*?)</div>', "(?s)<footer[^>]*>(.*?)</footer>"
_MARKED = f"(SELECT page_id, url, {_MARKUP} AS m FROM pages WHERE html IS NOT NULL)"


@_query(f"""
    SELECT page_id, {_first_sql(_H1)} AS title, {_first_sql(_FOOTER)} AS footer, {_first_sql(_AD)} AS ad,
           CASE WHEN len(b) > 1 THEN {_text_sql('b[2]')} END AS second_link,
           regexp_extract(m, '<a href="([^"]*)"', 1) AS first_href
    FROM (SELECT *, regexp_extract_all(m, '(?s)<a href[^>]*>(.*?)</a>', 1) AS b FROM {_MARKED})""")
def page_fields(spark: SparkSession, folder: str) -> DataFrame:
    """Text of the n-th match of a selector and an attribute of the first."""
    m, link = F.col("m"), H.Selector("a", href_prefix="")
    pages = _read(spark, folder, "pages").select("page_id", H.visible_markup(F.col("html")).alias("m"))
    return pages.select(
        "page_id", H.selected_text(m, H.Selector("h1")).alias("title"),
        H.selected_text(m, H.Selector("footer")).alias("footer"),
        H.selected_text(m, H.Selector("div", ("ad",))).alias("ad"),
        H.selected_text(m, link, 1).alias("second_link"),
        H.let(H.element(m, link), lambda e: H.attribute(e, "href")).alias("first_href"))


_CARDS = f"""
    SELECT page_id, m, CAST(unnest(range(len(t))) AS INT) AS pos, {_text_sql('unnest(t)')} AS judul_iklan,
           concat('http://site', unnest(h)) AS link
    FROM (SELECT page_id, m, regexp_extract_all(m, '<li><a href="(/[^"]*)">[^<]*</a></li>', 1) AS h,
                 regexp_extract_all(m, '<li><a href="/[^"]*">([^<]*)</a></li>', 1) AS t FROM {_MARKED})"""


@_query(f"SELECT page_id, pos, judul_iklan, link FROM ({_CARDS}) WHERE judul_iklan <> ''")
def page_cards(spark: SparkSession, folder: str) -> DataFrame:
    return P.page_cards(_read(spark, folder, "pages").select("page_id", "html"), SITE)


# Paragraphs as the pieces before each end tag: the label is what follows the
# last opening tag, its value the next piece if that opens with its only one.
_PAIRS = f"""
    SELECT page_id, i, {_text_sql("regexp_extract(s[i], '(?s).*<p>(.*)$', 1)")} AS label,
           {_text_sql("regexp_extract(s[i + 1], '(?s)^[^<]*<p>(.*)$', 1)")} AS value
    FROM (SELECT page_id, s, unnest(range(1, len(s) - 1)) AS i
          FROM (SELECT page_id, string_split(m, '</p>') AS s FROM {_MARKED}))
    WHERE contains(s[i], '<p>') AND regexp_matches(s[i + 1], '^[^<]*<p>') AND len(string_split(s[i + 1], '<p>')) = 2"""
_LABELLED = ", ".join(
    f"arg_min(value, i) FILTER (contains(label, '{label}')) AS {name}" for name, label in SITE.labels.items())


@_query(f"""
    SELECT p.page_id, {', '.join('v.' + name for name in SITE.labels)}
    FROM pages p LEFT JOIN (SELECT page_id, {_LABELLED} FROM ({_PAIRS}) GROUP BY page_id) v ON v.page_id = p.page_id""")
def labelled_values(spark: SparkSession, folder: str) -> DataFrame:
    """Value after the first paragraph containing a label, adjacent paragraphs only."""
    pages = _read(spark, folder, "pages").select("page_id", H.visible_markup(F.col("html")).alias("m"))
    values = [H.labelled_value(F.col("pairs"), label).alias(name) for name, label in SITE.labels.items()]
    pairs = H.labelled_pairs(F.col("m"), list(SITE.labels.values()))
    return pages.select("page_id", pairs.alias("pairs")).select("page_id", *values)


_DETAILS = f"""
    SELECT judul_iklan, price AS harga, trim(loc[1], '{WHITESPACE}') AS kecamatan,
           CASE WHEN len(loc) > 1 THEN trim(loc[-1], '{WHITESPACE}') END AS kabupaten_kota,
           string_split(upd[1], ' ')[2] AS terakhir_diperbarui, trim(upd[2], '{WHITESPACE}') AS agen,
           d.url AS link_rumah123, {', '.join('v.' + name for name in SITE.labels)}
    FROM (SELECT page_id, url, {_first_sql(_H1)} AS judul_iklan, {_first_sql(_TITLE)} AS price,
                 string_split(nullif({_first_sql(_AD)}, ''), ',') AS loc,
                 string_split(nullif({_first_sql(_FOOTER)}, ''), 'oleh') AS upd FROM {_MARKED}) d
    LEFT JOIN (SELECT page_id, {_LABELLED} FROM ({_PAIRS}) GROUP BY page_id) v ON v.page_id = d.page_id"""


@_query(_DETAILS)
def detail_records(spark: SparkSession, folder: str) -> DataFrame:
    records = P.detail_records(_read(spark, folder, "pages").select("url", "html"), SITE, datetime(2024, 5, 1))
    return records.select(
        "judul_iklan", "harga", "kecamatan", "kabupaten_kota", "terakhir_diperbarui", "agen", "link_rumah123",
        *SITE.labels)


def _language(url: str = "url") -> str:
    return f"regexp_extract({url}, '/([a-z]+)/[0-9]', 1)"


@_query(f"""
    WITH cards AS ({_CARDS}),
         detail AS (SELECT link, min(page_id) AS page_id FROM cards WHERE pos = 0 GROUP BY link)
    SELECT c.link AS link_rumah123, {_language('p.url')} AS province, {_first_sql(_H1)} AS judul_iklan
    FROM cards c JOIN pages p ON p.page_id = c.page_id
    JOIN detail d ON d.link = c.link JOIN {_MARKED} t ON t.page_id = d.page_id
    WHERE c.judul_iklan <> ''
      AND NOT EXISTS (SELECT 1 FROM cards k WHERE k.pos = 5 AND k.judul_iklan = c.judul_iklan)""".replace(
    "regexp_matches(m,", "regexp_matches(t.m,").replace("regexp_extract(m,", "regexp_extract(t.m,").replace(
    "regexp_extract(t.m, '<li>", "regexp_extract(m, '<li>"))
def extracted_listings(spark: SparkSession, folder: str) -> DataFrame:
    """Extract job: cards of search pages, known titles out, joined with their detail pages.

    A page's first link serves as the address of its own detail page, the lowest
    page number wins an address, and the titles of sixth cards count as known.
    """
    pages = _read(spark, folder, "pages")
    searched = pages.select(F.expr(_language()).alias("province"), F.lit(1).alias("page"), "html")
    known = P.page_cards(pages.select("html"), SITE).filter(F.col("pos") == 5)
    first = H.let(H.element(H.visible_markup(F.col("html")), SITE.card_link), lambda a: H.attribute(a, "href"))
    details = pages.select(
        F.concat(F.lit(SITE.base_url), first).alias("url"), "html", (-F.col("page_id")).alias("version"))
    rows = new_listings(searched, details, known, SITE, _scratch(spark, "extracted"), datetime(2024, 5, 1), "version")
    return rows.select("link_rumah123", "province", "judul_iklan")


# Keys and joins -------------------------------------------------------------

@_query("""
    SELECT d.doc_id FROM documents d
    WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)
      AND NOT EXISTS (SELECT 1 FROM documents k JOIN labels l ON l.doc_id = k.doc_id WHERE k.text = d.text)""")
def new_titles(spark: SparkSession, folder: str) -> DataFrame:
    """Documents not stored (labelled) whose text is not stored; copies among them stay.

    Long texts are compared by their digest, so the join moves 32 bytes a row.
    """
    documents = _read(spark, folder, "documents").select("doc_id", F.unhex(F.sha2("text", 256)).alias("title"))
    labels = _read(spark, folder, "labels").select("doc_id").distinct()
    stored = documents.join(labels, "doc_id", "left_semi")
    return K.keep_new(documents.join(labels, "doc_id", "left_anti"), stored, "title").select("doc_id")


@_query("SELECT DISTINCT md5(text) AS title FROM conversations WHERE text IS NOT NULL")
def known_titles(spark: SparkSession, folder: str) -> DataFrame:
    return K.distinct_keys(_read(spark, folder, "conversations").select(F.md5("text").alias("title")), "title")


@_query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT user_id FROM events)")
def facility_semi(spark: SparkSession, folder: str) -> DataFrame:
    districts = _read(spark, folder, "events").select(F.col("user_id").alias("o_custkey"))
    return K.keep_known(_read(spark, folder, "orders").select("o_orderkey", "o_custkey"), districts, "o_custkey")


@_query("""
    SELECT DISTINCT k.key FROM (SELECT nullif(o_custkey, 7) AS key FROM orders) k
    WHERE k.key IS NOT NULL AND NOT EXISTS (SELECT 1 FROM events e WHERE e.user_id = k.key)""")
def missing_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Districts without a stored row; one district is made null and must not appear."""
    districts = _read(spark, folder, "orders").select(F.nullif("o_custkey", F.lit(7)).alias("key"))
    return K.missing_keys(districts, _read(spark, folder, "events").select(F.col("user_id").alias("key")), "key")


def _bucketed_customers(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as a table bucketed by district, in two batches."""
    root = _scratch(spark, "bucketed")
    rows = _read(spark, folder, "customer").select("c_custkey", F.col("c_name").alias("kecamatan"), "c_mktsegment")
    for batch in (rows.filter("c_mktsegment < 'G'"), rows.filter("c_mktsegment >= 'G'")):
        BK.append(batch, root, "kecamatan", 16)
    return BK.attach(spark, root, rows.schema, "kecamatan")


def _order_districts(spark: SparkSession, folder: str) -> DataFrame:
    """Names of customers that order, every third made one that is not stored."""
    key = F.col("o_custkey")
    return _read(spark, folder, "orders").select(
        F.when(key % 3 != 0, F.format_string("Customer#%09d", key)).otherwise(F.format_string("Other#%09d", key)).alias("kecamatan"))


@_query("SELECT c_custkey, c_name AS kecamatan, c_mktsegment FROM customer WHERE c_custkey % 3 <> 0 AND c_custkey IN (SELECT o_custkey FROM orders)")
def bucketed_semi(spark: SparkSession, folder: str) -> DataFrame:
    """Stored districts that are wanted; the stored side is not moved."""
    return K.stored_rows(_bucketed_customers(spark, folder), _order_districts(spark, folder), "kecamatan")


@_query("""
    SELECT DISTINCT concat('Other#', lpad(CAST(o_custkey AS STRING), 9, '0')) AS kecamatan FROM orders WHERE o_custkey % 3 = 0""")
def bucketed_missing(spark: SparkSession, folder: str) -> DataFrame:
    """Wanted districts that are not stored, against the bucketed table."""
    return K.missing_keys(_order_districts(spark, folder), _bucketed_customers(spark, folder), "kecamatan")


@_query("SELECT o_custkey AS key FROM orders WHERE o_custkey IS NOT NULL "
        "UNION SELECT user_id FROM events WHERE user_id IS NOT NULL")
def distinct_keys(spark: SparkSession, folder: str) -> DataFrame:
    orders = _read(spark, folder, "orders").select(F.col("o_custkey").alias("key"))
    return K.union_keys([orders, _read(spark, folder, "events").select(F.col("user_id").alias("key"))], "key")


@_query("SELECT DISTINCT nullif(l_suppkey, 3) AS key FROM lineitem")
def distinct_keys_with_null(spark: SparkSession, folder: str) -> DataFrame:
    rows = _read(spark, folder, "lineitem").select(F.nullif("l_suppkey", F.lit(3)).alias("key"))
    return K.distinct_keys(rows, "key", keep_null=True)


@_query("""
    SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'O' THEN o_orderpriority END AS extra FROM orders
    WHERE o_orderstatus IS NOT NULL""")
def union_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Pages with columns in another order, one with a column more."""
    orders = _read(spark, folder, "orders")
    return K.union_pages([
        orders.filter("o_orderstatus = 'O'").select("o_custkey", "o_orderkey", F.col("o_orderpriority").alias("extra")),
        orders.filter("o_orderstatus <> 'O'").select("o_orderkey", "o_custkey")])


@_query("""
    SELECT page, count(*) AS n_rows, count(DISTINCT kecamatan) AS n_districts
    FROM (SELECT o_orderstatus AS page, o_custkey AS kecamatan FROM orders) GROUP BY page""")
def batch_row_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Rows and districts per page. Two plain aggregates, so no row is expanded."""
    per_district = _order_listings(spark, folder).groupBy("page", "kecamatan").agg(F.count(F.lit(1)).alias("n"))
    return per_district.groupBy("page").agg(
        F.sum("n").alias("n_rows"), F.count("kecamatan").alias("n_districts"))


# Progress -------------------------------------------------------------------

_STATE = """
    SELECT c_custkey, c_nationkey AS current_page, province, page
    FROM (SELECT c_custkey, c_nationkey, unnest([c_mktsegment, 'next', 'own']) AS province,
                 unnest([c_nationkey, c_nationkey + 1, CAST(length(c_mktsegment) AS INT)]) AS page FROM customer)"""


def _states(spark: SparkSession, folder: str) -> DataFrame:
    """A progress document per customer: one province at its page, one ahead, one anywhere."""
    return _read(spark, folder, "customer").select(
        "c_custkey", F.col("c_nationkey").alias("current_page"),
        F.create_map(
            F.col("c_mktsegment"), F.col("c_nationkey"), F.lit("next"), F.col("c_nationkey") + 1,
            F.lit("own"), F.length("c_mktsegment")).alias("provinces"))


@_query(f"""
    SELECT c_custkey, current_page + 1 AS current_page, province,
           CASE WHEN page = current_page THEN page + 1 ELSE page END AS page FROM ({_STATE})""")
def progress_advance(spark: SparkSession, folder: str) -> DataFrame:
    moved = G.advance(_states(spark, folder))
    return moved.select("c_custkey", "current_page", F.explode("provinces").alias("province", "page"))


@_query(f"SELECT current_page, province, page, count(*) AS n FROM ({_STATE}) WHERE page = current_page GROUP BY ALL")
def progress_selected(spark: SparkSession, folder: str) -> DataFrame:
    chosen = G.selected(_states(spark, folder).select("current_page", "provinces"))
    return chosen.groupBy("current_page", "province", "page").agg(F.count(F.lit(1)).alias("n"))


@_query("""
    SELECT c_custkey, province, page
    FROM (SELECT c_custkey, c_nationkey AS province, CAST(length(c_mktsegment) AS INT) AS page FROM customer)
    WHERE (province, page) IN (SELECT n_nationkey, 8 + least(n_regionkey, 2) FROM nation)""")
def page_selection(spark: SparkSession, folder: str) -> DataFrame:
    """Listings of the page each province has reached."""
    listings = _read(spark, folder, "customer").select(
        "c_custkey", F.col("c_nationkey").alias("province"), F.length("c_mktsegment").alias("page"))
    reached = _read(spark, folder, "nation").select(
        F.col("n_nationkey").alias("province"), (F.lit(8) + F.least("n_regionkey", F.lit(2))).alias("page"))
    return K.on_selected_pages(listings, reached).select("c_custkey", "province", "page")


# Written tables -------------------------------------------------------------

@_query("SELECT CAST(c_custkey AS STRING) AS c_custkey, c_name, c_mktsegment AS page FROM customer")
def csv_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Export per page as CSV, read back by header name."""
    root = _scratch(spark, "csv_round_trip")
    rows = _read(spark, folder, "customer").select(
        "c_custkey", "c_name", F.col("c_mktsegment").alias("page"), F.col("c_mktsegment").alias("folder"))
    sinks.overwrite_partitions(rows, root, ["folder"], "csv")
    return read_csv_by_name(spark, root, ["c_custkey", "page"]).select("c_custkey", "c_name", "page")


def _cleaned_batch(spark: SparkSession, folder: str) -> Store:
    """Run the clean job on raw tables written from orders and customers.

    Order statuses are the provinces, all at page 1, and one province has no data.
    """
    store = Store.under(_scratch(spark, "clean_batch"))
    raw = _named_listings(spark, folder)
    sinks.append_rows(raw.select(*L.STORED.names), store.raw_listings, ["province", "page"])
    sinks.append_rows(_raw_facilities(spark, folder).select(*RAW_FACILITY.names), store.raw_facilities, [])
    G.init_progress(spark, store.progress, ["F", "O", "P", "none"])
    clean_page(spark, store)
    return store


@_query(f"""
    SELECT * FROM ({_CLEAN_FACILITIES})
    WHERE kecamatan IN (SELECT c_name FROM customer JOIN orders ON o_custkey = c_custkey)""")
def clean_batch_facilities(spark: SparkSession, folder: str) -> DataFrame:
    store = _cleaned_batch(spark, folder)
    written = spark.read.parquet(store.clean_facilities).drop("page")
    return written.withColumn("timestamp", S.iso_text(F.col("timestamp")))


def _cleaned_orders_sql() -> str:
    """Every cleaned column of the batch's listings, with the customer's name as district."""
    keyed = _clean_listing_sql().replace("FROM orders)", ", c_name FROM orders JOIN customer ON c_custkey = o_custkey)")
    return f"SELECT * EXCLUDE (kecamatan), 1 AS page FROM ({keyed.replace('SELECT judul_iklan', 'SELECT c_name, judul_iklan', 1)})"


@_query(f"SELECT * EXCLUDE (c_name), c_name AS kecamatan FROM ({_cleaned_orders_sql()})")
def clean_batch_listings(spark: SparkSession, folder: str) -> DataFrame:
    return _comparable(spark.read.parquet(_cleaned_batch(spark, folder).clean_listings))


# Trees of CSV files and the other jobs ---------------------------------------

def _csv_tree(spark: SparkSession, folder: str, name: str) -> Store:
    """Orders as page files of their status, customers as district files by market segment.

    Page F has a further column and another order of columns. Parts of large files are packed, as the tree is far larger than the tables.
    """
    store = Store.under(_scratch(spark, name), raw_format="csv")
    raw = _raw_listings(spark, folder, F.col("o_orderstatus").alias("status"), F.col("o_orderkey").cast("string").alias("extra"))
    file = F.format_string("%s/page_1_%s.csv", "status", "status")
    plain = raw.filter("status <> 'F'").withColumn("_into", file).select(*LISTING.names, "_into")
    turned = raw.filter("status = 'F'").withColumn("_into", file).select("extra", *reversed(LISTING.names), "_into")
    for rows in (plain, turned):
        sinks.write_csv_files(rows, store.raw_listings, F.col("_into"), store.scratch_folder, packed="gzip")
    facilities = _raw_facilities(spark, folder).join(
        _read(spark, folder, "customer").select(F.col("c_name").alias("kecamatan"), "c_mktsegment"), "kecamatan")
    sinks.write_csv_files(
        facilities.withColumn("_into", F.concat("c_mktsegment", F.lit(".csv"))).select(*RAW_FACILITY.names, "_into"),
        store.raw_facilities, F.col("_into"), store.scratch_folder, packed="gzip")
    return store


_RAW_SQL = ", ".join(f"{text} AS {name}" for name, text in _raw_listing_columns().items())
_TREE_SQL = (f"SELECT {_RAW_SQL}, CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderkey AS STRING) END AS extra, "
             "o_orderstatus AS province, 1 AS page FROM orders")
# CSV files do not tell an empty text from none.
_TREE_SQL = "SELECT " + ", ".join(
    f"nullif({name}, '') AS {name}" for name in LISTING.names) + f", extra, province, page FROM ({_TREE_SQL})"


@_query(_TREE_SQL)
def listing_tree(spark: SparkSession, folder: str) -> DataFrame:
    """Page files with two headers, read by name; province and page from the file names."""
    store = _csv_tree(spark, folder, "listing_tree")
    return L.read_page_csv(spark, store.raw_listings, ["F", "O", "P", "none"], 1)


@_query(f"SELECT judul_iklan, province, page FROM ({_TREE_SQL})")
def titles_tree(spark: SparkSession, folder: str) -> DataFrame:
    """Titles of the whole tree; files that lack the title column are skipped."""
    store = _csv_tree(spark, folder, "titles_tree")
    untitled = _read(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string").alias("other"),
        F.format_string("%s/page_2_%s.csv", "o_orderstatus", "o_orderstatus").alias("_into"))
    sinks.write_csv_files(untitled, store.raw_listings, F.col("_into"), store.scratch_folder)
    return L.read_titles_csv(spark, store.raw_listings).select("judul_iklan", "province", "page")


@_query(f"SELECT {_FACILITY_RAW}, c_name AS kecamatan, '2024-05-01T00:00:00' AS timestamp, 'success' AS status FROM customer")
def facility_tree(spark: SparkSession, folder: str) -> DataFrame:
    return RF.read_facilities_csv(spark, _csv_tree(spark, folder, "facility_tree").raw_facilities)


@_query(_TREE_SQL)
def adopted_tree(spark: SparkSession, folder: str) -> DataFrame:
    """A CSV tree copied into the Parquet store twice; all columns."""
    store = _csv_tree(spark, folder, "adopted_tree")
    target = Store.under(f"{store.scratch_folder}/adopted")
    adopt_csv_tree(spark, store, target)
    adopt_csv_tree(spark, store, target)
    return L.read_page(spark, target.raw_listings, ["F", "O", "P"], 1)


_ODD_NAMES = "concat(o_orderstatus, substr('=%:[]{}#', 1 + CAST(o_orderkey % 8 AS INT), 1), substr(o_orderpriority, 1, 1))"


@_query(f"SELECT concat('t', CAST(o_orderkey AS STRING)) AS judul_iklan, {_ODD_NAMES} AS province FROM orders")
def odd_province_names(spark: SparkSession, folder: str) -> DataFrame:
    """Provinces whose names a partition folder has to escape, written and read back by name."""
    root = _scratch(spark, "odd_names")
    rows = _read(spark, folder, "orders").select(
        F.concat(F.lit("t"), F.col("o_orderkey").cast("string")).alias("judul_iklan"), F.expr(_ODD_NAMES).alias("province"), F.lit(1).alias("page"))
    sinks.append_rows(rows, root, ["province", "page"])
    names = [r[0] for r in rows.select("province").distinct().collect()]
    return L.read_page(spark, root, names, 1).select("judul_iklan", "province")


@_query("SELECT n_name AS province, CAST(CASE WHEN n_regionkey = 1 THEN 2 ELSE n_regionkey END AS INT) AS page, 2 AS current_page FROM nation")
def progress_saved(spark: SparkSession, folder: str) -> DataFrame:
    """A state of all nations advanced, saved and read back; once in a folder and over a single file."""
    path = f"{_scratch(spark, 'progress')}/progress"
    nations = _read(spark, folder, "nation").select(F.map_from_entries(F.collect_list(F.struct(
        "n_name", F.col("n_regionkey").cast("int")))).alias("provinces"))
    nations.select(F.lit(1).alias("current_page"), "provinces").coalesce(1).write.json(path)
    G.write_progress(G.advance(G.read_progress(spark, path)), path)
    return G.progress_rows(G.read_progress(spark, path))


_COUNT_FILTERS = tuple(
    (name, "event_type", kind) for name, kind in zip(FACILITY_COUNTS, ("error", "click", "view", "signup|purchase", "error|click")))
_COUNT_SUMS = ", ".join(
    f"CAST(coalesce(sum(CASE WHEN regexp_matches(event_type, '{kind}') THEN 1 ELSE 0 END), 0) AS STRING) AS {name}"
    for name, _, kind in _COUNT_FILTERS)


@_query(f"""
    WITH raw AS (SELECT {_FACILITY_RAW}, c_name AS kecamatan, '2024-05-01T00:00:00' AS timestamp, 'success' AS status
                 FROM customer WHERE c_mktsegment = 'FURNITURE'),
         wanted AS (SELECT DISTINCT c_name AS kecamatan FROM customer JOIN orders ON o_custkey = c_custkey
                    WHERE c_mktsegment <> 'FURNITURE')
    SELECT * FROM raw
    UNION ALL BY NAME
    SELECT {_COUNT_SUMS}, w.kecamatan, '2024-05-01T00:00:00.000000' AS timestamp, 'success' AS status
    FROM wanted w LEFT JOIN events e ON concat('Customer#', lpad(CAST(e.user_id AS STRING), 9, '0')) = w.kecamatan
    GROUP BY w.kecamatan""")
def count_batch(spark: SparkSession, folder: str) -> DataFrame:
    """Count job over a page whose furniture districts are counted already; some districts have no places."""
    store = Store.under(_scratch(spark, "count_batch"))
    names = _read(spark, folder, "customer").select("c_custkey", "c_name", "c_mktsegment")
    raw = _read(spark, folder, "orders").join(names, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("c_name").alias("kecamatan"), F.col("o_orderstatus").alias("province"), F.lit(1).alias("page"))
    sinks.append_rows(raw, store.raw_listings, ["province", "page"])
    stored = names.filter("c_mktsegment = 'FURNITURE'").select(F.col("c_name").alias("kecamatan"))
    sinks.append_rows(_raw_facilities(spark, folder).join(stored, "kecamatan").select(*RAW_FACILITY.names), store.raw_facilities, [])
    G.init_progress(spark, store.progress, ["F", "O", "P"])
    count_districts(spark, store, _event_places(spark, folder), now=datetime(2024, 5, 1), filters=_COUNT_FILTERS)
    return RF.read_facilities(spark, store.raw_facilities)


def _event_places(spark: SparkSession, folder: str) -> DataFrame:
    return _read(spark, folder, "events").select(
        F.format_string("Customer#%09d", "user_id").alias("kecamatan"), "event_type", F.lit("Indonesia").alias("country"),
        F.lit(6).alias("admin_level"))


_SEARCHED = f"list_value({', '.join(repr(p) for p in PROVINCES)})[1 + CAST(c.page_id % {len(PROVINCES)} AS INT)]"

_EXTRACTED = f"""
    WITH cards AS ({_CARDS}),
         detail AS (SELECT link, min(page_id) AS page_id FROM cards WHERE pos = 0 GROUP BY link),
         known AS (SELECT judul_iklan FROM cards WHERE pos = 5)
    SELECT x.* EXCLUDE (link_rumah123), c.link AS link_rumah123, {_SEARCHED} AS provinsi,
           {_SEARCHED} AS province, 1 AS page, '2024-05-01T00:00:00.000000' AS waktu_scraping
    FROM cards c JOIN detail d ON d.link = c.link JOIN pages p ON p.page_id = d.page_id
    JOIN ({_DETAILS}) x ON x.link_rumah123 = p.url
    WHERE c.judul_iklan <> '' AND NOT EXISTS (SELECT 1 FROM known k WHERE k.judul_iklan = c.judul_iklan)
      AND c.page_id IN (SELECT max(page_id) FROM pages GROUP BY page_id % {len(PROVINCES)})"""


# Every page is a search page that is read.
_EXTRACTED_WHOLE = _EXTRACTED.split("AND c.page_id IN")[0]


def _fetched_pages(spark: SparkSession, folder: str, lists: bool = False) -> DataFrame:
    """Every page as two fetches of its province's search page, the largest ``page_id`` the newest, and as two of a detail page.

    The older of the two is another text. There are as many provinces as the site has, whatever the table's size.
    With ``lists`` every page is a search page of its own address, one of many of its province; ``_searches`` has them.
    """
    pages = _read(spark, folder, "pages").select("page_id", "html")
    first = H.let(H.element(H.visible_markup(F.col("html")), SITE.card_link), lambda a: H.attribute(a, "href"))
    search = _search_url(_province()) if not lists else _list_url()
    frames = []
    for url, version in ((search, F.col("page_id")), (F.concat(F.lit(SITE.base_url), first), -F.col("page_id"))):
        rows = pages.select(url.alias("url"), "html", version.cast("long").alias("fetched"))
        frames += [rows, rows.withColumns({"html": F.lit("<h1>old</h1>"), "fetched": F.col("fetched") - 1_000_000_000})]
    return K.union_pages(frames)


def _province() -> Column:
    return F.get(F.array(*map(F.lit, PROVINCES)), F.col("page_id") % len(PROVINCES))


def _search_url(province: Column) -> Column:
    return F.concat(F.lit(f"{SITE.base_url}/jual/"), province, F.lit("/rumah/?page=1"))


def _list_url() -> Column:
    return F.concat(_search_url(_province()), F.lit("&list="), F.col("page_id").cast("string"))


def _searches(spark: SparkSession, folder: str) -> DataFrame:
    """Address of every search page, with its province."""
    return _read(spark, folder, "pages").select(_province().alias("province"), _list_url().alias("url"))


def _extract_store(spark: SparkSession, folder: str, name: str) -> Store:
    """A store whose known titles are those of sixth cards, with all provinces at page 1."""
    store = Store.under(_scratch(spark, name))
    pages = _read(spark, folder, "pages")
    known = P.page_cards(pages.select("html"), SITE).filter(F.col("pos") == 5).select(
        "judul_iklan", F.lit("known").alias("province"), F.lit(0).alias("page"))
    sinks.append_rows(known, store.raw_listings, ["province", "page"])
    G.init_progress(spark, store.progress)
    return store


@_query(_EXTRACTED_WHOLE)
def extract_batch(spark: SparkSession, folder: str) -> DataFrame:
    """The extract job itself over all pages: two fetches of each, known titles stored before, all columns."""
    store = _extract_store(spark, folder, "extract_batch")
    extract_page(spark, store, _fetched_pages(spark, folder, lists=True), SITE, datetime(2024, 5, 1), "fetched", _searches(spark, folder))
    rows = L.read_all(spark, store.raw_listings).filter("province <> 'known'")
    return rows.select(
        "judul_iklan", "harga", "kecamatan", "kabupaten_kota", "terakhir_diperbarui", "agen", *SITE.labels, "link_rumah123",
        "provinsi", "province", "page", "waktu_scraping")


_HEADING = "concat(p_name, ' ', p_brand, ' ', p_type, ' ', CAST(p_size % 5 AS STRING))"
_STORED_TITLE = "concat(upper(p_type), ' - ', p_name, ', ', p_brand, CASE WHEN p_size % 3 = 0 THEN ' (new!)' ELSE '' END)"
_WORDS_SQL = "list_distinct(list_filter(regexp_split_to_array(lower({}), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> ''))"


def _alike_sql(like: float) -> str:
    return f"""
    WITH a AS (SELECT text, {_WORDS_SQL.format('text')} AS s FROM (SELECT DISTINCT {_HEADING} AS text FROM part)),
         b AS (SELECT text, {_WORDS_SQL.format('text')} AS s FROM (SELECT DISTINCT {_STORED_TITLE} AS text FROM part)),
         pairs AS (SELECT a.text, b.text AS other, len(a.s) AS n, len(b.s) AS m, len(list_intersect(a.s, b.s)) AS c FROM a CROSS JOIN b)
    SELECT text, other, CAST(c AS DOUBLE) / (n + m - c) AS similarity FROM pairs WHERE CAST(c AS DOUBLE) / (n + m - c) >= {like}"""


@_query(_alike_sql(SM.LIKE))
def titles_alike(spark: SparkSession, folder: str) -> DataFrame:
    """Headings against stored titles that differ slightly: all pairs of similarity 0.8 or more."""
    parts = _read(spark, folder, "part")
    return SM.alike(parts.select(F.expr(_HEADING).alias("judul_iklan")), parts.select(F.expr(_STORED_TITLE).alias("judul_iklan")))


@_query(f"SELECT p_partkey, {_HEADING} AS judul_iklan FROM part WHERE {_HEADING} NOT IN (SELECT text FROM ({_alike_sql(0.7)}))")
def headings_unlike(spark: SparkSession, folder: str) -> DataFrame:
    """Listings whose heading is like no stored title at 0.7."""
    parts = _read(spark, folder, "part")
    known = parts.select(F.expr(_STORED_TITLE).alias("judul_iklan"))
    return SM.keep_unlike(parts.select("p_partkey", F.expr(_HEADING).alias("judul_iklan")), known, like=0.7)


@_query(_EXTRACTED)
def extract_batch_indexed(spark: SparkSession, folder: str) -> DataFrame:
    """The extract job with a title store: only buckets that may hold a card's title are read."""
    store = _extract_store(spark, folder, "extract_batch_indexed")
    store = replace(store, titles=f"{store.raw_listings}_titles")
    index_titles(spark, store)
    extract_page(spark, store, _fetched_pages(spark, folder), SITE, datetime(2024, 5, 1), "fetched")
    rows = L.read_all(spark, store.raw_listings).filter("province <> 'known'")
    return rows.select(
        "judul_iklan", "harga", "kecamatan", "kabupaten_kota", "terakhir_diperbarui", "agen", *SITE.labels, "link_rumah123",
        "provinsi", "province", "page", "waktu_scraping")


@_query("""
    SELECT DISTINCT c_name AS judul_iklan FROM customer JOIN orders ON o_custkey = c_custkey WHERE c_mktsegment <> 'BUILDING'""")
def titles_in_store(spark: SparkSession, folder: str) -> DataFrame:
    """Known titles among those asked for: names of customers, stored segment by segment and some twice, asked for by orders."""
    root = _scratch(spark, "titles")
    names = _read(spark, folder, "customer").select("c_custkey", "c_name", "c_mktsegment")
    for segments in (["AUTOMOBILE", "MACHINERY"], ["FURNITURE", "MACHINERY"], ["HOUSEHOLD"]):
        TI.add(spark, root, names.filter(F.col("c_mktsegment").isin(segments)), "c_name")
    asked = _read(spark, folder, "orders").join(names, F.col("o_custkey") == F.col("c_custkey")).select("c_name")
    # Read several times, so written, each title once.
    asked = asked.distinct()
    asked.union(asked.select(F.concat("c_name", F.lit("?")))).write.parquet(f"{root}/asked")
    return TI.known_among(spark, root, spark.read.schema("c_name string").parquet(f"{root}/asked"), "c_name")


@_query(f"""
    WITH x AS ({_EXTRACTED_WHOLE})
    SELECT (SELECT count(*) FROM x) AS new_listings,
           (SELECT count(DISTINCT kecamatan) FROM x) AS new_facilities,
           (SELECT count(*) FROM x) AS listings,
           (SELECT count(DISTINCT kecamatan) FROM x) AS facilities, 2 AS current_page""")
def batch_chain(spark: SparkSession, folder: str) -> DataFrame:
    """The whole chain over all pages: what it says it wrote, and the state after it."""
    store = _extract_store(spark, folder, "batch_chain")
    places = _read(spark, folder, "events").select(
        F.col("event_type").alias("kecamatan"), *[F.lit(None).cast("string").alias(t) for t in ("amenity", "shop", "aeroway", "railway", "leisure")],
        F.lit("Indonesia").alias("country"), F.lit(6).alias("admin_level"))
    done = run_batch(
        spark, store, _fetched_pages(spark, folder, lists=True), places, SITE, now=datetime(2024, 5, 1), version="fetched",
        searches=_searches(spark, folder))
    return G.read_progress(spark, store.progress).select(
        *[F.lit(n).cast("long").alias(name) for name, n in (
            ("new_listings", done.new_listings), ("new_facilities", done.new_facilities),
            ("listings", done.clean.listings), ("facilities", done.clean.facilities))], "current_page")


@_query("""
    SELECT n_name AS provinsi, CAST(n_nationkey AS INT) AS ump, CAST(n_nationkey + 0.5 AS DOUBLE) AS populasi_ribu, CAST(n_regionkey AS INT) AS kepadatan_per_km2,
           CAST(n_nationkey * 2 AS INT) AS pdrb_miliar, CAST(n_regionkey / 4.0 AS DOUBLE) AS tingkat_pengangguran,
           CAST(n_nationkey / 2.0 AS DOUBLE) AS tingkat_penyelesaian_pendidikan_sd, CAST(n_nationkey / 4.0 AS DOUBLE) AS tingkat_penyelesaian_pendidikan_smp,
           CAST(n_nationkey / 8.0 AS DOUBLE) AS tingkat_penyelesaian_pendidikan_sma FROM nation""")
def province_dimension(spark: SparkSession, folder: str) -> DataFrame:
    """Nations written as the province file with its nine headers, and read back typed."""
    root = _scratch(spark, "provinces")
    key = F.col("n_nationkey")
    values = ("n_name", key, key + F.lit(0.5), F.col("n_regionkey"), key * 2, F.col("n_regionkey") / 4, key / 2, key / 4, key / 8)
    rows = _read(spark, folder, "nation").select(
        *[F.col(v).alias(h) if isinstance(v, str) else v.alias(h) for h, v in zip(PROVINCE_COLUMNS, values)])
    rows.write.csv(root, header=True)
    return PR.read_provinces(spark, root)
