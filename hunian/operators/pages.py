"""Cards of search pages and the detail record of listing pages."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import html as H
from ..functions import scalars
from ..schemas import LISTING


# The label of each labelled column on a listing page.
LABELS = {
    "kamar_tidur": "Kamar Tidur",
    "kamar_mandi": "Kamar Mandi",
    "luas_tanah": "Luas Tanah",
    "luas_bangunan": "Luas Bangunan",
    "carport": "Carport",
    "sertifikat": "Sertifikat",
    "daya_listrik": "Daya Listrik",
    "kamar_tidur_pembantu": "Kamar Tidur Pembantu",
    "kamar_mandi_pembantu": "Kamar Mandi Pembantu",
    "dapur": "Dapur",
    "ruang_makan": "Ruang Makan",
    "ruang_tamu": "Ruang Tamu",
    "kondisi_perabotan": "Kondisi Perabotan",
    "material_bangunan": "Material Bangunan",
    "material_lantai": "Material Lantai",
    "garasi": "Garasi",
    "jumlah_lantai": "Jumlah Lantai",
    "konsep_dan_gaya_rumah": "Konsep dan Gaya Rumah",
    "pemandangan": "Pemandangan",
    "terjangkau_internet": "Terjangkau Internet",
    "lebar_jalan": "Lebar Jalan",
    "tahun_dibangun": "Tahun Dibangun",
    "tahun_direnovasi": "Tahun Direnovasi",
    "sumber_air": "Sumber Air",
    "hook": "Hook",
    "kondisi_properti": "Kondisi Properti",
}


@dataclass(frozen=True)
class Site:
    """Where a site keeps its fields. The default selectors."""

    base_url: str
    search_path: str = "/jual/{province}/rumah/?page={page}"
    card: H.Selector = H.Selector("div", ("ui-organism-intersection__element",))
    card_link: H.Selector = H.Selector("a", href_prefix="/properti/")
    card_heading: str | None = "h2"
    title: H.Selector = H.Selector("h1")
    price: H.Selector = H.Selector("span", ("text-primary", "font-bold"))
    location: H.Selector = H.Selector("p", ("text-xs", "text-gray-500", "mb-2"))
    update: H.Selector = H.Selector("p", ("text-3xs", "text-gray-400", "mb-4"))
    label_tag: str = "p"
    labels: dict[str, str] = field(default_factory=lambda: dict(LABELS))
    exact_labels: bool = False

    def search_url(self, province: str, page: int) -> str:
        return self.base_url + self.search_path.format(province=province, page=page)


def page_cards(pages: DataFrame, site: Site) -> DataFrame:
    """One row per usable card: the other page columns, ``pos``, title and link.

    A page without cards gives no rows; a card without link, heading or title is
    dropped.
    """
    others = [c for c in pages.columns if c != "html"]
    link = site.card_link
    body = H.inside(link.tag, site.card_heading) if site.card_heading else ""
    heading = rf"<(?i:{site.card_heading})(?=[\s>/]){H.ATTRIBUTES}" if site.card_heading else ""
    stop = site.card_heading or link.tag
    title = rf"{link.opening}{body}{heading}({H.inside(stop)})</(?i:{stop})\s*>"

    def fields(card: Column) -> Column:
        first_link = F.regexp_substr(card, F.lit(link.opening))
        return F.struct(
            H.let(F.regexp_extract(card, title, 1), H.element_text).alias("judul_iklan"),
            scalars.absolute_link(site.base_url, H.let(first_link, lambda a: H.attribute(a, "href"))).alias("link"))

    # The fields are cut out before the explode: a filter on them stays above it
    # and reads them, while below it Spark would work them out a second time.
    pieces = H.pieces(H.visible_markup(F.col("html")), site.card)
    cards = F.transform(pieces, lambda p: H.let(H.element(p, site.card), fields))
    return pages.select(*others, F.posexplode(cards).alias("pos", "_card")).select(
        *others, "pos", "_card.judul_iklan", "_card.link",
    ).filter((F.col("judul_iklan") != "") & F.col("link").isNotNull())


def detail_records(
    pages: DataFrame, site: Site, now: datetime | None, digits_price: bool = False, keep: tuple[str, ...] = ()
) -> DataFrame:
    """The 35 raw listing columns of each page (``url``, ``html``, optional ``province``).

    Page columns named in ``keep`` follow them.
    Pages whose fetch failed carry no html and give no row. The price stays text
    for the cleaning step unless ``digits_price``.
    """
    province = F.col("province") if "province" in pages.columns else F.lit(None).cast("string")
    # ``let`` and the narrow steps keep each scan of the markup to one run: a
    # lambda or a merged projection would repeat it for every field.
    m = F.col("_markup")
    steps = pages.filter(F.col("html").isNotNull()).select(
        "url", province.alias("province"), *keep, H.visible_markup(F.col("html")).alias("_markup"))
    heads = H.elements(m, [site.title, site.price, site.location, site.update])
    labels = list(site.labels.values())
    labelled = H.let(
        H.labelled_pairs(m, labels, site.label_tag),
        lambda pairs: F.transform(
            F.array(*map(F.lit, labels)), lambda label: H.labelled_markup(pairs, label, site.exact_labels)))
    steps = steps.select(
        "url", "province", *keep, F.transform(F.concat(heads, labelled), H.element_text).alias("_text"))
    named = ["title", "price", "location", "update", *site.labels]
    scanned = steps.select(
        "url", "province", *keep, *[F.get("_text", F.lit(i)).alias(n) for i, n in enumerate(named)])
    location, update = (F.nullif(F.col(c), F.lit("")) for c in ("location", "update"))
    fields = {
        "judul_iklan": F.col("title"),
        "harga": scalars.digits_only(F.col("price")).cast("string") if digits_price else F.col("price"),
        "kecamatan": scalars.first_part(location),
        "kabupaten_kota": scalars.last_part(location),
        "provinsi": F.col("province"),
        "terakhir_diperbarui": scalars.update_date(update),
        "agen": scalars.update_agent(update),
        "link_rumah123": F.col("url"),
        **{c: F.col(c) for c in site.labels},
        "waktu_scraping": scalars.iso_text(scalars.load_time(now)),
    }
    # A column without a label on this site is null.
    missing = F.lit(None).cast("string")
    return scanned.select(*[fields.get(c, missing).alias(c) for c in LISTING.names], *keep)
