"""Column lists, types and fixed value tables of the data model."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "float": T.FloatType(),
    "timestamp": T.TimestampType(),
}


def _struct(columns: str) -> T.StructType:
    """Schema of ``name type`` pairs; needs no running session, unlike a DDL string."""
    pairs = (c.split() for c in columns.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# Names, order and types of the clean listing columns.
LISTING = _struct(
    """
    judul_iklan string, harga bigint, kecamatan string, kabupaten_kota string,
    provinsi string, terakhir_diperbarui string, agen string, link_rumah123 string,
    kamar_tidur int, kamar_mandi int, luas_tanah float, luas_bangunan float,
    carport int, sertifikat string, daya_listrik int, kamar_tidur_pembantu int,
    kamar_mandi_pembantu int, dapur int, ruang_makan string, ruang_tamu string,
    kondisi_perabotan string, material_bangunan string, material_lantai string,
    garasi int, jumlah_lantai int, konsep_dan_gaya_rumah string, pemandangan string,
    terjangkau_internet string, lebar_jalan string, tahun_dibangun int,
    tahun_direnovasi int, sumber_air string, hook string, kondisi_properti string,
    waktu_scraping timestamp
    """
)

# Names, order and types of the clean facility columns.
FACILITY = _struct(
    """
    jumlah_fasilitas_pendidikan int, jumlah_fasilitas_kesehatan int,
    jumlah_fasilitas_perbelanjaan int, jumlah_fasilitas_transportasi int,
    jumlah_fasilitas_rekreasi int, kecamatan string, timestamp timestamp, status string
    """
)

# The province dimension. Source names hold characters that
# Parquet and SQL identifiers dislike, so each has a plain name here.
PROVINCE_COLUMNS = {
    "Provinsi": ("provinsi", "string"),
    "UMP": ("ump", "int"),
    "populasi (ribu)": ("populasi_ribu", "double"),
    "kepadatan(/km^2)": ("kepadatan_per_km2", "int"),
    "PDRB (miliar)": ("pdrb_miliar", "int"),
    "tingkat_pengangguran": ("tingkat_pengangguran", "double"),
    "tingkat_penyelesaian_pendidikan_SD": ("tingkat_penyelesaian_pendidikan_sd", "double"),
    "tingkat_penyelesaian_pendidikan_SMP": ("tingkat_penyelesaian_pendidikan_smp", "double"),
    "tingkat_penyelesaian_pendidikan_SMA": ("tingkat_penyelesaian_pendidikan_sma", "double"),
}

PROGRESS = T.StructType([
    T.StructField("current_page", T.IntegerType()),
    T.StructField("provinces", T.MapType(T.StringType(), T.IntegerType())),
])

# The province slugs a fresh progress state starts with.
PROVINCES = (
    "dki-jakarta", "jawa-barat", "banten", "jawa-timur", "jawa-tengah", "bali",
    "daerah-istimewa-yogyakarta", "sumatera-utara", "kepulauan-riau", "sulawesi-selatan",
    "kalimantan-timur", "riau", "lampung", "sumatera-selatan", "kalimantan-barat", "sulawesi-utara",
    "nusa-tenggara-barat", "nusa-tenggara-timur", "sumatera-barat", "kalimantan-selatan", "jambi",
    "kepulauan-bangka-belitung", "kalimantan-tengah", "papua", "aceh", "bengkulu", "papua-barat",
    "sulawesi-tengah", "sulawesi-tenggara", "gorontalo", "kalimantan-utara", "maluku-utara",
    "sulawesi-barat", "maluku",
)

# Tag filters of each facility category, unanchored patterns.
FACILITY_FILTERS = (
    ("jumlah_fasilitas_pendidikan", "amenity", "school|university|college|kindergarten"),
    ("jumlah_fasilitas_kesehatan", "amenity", "hospital|clinic|doctors|dentist|pharmacy"),
    ("jumlah_fasilitas_perbelanjaan", "shop", "supermarket|mall|department_store|convenience"),
    ("jumlah_fasilitas_perbelanjaan", "amenity", "marketplace|shopping_mall"),
    ("jumlah_fasilitas_transportasi", "amenity", "bus_station|taxi|ferry_terminal"),
    ("jumlah_fasilitas_transportasi", "aeroway", "aerodrome|terminal"),
    ("jumlah_fasilitas_transportasi", "railway", "station|halt"),
    ("jumlah_fasilitas_rekreasi", "leisure", "park|sports_centre|fitness_centre|swimming_pool"),
    ("jumlah_fasilitas_rekreasi", "amenity", "park|theatre|cinema"),
)

#: Everything but the load time must be present in a raw listing file.
LISTING_REQUIRED = [f.name for f in LISTING if f.name != "waktu_scraping"]
FACILITY_COUNTS = [f.name for f in FACILITY if f.name.startswith("jumlah_fasilitas_")]
FACILITY_REQUIRED = ["kecamatan", *FACILITY_COUNTS]


def as_text(schema: T.StructType) -> T.StructType:
    """The raw form of ``schema``: same columns, every one a string."""
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema])


RAW_LISTING = as_text(LISTING)
RAW_FACILITY = as_text(FACILITY)
