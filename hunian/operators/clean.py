"""Typed projections of raw listings and facilities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions import scalars


def require_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """Return ``df``; raise ``ValueError`` naming the first missing column."""
    for name in names:
        if name not in df.columns:
            raise ValueError(f"no column {name!r} in the input, which has {', '.join(df.columns)}")
    return df


def clean_listings(raw: DataFrame, allow_whole: bool = False) -> DataFrame:
    """Price and casts in one projection; other columns keep value and position."""
    require_columns(raw, schemas.LISTING_REQUIRED)
    casts = _casts(raw, schemas.LISTING)
    casts["harga"] = scalars.price(F.col("harga").cast("string"), allow_whole)
    return raw.withColumns(casts)


def clean_facilities(raw: DataFrame) -> DataFrame:
    require_columns(raw, schemas.FACILITY_REQUIRED)
    return raw.withColumns(_casts(raw, schemas.FACILITY))


def _casts(raw: DataFrame, schema) -> dict:
    """Casts for the columns whose raw type is not yet the clean one."""
    types = {f.name: f.dataType for f in raw.schema}
    return {
        f.name: scalars.typed(F.col(f.name).cast("string"), f.dataType)
        for f in schema
        if f.name in types and types[f.name] != f.dataType
    }
