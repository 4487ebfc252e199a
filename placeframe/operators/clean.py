"""Cleaning operators for location and weather records (narrow, no shuffle)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placeframe.constants import COUNTRY_KEPT, DAILY_FIELDS, MEAN_COLUMNS
from placeframe.functions.columns import array_mean, is_truthy_number, normalize_text, safe_cast


def filter_country(df: DataFrame, col: str = "country", value: str = COUNTRY_KEPT) -> DataFrame:
    """Keep rows of one country, and rows whose country is missing."""
    c = F.col(col)
    return df.filter((c == value) | c.isNull())


def filter_required(df: DataFrame, *cols: str) -> DataFrame:
    """Drop rows where any of ``cols`` is null (empty strings pass)."""
    cond: Column | None = None
    for name in cols:
        c = F.col(name).isNotNull()
        cond = c if cond is None else cond & c
    return df if cond is None else df.filter(cond)


def flag_both_present(a: str, b: str) -> Column:
    """True when both (already cast) columns are non-null; 0.0 counts as present."""
    return F.col(a).isNotNull() & F.col(b).isNotNull()


def filter_geocoded(df: DataFrame, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """Keep records whose raw coordinates are both truthy (not null, not '', not the number 0)."""
    return df.filter(is_truthy_number(lat) & is_truthy_number(lon))


def _wanted(country: str, required: tuple[str, ...]) -> Column:
    kept = (F.col(country) == COUNTRY_KEPT) | F.col(country).isNull()
    for name in required:
        kept = kept & F.col(name).isNotNull()
    return kept


def kept_by_cleaning(country: str = "country", required: tuple[str, ...] = ("name", "state")) -> Column:
    """Whether ``clean_locations`` keeps a raw record."""
    return F.coalesce(_wanted(country, required), F.lit(False))


def clean_locations(raw: DataFrame) -> DataFrame:
    """Raw location records -> clean location table: the rows of
    ``kept_by_cleaning`` (a filter that the scan can take), the id under the name of
    the weather table's key, coordinates as floats (null if malformed) with a flag,
    the category normalised; country and phone are dropped.
    """
    lat, lon = safe_cast("latitude", "float"), safe_cast("longitude", "float")
    made = {
        "id": F.col("id").alias("brewery_id"),
        "latitude": lat.alias("latitude"),
        "longitude": lon.alias("longitude"),
        "brewery_type": normalize_text("brewery_type").alias("brewery_type"),
    }
    columns = [made.get(c, F.col(c)) for c in raw.columns if c not in ("country", "phone")]
    flag = (lat.isNotNull() & lon.isNotNull()).alias("has_coordinates")
    return raw.filter(_wanted("country", ("name", "state"))).select(*columns, flag)


def flatten_weather(raw_weather: DataFrame) -> DataFrame:
    """Nested weather records -> one row per record with four window means.

    Output: brewery_id, fetch_date, avg_temp_max_f, avg_temp_min_f,
    avg_precipitation_inch, avg_windspeed_mph (float). Records without a
    brewery_id are dropped.
    """
    means = [
        array_mean(F.col("weather").getField(src)).cast("float").alias(dst)
        for src, dst in zip(DAILY_FIELDS, MEAN_COLUMNS)
    ]
    return raw_weather.select("brewery_id", "fetch_date", *means).filter(
        F.col("brewery_id").isNotNull()
    )
