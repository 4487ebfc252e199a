"""Explicit schemas: no inference scan, stable types, only the fields used."""

from pyspark.sql.types import (
    ArrayType,
    DateType,
    DoubleType,
    StringType,
    StructField,
    StructType,
)

from placeframe.constants import DAILY_FIELDS


def _strings(*names: str) -> list[StructField]:
    return [StructField(n, StringType(), True) for n in names]


# Raw location record: ten nullable strings; coordinates arrive as strings.
RAW_LOCATION = StructType(
    _strings(
        "id",
        "name",
        "brewery_type",
        "city",
        "state",
        "country",
        "latitude",
        "longitude",
        "website_url",
        "phone",
    )
)

# The nested daily block: one array per requested field, aligned by day.
DAILY_BLOCK = StructType(
    [StructField(f, ArrayType(DoubleType(), True), True) for f in DAILY_FIELDS]
)

# Raw weather record (one per looked-up location).
RAW_WEATHER = StructType(
    _strings(
        "brewery_id",
        "brewery_name",
        "state",
        "city",
        "latitude",
        "longitude",
        "fetch_date",
    )
    + [StructField("weather", DAILY_BLOCK, True)]
)

# Hive-style partition columns are strings so that "01" stays "01".
DATED_PARTS = ("year", "month", "day")


def with_string_parts(schema: StructType, parts=DATED_PARTS) -> StructType:
    """Append string partition columns to a data schema (for basePath reads)."""
    return StructType(list(schema.fields) + _strings(*parts))


# Source tables the stand-in inputs are derived from (declared so a scan
# needs no footer-inference job before planning).
SOURCE_TABLES = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
}

# one row per location and day, as the trailing window takes them
DAILY_OBSERVATION = StructType(
    [StructField("loc_id", StringType(), True), StructField("obs_date", DateType(), True)]
    + [StructField(c, DoubleType(), True) for c in ("tmax", "tmin", "precip", "wind")]
)
