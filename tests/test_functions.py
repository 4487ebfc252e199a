import math

from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from placeframe.constants import CATEGORY_DEFAULT, CATEGORY_RULES, CLIMATE_BANDS, CLIMATE_BELOW, CLIMATE_MISSING
from placeframe.functions import (
    array_mean,
    bucket_by_membership,
    count_nulls_in,
    is_truthy_text,
    normalize_text,
    prefix_code,
    safe_cast,
    threshold_ladder,
)


def test_safe_cast_coordinates(spark):
    rows = [("n/a",), ("",), (None,), (" 35.5 ",), ("0",)]
    df = spark.createDataFrame(rows, "lat string")
    got = [r[0] for r in df.select(safe_cast("lat", "float")).collect()]
    assert got[:3] == [None, None, None]
    assert got[3] == 35.5 and got[4] == 0.0


def test_truthy_text_matches_geocode_rule(spark):
    rows = [("n/a",), ("",), (None,), (" 35.5 ",), ("0",)]
    df = spark.createDataFrame(rows, "lat string")
    assert [r[0] for r in df.select(is_truthy_text("lat")).collect()] == [True, False, False, True, True]


def test_array_mean_null_and_empty(spark):
    schema = StructType([StructField("a", ArrayType(DoubleType(), True), True)])
    df = spark.createDataFrame([([1.0, 2.0],), ([],), (None,), ([1.0, None],)], schema)
    got = [r[0] for r in df.select(array_mean("a")).collect()]
    assert got == [1.5, None, None, None]


def test_count_nulls_in(spark):
    schema = StructType([StructField("a", ArrayType(DoubleType(), True), True)])
    df = spark.createDataFrame([([1.0, None, None],), ([],)], schema)
    assert [r[0] for r in df.select(count_nulls_in("a")).collect()] == [2, 0]


def test_threshold_ladder_edges(spark):
    vals = [80.0, 79.99, 60.0, 40.0, 39.9, None, float("nan")]
    df = spark.createDataFrame([(v,) for v in vals], "t double")
    zone = threshold_ladder("t", CLIMATE_BANDS, CLIMATE_BELOW, CLIMATE_MISSING)
    got = [r[0] for r in df.select(zone).collect()]
    assert got == ["hot", "moderate", "moderate", "cool", "cold", "unknown", "hot"]


def test_prefix_code(spark):
    df = spark.createDataFrame([("New Mexico",), ("",), (None,)], "s string")
    assert [r[0] for r in df.select(prefix_code("s", 2)).collect()] == ["NE", "", None]


def test_normalize_text_spaces_only(spark):
    df = spark.createDataFrame([("  MICRO ",), (None,), ("\tNano",)], "t string")
    assert [r[0] for r in df.select(normalize_text("t")).collect()] == ["micro", None, "\tnano"]


def test_category_buckets(spark):
    types = ["micro", "nano", "brewpub", "regional", "large", "taproom", "contract", None]
    df = spark.createDataFrame([(t,) for t in types], "t string")
    got = [r[0] for r in df.select(bucket_by_membership("t", CATEGORY_RULES, CATEGORY_DEFAULT)).collect()]
    assert got == ["craft"] * 3 + ["commercial"] * 2 + ["taproom", "other", "other"]


def test_nan_is_not_null(spark):
    df = spark.createDataFrame([(float("nan"),)], "t double")
    v = df.select(F.col("t")).first()[0]
    assert math.isnan(v)


def test_date_part_strings_zero_padded(spark):
    import datetime as dt

    from placeframe.functions import date_part_strings

    df = spark.createDataFrame([(dt.date(2024, 3, 5),)], "d date")
    assert tuple(df.select(*date_part_strings("d")).first()) == ("2024", "03", "05")
