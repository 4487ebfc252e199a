"""Trailing windows of zones by day."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from placeframe.operators import trailing_window
from placeframe.plans import standin as si
from placeframe.plans.enrichment import assemble_from_zone
from placeframe.functions import date_part_strings
from placeframe.session import fresh_dir
from placeframe.sources import latest_day, read_day_window
from tests.conftest import SF_SMALL

PARTS = ("year", "month", "day")
ROW = StructType([StructField("v", LongType())])


def zone(spark, root, parts=PARTS, days=400):
    first = dt.date(2023, 1, 20)
    rows = [(i, first + dt.timedelta(days=i)) for i in range(days) if i != days - 3]  # one day of the last week is missing
    df = spark.createDataFrame(rows, "v long, d date")
    cols = date_part_strings("d", parts) if len(parts) == 3 else [F.date_format("d", "yyyy-MM-dd").alias(parts[0])]
    df.select("v", *cols).coalesce(1).write.partitionBy(*parts).parquet(root)
    return first + dt.timedelta(days=days - 1)


@pytest.mark.parametrize("parts", [PARTS, ("on_day",)])
def test_only_the_windows_folders_are_opened(spark, scratch, parts):
    last = zone(spark, scratch, parts, 60)
    spark.range(1).selectExpr("id AS v").write.parquet(f"{scratch}/{parts[0]}=__HIVE_DEFAULT_PARTITION__" + ("/month=01/day=01" if len(parts) == 3 else ""))
    spark.range(1).write.parquet(f"{scratch}/other")
    assert latest_day(spark, scratch, parts) == last
    df, end = read_day_window(spark, scratch, ROW, parts)
    assert end == last and sorted(r.v for r in df.collect()) == [52, 53, 54, 55, 56, 58, 59]
    opened = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
    assert len(opened) == 7  # 8 days, of which one has no folder
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert f"{len(opened)} paths" in plan and all(dict(df.dtypes)[p] == "string" for p in parts)


def test_given_end_and_nothing_there(spark, scratch):
    last = zone(spark, scratch, PARTS, 40)
    df, end = read_day_window(spark, scratch, ROW, as_of="2023-02-01", days=2)
    assert end == dt.date(2023, 2, 1) and sorted(r.v for r in df.collect()) == [10, 11, 12]
    df, end = read_day_window(spark, scratch, ROW, as_of=last + dt.timedelta(days=100))
    assert df.collect() == [] and df.columns == ["v", *PARTS]
    df, end = read_day_window(spark, scratch + "/none", ROW)
    assert end is None and df.collect() == []
    with pytest.raises(ValueError, match="zone by day"):
        read_day_window(spark, scratch, ROW, ("year", "day"))


def test_assembly_from_the_zone_equals_the_one_from_the_table(spark, scratch):
    daily = si.repeated_days(si.daily_observations(spark, SF_SMALL))
    daily.select("*", *date_part_strings("obs_date", PARTS)).write.partitionBy(*PARTS).parquet(scratch)
    geo = si.geocoded_locations(spark, SF_SMALL)
    got = assemble_from_zone(spark, scratch, daily.schema, geo)
    assert len({f.split("year=")[1].rsplit("/", 1)[0] for f in got.inputFiles() if "year=" in f}) == 8
    want = si.weather_records(spark, SF_SMALL)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert trailing_window(daily, "obs_date").count() == read_day_window(spark, scratch, daily.schema)[0].count()


def test_assemble_job_reads_the_zone(spark, scratch, capsys):
    from placeframe import jobs
    from placeframe.sinks import land_dated_json

    raw = si.raw_locations(spark, SF_SMALL)
    land_dated_json(raw.withColumns({"year": F.lit("2024"), "month": F.lit("01")}), f"{scratch}/loc")
    daily = si.repeated_days(si.daily_observations(spark, SF_SMALL)).drop("n")
    daily.select("*", *date_part_strings("obs_date", PARTS)).write.partitionBy(*PARTS).parquet(f"{scratch}/daily")
    daily.write.parquet(f"{scratch}/flat")
    for where, more in (("daily", ["--daily-by-day"]), ("flat", [])):
        args = ["assemble", "--raw-locations", f"{scratch}/loc", "--daily", f"{scratch}/{where}", "--raw-weather", f"{scratch}/w-{where}"]
        assert jobs.main(args + more, spark=spark) == 0, capsys.readouterr().out
    read = lambda where: sorted(r.value for r in spark.read.text(f"{scratch}/w-{where}/*/*").collect())
    assert read("daily") == read("flat") != []
    empty = ["assemble", "--raw-locations", f"{scratch}/loc", "--daily", fresh_dir(spark, "no-zone"), "--raw-weather", f"{scratch}/w", "--daily-by-day"]
    assert jobs.main(empty, spark=spark) == 1
