"""Versions: readers see one run's tables, whole."""

import os

import pytest
from pyspark.sql import functions as F

from placeframe.sinks import current_version, publish_version, read_version


def tables(spark, n):
    return {"dim": spark.range(n).withColumn("run", F.lit(n)), "fact": spark.range(2 * n).withColumn("run", F.lit(n))}


def test_a_reader_sees_the_old_or_the_new_run(spark, scratch):
    assert current_version(spark, scratch) is None
    with pytest.raises(FileNotFoundError):
        read_version(spark, scratch, "dim")
    first = publish_version(tables(spark, 3), scratch)
    old = read_version(spark, scratch, "fact")  # opened before the second run, read after it
    second = publish_version(tables(spark, 5), scratch)
    assert first < second == current_version(spark, scratch)
    assert (old.count(), read_version(spark, scratch, "fact").count(), read_version(spark, scratch, "dim", first).count()) == (6, 10, 3)


def test_a_failed_run_changes_nothing(spark, scratch):
    first = publish_version(tables(spark, 3), scratch)
    bad = tables(spark, 4) | {"fact": spark.range(4).select(F.raise_error(F.lit("no")).alias("x"))}
    with pytest.raises(Exception, match="no"):
        publish_version(bad, scratch)  # dim was written by then
    assert current_version(spark, scratch) == first
    assert {r.run for r in read_version(spark, scratch, "dim").collect()} == {3}


def test_old_versions_go_and_the_pointer_is_one_file(spark, scratch):
    made = [publish_version(tables(spark, n), scratch, keep=2) for n in (1, 2, 3)]
    names = sorted(x for x in os.listdir(scratch.removeprefix("file:")) if not x.startswith("."))
    assert names == ["current", *made[1:]]
    with pytest.raises(ValueError, match="kept"):
        publish_version(tables(spark, 1), scratch, keep=0)


def test_catalog_tables_are_repointed(spark, scratch):
    spark.sql("CREATE DATABASE IF NOT EXISTS placeframe_versions")
    for n in (2, 7):
        publish_version(tables(spark, n), scratch, database="placeframe_versions")
        assert spark.table("placeframe_versions.dim").count() == n
        assert spark.table("placeframe_versions.fact").count() == 2 * n
    spark.sql("DROP DATABASE placeframe_versions CASCADE")


def test_transform_job_publishes_a_version(spark, scratch, capsys):
    from placeframe import jobs
    from placeframe.sinks import land_lines

    land_lines(spark.createDataFrame([('{"id":"1","name":"A","state":"Ohio","brewery_type":"micro"}',)], "value string"), f"{scratch}/l", {"year": "2024", "month": "01"})
    land_lines(spark.createDataFrame([('{"brewery_id":"1","fetch_date":"2024-01-31","weather":{}}',)], "value string"), f"{scratch}/w", {"year": "2024", "month": "01"})
    args = ["transform", "--raw-locations", f"{scratch}/l", "--raw-weather", f"{scratch}/w", "--output", f"{scratch}/o", "--marts", f"{scratch}/m", "--versioned"]
    assert jobs.main(args, spark=spark) == 0, capsys.readouterr().out
    assert '"raw_locations": {"n": 1}' in capsys.readouterr().out
    assert read_version(spark, f"{scratch}/m", "dim_locations").count() == 1
