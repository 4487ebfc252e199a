"""Fixed file layouts and their record."""

import glob
import math
import os

import pytest
from pyspark.sql import functions as F

from placeframe.sinks import files_per_partition, layout_record, layout_report, write_fixed_layout


def files_of(path, pattern="part-*"):
    """Files by folder, by a listing of its own."""
    out = {}
    for f in glob.glob(f"{path.removeprefix('file:')}/**/{pattern}", recursive=True):
        folder = os.path.relpath(os.path.dirname(f), path.removeprefix("file:"))
        if not folder.startswith("_"):
            out.setdefault(folder, []).append(os.path.getsize(f))
    return out


@pytest.mark.parametrize("rows_per_file", [1, 7, 30, 1000, None])
def test_files_follow_from_rows(spark, scratch, rows_per_file):
    # one value has two thirds of the rows, which come in many tasks
    df = spark.range(300).repartition(7).select("id", F.when(F.col("id") % 3 > 0, "Ohio").when(F.col("id") % 2 == 0, "a/b c+d%").otherwise("").alias("state"))
    record = write_fixed_layout(df, scratch, "state", rows_per_file)
    want = {s: (n, math.ceil(n / (rows_per_file or n))) for s, n in (("Ohio", 200), ("a/b c+d%", 50), (None, 50))}
    assert {r.state: (r.n_rows, r.n_files) for r in record.collect()} == want
    assert {r.state: (r.n_rows, r.n_files) for r in files_per_partition(spark, scratch, "state").collect()} == want
    assert sorted(map(len, files_of(scratch).values())) == sorted(n for _, n in want.values())
    assert {r.state: r.status for r in layout_report(spark, scratch, "state").collect()} == dict.fromkeys(want, "intact")
    back = spark.read.schema("id long, state string").parquet(scratch)
    assert sorted(r.id for r in back.collect()) == list(range(300))


def test_a_hot_value_is_written_by_many_tasks(spark, scratch):
    df = spark.range(4000).repartition(5).select("id", F.lit("Ohio").alias("state"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else so few rows go to one task
    try:
        write_fixed_layout(df, scratch, "state", rows_per_file=100)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    tasks = {os.path.basename(f).split("-")[1] for f in glob.glob(f"{scratch.removeprefix('file:')}/state=Ohio/part-*")}
    assert len(tasks) > 1  # each took some of the files


def test_text_has_bytes_and_periods_are_replaced(spark, scratch):
    parts = ["year", "month"]
    lines = [("é" * i, "2024", f"{1 + i % 2:02d}") for i in range(20)] + [(None, "2024", "01"), ("a\tb", "2023", "12")]
    df = spark.createDataFrame(lines, "value string, year string, month string")
    write_fixed_layout(df, scratch, parts, 4, "text", replace_values_only=True)
    again = spark.createDataFrame([("new", "2024", "02")], df.schema)
    record = write_fixed_layout(again, scratch, parts, 4, "text", replace_values_only=True)
    size = lambda month: sum(len((v or "").encode()) + 1 for v, y, m in lines if (y, m) == ("2024", month))
    assert {(r.year, r.month): (r.n_rows, r.n_files, r.n_bytes) for r in record.collect()} == {
        ("2024", "01"): (11, 3, size("01")), ("2024", "02"): (1, 1, 4), ("2023", "12"): (1, 1, 4)
    }
    listed = files_of(scratch)
    assert {k: (len(v), sum(v)) for k, v in listed.items()} == {"year=2024/month=01": (3, size("01")), "year=2024/month=02": (1, 4), "year=2023/month=12": (1, 4)}
    assert {r.status for r in layout_report(spark, scratch, parts).collect()} == {"intact"}


def test_report_finds_what_was_changed(spark, scratch):
    df = spark.createDataFrame([(f"line {i}", str(i % 4)) for i in range(40)], "value string, k string")
    write_fixed_layout(df, scratch, "k", 5, "text")
    at = scratch.removeprefix("file:")
    one = sorted(glob.glob(f"{at}/k=0/part-*"))
    with open(one[0], "ab") as f:
        f.write(b"more\n")
    os.rename(one[1], f"{at}/k=1/part-moved.txt")
    for f in glob.glob(f"{at}/k=2/part-*"):
        os.remove(f)
    os.makedirs(f"{at}/k=9")
    with open(f"{at}/k=9/part-foreign.txt", "wb") as f:
        f.write(b"x\n")
    assert {r.k: r.status for r in layout_report(spark, scratch, "k").collect()} == {"0": "differs", "1": "differs", "2": "lost", "3": "intact", "9": "unrecorded"}


def test_empty_table_and_no_record(spark, scratch):
    df = spark.createDataFrame([], "id long, state string")
    assert write_fixed_layout(df, scratch, "state", 10).collect() == []
    assert layout_report(spark, scratch, "state").collect() == []
    assert layout_record(spark, scratch + "/none", "state").collect() == []
    with pytest.raises(ValueError, match="rows_per_file"):
        write_fixed_layout(df, scratch, "state", 0)
