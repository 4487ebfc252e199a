import os

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from placeframe.sinks import files_per_partition, land_dated_json, write_partitioned_parquet
from placeframe.sources import file_manifest, latest_snapshot, page_record_lines, paged_records, read_json_lines, read_latest_partition, read_partitioned
from placeframe.schemas import RAW_LOCATION

REC = StructType([StructField("event_id", LongType()), StructField("event_type", StringType())])


def test_paged_records_stop_at_first_empty(spark):
    pages = spark.createDataFrame(
        [(1, '[{"event_id":1,"event_type":"a"}]'), (2, '[{"event_id":2,"event_type":"b"}]'), (3, "[]"), (4, '[{"event_id":4,"event_type":"d"}]')],
        "page long, body string",
    )
    assert sorted(r.event_id for r in paged_records(pages, REC).collect()) == [1, 2]


def test_a_bad_page_fails_instead_of_ending_the_feed(spark):
    import pytest

    good = (1, '[{"event_id":1,"event_type":"a","more":{"x":[1,2]}}]')
    for body in ('[{"event_id":2,', None, '{"message":"error"}'):
        pages = spark.createDataFrame([good, (2, body), (3, good[1]), (4, "[]")], "page long, body string")
        with pytest.raises(Exception, match="page 2 holds no JSON array"):
            paged_records(pages, REC).collect()
    # after the feed's end nothing is read
    pages = spark.createDataFrame([good, (2, "[]"), (3, None)], "page long, body string")
    assert [(r.page, r.value) for r in page_record_lines(pages).collect()] == [(1, '{"event_id":1,"event_type":"a","more":{"x":[1,2]}}')]


def test_latest_folder_is_found_level_by_level(spark, scratch):
    import pytest

    rows = spark.range(2)
    for part in ("year=2023/month=12", "year=2024/month=02", "year=2024/month=11"):
        rows.write.json(f"{scratch}/{part}")
    rows.write.json(f"{scratch}/year=2025/other")  # no month: passed over
    got = read_latest_partition(spark, scratch, StructType([StructField("id", LongType())]), ("year", "month"))
    assert {(r.year, r.month) for r in got.collect()} == {("2024", "11")}
    with pytest.raises(FileNotFoundError):
        read_latest_partition(spark, scratch + "/none", REC, ("year",))


def test_files_per_partition_keeps_strings(spark, scratch):
    spark.createDataFrame([(1, "01"), (2, "02")], "id long, month string").write.partitionBy("month").parquet(scratch)
    assert sorted(r.month for r in files_per_partition(spark, scratch, "month").collect()) == ["01", "02"]


def test_dated_json_dynamic_overwrite_keeps_other_partitions(spark, scratch):
    df = spark.createDataFrame([(1, "a", "2024", "01"), (2, "b", "2024", "02")], "event_id long, event_type string, year string, month string")
    land_dated_json(df, scratch, ("year", "month"))
    land_dated_json(spark.createDataFrame([(3, "c", "2024", "02")], df.schema), scratch, ("year", "month"))
    back = read_partitioned(spark, scratch, REC, ("year", "month"), fmt="json")
    got = sorted((r.event_id, r.month) for r in back.collect())
    assert got == [(1, "01"), (3, "02")]
    assert dict(back.dtypes)["month"] == "string"
    assert [r.event_id for r in latest_snapshot(back, ("year", "month")).collect()] == [3]
    latest = read_latest_partition(spark, scratch, REC, ("year", "month"))
    assert [(r.event_id, r.month) for r in latest.collect()] == [(3, "02")]
    assert len(latest.inputFiles()) == 1 and "month=02" in latest.inputFiles()[0]
    keys = sorted(r.key.rsplit("/", 1)[0] for r in file_manifest(spark, scratch).collect())
    assert keys == ["year=2024/month=01", "year=2024/month=02"]


def test_partitioned_parquet_one_file_per_value_and_empty_state(spark, scratch):
    df = spark.createDataFrame([(i, ["Ohio", "Iowa", ""][i % 3]) for i in range(30)], "id long, state string")
    write_partitioned_parquet(df, scratch, "state")
    f = {r.state: (r.n_files, r.n_rows) for r in files_per_partition(spark, scratch, "state").collect()}
    assert f == {"Ohio": (1, 10), "Iowa": (1, 10), None: (1, 10)}  # "" reads back as null


def test_json_lines_skip_blank(spark, local_dir):
    p = os.path.join(local_dir, "l.txt")
    with open(p, "w") as fh:
        fh.write('{"id":"1","name":"A"}\n   \n\n\t\t\n \t{"id":"2"}\t\n')
    got = sorted(r.id for r in read_json_lines(spark, p, RAW_LOCATION).collect())
    assert got == ["1", "2"]


def test_assert_published_raises_on_mismatch(spark):
    import pytest

    from placeframe.sinks import assert_published

    kind = "year string, source_rows long, target_rows long, status string"
    ok = spark.createDataFrame([("2024", 3, 3, "uploaded")], kind)
    assert assert_published(ok) is ok
    bad = spark.createDataFrame([("2024", 3, 2, "failed"), ("2025", 1, 0, "failed")], kind)
    with pytest.raises(RuntimeError):
        assert_published(bad)


LINES = ['{"id":"1","postal_code":"x","address_1":null}', "not json at all", '{"id":"2"}\t', "{}"]


def _zone(spark, root, months):
    from placeframe.sinks import land_lines

    for month, lines in months.items():
        land_lines(spark.createDataFrame([(x,) for x in lines], "value string"), root, {"year": "2024", "month": month})
    return root


def test_publish_keeps_every_line_and_older_target_months(spark, scratch):
    from placeframe.sinks import publish_zone

    parts = ("year", "month")
    src = _zone(spark, f"{scratch}/src", {"06": LINES})
    _zone(spark, f"{scratch}/dst", {"05": ["old"], "06": ["stale", "lines"]})
    report = publish_zone(spark, src, f"{scratch}/dst", parts).collect()
    assert [(r.month, r.source_rows, r.target_rows, r.status) for r in report] == [("06", 4, 4, "uploaded")]
    got = spark.read.text(f"{scratch}/dst/year=2024/month=06").collect()
    assert sorted(r.value for r in got) == sorted(LINES)
    assert [r.value for r in spark.read.text(f"{scratch}/dst/year=2024/month=05").collect()] == ["old"]


def test_publish_compares_content_not_only_counts(spark, scratch, monkeypatch):
    from placeframe.sinks import publish_zone, writers

    src = _zone(spark, f"{scratch}/src", {"06": LINES})
    read = writers._zone_lines
    monkeypatch.setattr(writers, "_zone_lines", lambda s, root, p: read(s, root, p).withColumn("value", F.lit("{}")) if root.endswith("dst") else read(s, root, p))
    report = publish_zone(spark, src, f"{scratch}/dst", ("year", "month")).collect()
    assert [(r.source_rows, r.target_rows, r.status) for r in report] == [(4, 4, "failed")]


def test_lookup_report_counts(spark):
    from placeframe.operators import lookup_report

    req = spark.createDataFrame([("1",), ("2",), (None,)], "id string")
    got = spark.createDataFrame([("1",), ("1",), ("9",)], "brewery_id string")
    r = lookup_report(req, got).first()
    assert (r.succeeded, r.failed) == (1, 2)


def test_landing_writes_a_line_per_record_and_replaces_only_its_period(spark, scratch):
    import json

    from placeframe.sinks import land_lines, land_period_json

    rows = spark.createDataFrame([(i, None if i % 2 else f"n{i}") for i in range(7)], "id long, label string")
    june = land_period_json(rows, scratch, {"year": "2024", "month": "06"})
    land_lines(spark.createDataFrame([('{"id":9,"more":[1]}',)], "value string"), scratch, {"year": "2024", "month": "07"})
    land_period_json(rows.limit(3), scratch, {"year": "2024", "month": "06"})
    lines = [r.value for r in spark.read.text(june).collect()]
    assert len(lines) == 3 and all(set(json.loads(x)) <= {"id", "label"} for x in lines)
    assert [r.value for r in spark.read.text(f"{scratch}/year=2024/month=07").collect()] == ['{"id":9,"more":[1]}']


def test_landing_a_period_does_not_shuffle(spark, scratch):
    from placeframe.sinks import land_dated_json

    df = spark.range(10).select("id", F.lit("2024").alias("year"))
    assert "Exchange" not in df.drop("year")._jdf.queryExecution().executedPlan().toString()
    land_dated_json(df, scratch, ("year",))  # unknown parts: dealt by them
    assert read_partitioned(spark, scratch, StructType([StructField("id", LongType())]), ("year",), fmt="json").count() == 10


def test_publish_missing_source_raises(spark, scratch):
    import pytest

    from placeframe.sinks import publish_zone

    with pytest.raises(Exception):
        publish_zone(spark, scratch + "/does-not-exist", scratch + "/target", ("year",)).collect()


def test_max_records_per_file_rolls_over(spark, scratch):
    df = spark.range(100).select(F.lit("Ohio").alias("state"), "id")
    write_partitioned_parquet(df, scratch, "state", max_records_per_file=30)
    f = {r.state: (r.n_files, r.n_rows) for r in files_per_partition(spark, scratch, "state").collect()}
    assert f["Ohio"][1] == 100 and f["Ohio"][0] >= 4


def test_manifest_key_normalises_backslashes(spark):
    from placeframe.functions import object_key

    df = spark.createDataFrame(
        [("file:/root/raw\\weather\\year=2024\\month=01\\a.json",), ("s3a://b/root/raw/locations/year=2024/month=01/a.json",), ("/root/raw/c.json",), ("/x/c.json",)],
        "p string",
    )
    want = ["weather/year=2024/month=01/a.json", "locations/year=2024/month=01/a.json", "c.json", None]
    for root in ("/root/raw", "file:///root/raw/", "\\root\\raw"):
        assert [r[0] for r in df.select(object_key("p", root)).collect()] == want


def test_external_json_table_over_quoted_path(spark, scratch):
    import uuid

    from placeframe.sources import create_external_json_table

    path = scratch + "/it's raw"
    spark.createDataFrame([("1", "A")], "id string, name string").write.json(path)
    name = f"t_{uuid.uuid4().hex[:8]}"
    t = create_external_json_table(spark, "placeframe_test2", name, RAW_LOCATION, path, scratch + "/db's")
    assert [(r.id, r.name, r.state) for r in t.collect()] == [("1", "A", None)]
    # idempotent: a second call reuses the table
    assert create_external_json_table(spark, "placeframe_test2", name, RAW_LOCATION, path).count() == 1
    assert "db's" in spark.sql("DESCRIBE DATABASE placeframe_test2").filter("info_name = 'Location'").first()["info_value"]


def test_manifest_of_empty_zone_is_empty(spark, local_dir):
    from placeframe.sources import file_manifest

    m = file_manifest(spark, local_dir)
    assert m.count() == 0
    assert m.columns == ["file_path", "key", "file_size", "modified"]


def test_materialize_view_and_table(spark, scratch):
    import os
    import uuid

    from placeframe.sinks import materialize

    df = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    tag = uuid.uuid4().hex[:8]
    view = materialize(df, f"v_{tag}", "view")
    assert sorted(r.k for r in spark.sql(f"SELECT k FROM v_{tag}").collect()) == [1, 2]
    assert view.count() == 2
    table = materialize(df, f"t_{tag}", "table", scratch + "/t")
    assert table.count() == 2
    assert any(f.endswith(".parquet") for f in os.listdir(scratch.replace("file:", "") + "/t"))


def test_preview_total_order(spark):
    from placeframe.sinks import preview

    df = spark.createDataFrame([(i, "same", "x") for i in range(30)], "id long, name string, state string")
    first = [r.id for r in preview(df, ["id", "name"], ["name", "state", "id"], 5).collect()]
    assert first == [0, 1, 2, 3, 4]
