"""End-to-end: land raw NDJSON, run the job, build and publish marts."""

import pytest
from pyspark.sql.types import StructType

from placeframe.operators import run_suite
from placeframe.plans import standin as si
from placeframe.plans.enrichment import build_marts, enriched, publish_marts, read_enriched, run_enrichment
from placeframe.session import fresh_dir
from placeframe.sinks import land_dated_json
from placeframe.sources import read_locations, read_partitioned, read_weather
from tests.conftest import SF_SMALL


def test_run_enrichment_observes_counts_in_one_pass(spark):
    raw = si.raw_locations(spark, SF_SMALL)
    wx = si.weather_records(spark, SF_SMALL, raw)
    year, month = si.run_month(spark, SF_SMALL)
    loc_root, wx_root, out = (fresh_dir(spark, t) for t in ("t-loc", "t-wx", "t-out"))
    land_dated_json(raw.withColumns({"year": year, "month": month}), loc_root, ("year", "month"))
    land_dated_json(wx.withColumns({"year": year, "month": month}), wx_root, ("year", "month"))
    counts = run_enrichment(
        read_locations(spark, f"{loc_root}/year=*/month=*/*.json"),
        read_weather(spark, f"{wx_root}/year=*/month=*/*.json"),
        out,
    )
    expected = enriched(raw, wx)
    assert counts["raw_locations"]["n"] == raw.count()
    assert counts["raw_weather"]["n"] == wx.count()
    assert counts["joined"]["n"] == expected.count()
    assert counts["joined"]["with_weather"] == expected.filter("avg_temp_max_f is not null").count()
    schema = StructType([f for f in expected.schema.fields if f.name != "state"])
    back = read_partitioned(spark, out, schema, ["state"])
    assert back.count() == expected.count()
    assert back.exceptAll(expected.select(*back.columns)).isEmpty()


def test_publish_marts_and_suite(spark):
    raw = si.raw_locations(spark, SF_SMALL)
    m = build_marts(enriched(raw, si.weather_records(spark, SF_SMALL, raw)), stage_dir=fresh_dir(spark, "t-stage"))
    tables = publish_marts(m, fresh_dir(spark, "t-marts"))
    assert tables["dim_locations"].count() == m.stg.count()
    assert tables["fact_location_weather"].count() >= tables["dim_locations"].count()
    rep = {(r.model, r.column_name, r.test): r.status for r in run_suite(
        {"stg": m.stg, "dim": tables["dim_locations"]},
        unique=[("stg", "brewery_id"), ("dim", "brewery_id")],
        not_null=[("stg", "brewery_id"), ("dim", "brewery_category")],
        accepted=[("dim", "brewery_category", ("craft", "commercial", "taproom", "other"))],
    ).collect()}
    assert set(rep.values()) == {"pass"}


def test_job_end_to_end(spark, capsys):
    from placeframe import jobs

    raw = si.raw_locations(spark, SF_SMALL)
    wx = si.weather_records(spark, SF_SMALL, raw)
    year, month = si.run_month(spark, SF_SMALL)
    loc_root, wx_root, out, marts = (fresh_dir(spark, t) for t in ("j-loc", "j-wx", "j-out", "j-marts"))
    land_dated_json(raw.withColumns({"year": year, "month": month}), loc_root, ("year", "month"))
    land_dated_json(wx.withColumns({"year": year, "month": month}), wx_root, ("year", "month"))
    argv = ["--raw-locations", loc_root, "--raw-weather", wx_root, "--output", out, "--marts", marts, "--snapshots", "latest"]
    rc = jobs.main(argv, spark=spark)
    printed = capsys.readouterr().out
    assert '"tests": 12' in printed
    # the stand-in has repeated ids in the fact only; every declared test passes
    assert rc == 0, printed
    assert spark.read.parquet(f"{marts}/dim_locations").count() > 0


def test_models_as_sql_views(spark):
    from placeframe.plans.enrichment import register_models

    raw = si.raw_locations(spark, SF_SMALL)
    m = build_marts(enriched(raw, si.weather_records(spark, SF_SMALL, raw)), stage_dir=fresh_dir(spark, "t-views"))
    views = register_models(m, prefix="t_")
    top = spark.sql(
        f"SELECT state, COUNT(*) AS brewery_count FROM {views['dim_locations']} "
        "GROUP BY state ORDER BY brewery_count DESC, state LIMIT 10"
    ).collect()
    assert 0 < len(top) <= 10
    joined = spark.sql(
        f"SELECT count(*) AS n FROM {views['fact_location_weather']} f "
        f"JOIN {views['state_weather_summary']} s ON f.state = s.state"
    ).first().n
    assert joined > 0


def test_run_enrichment_without_raw_counts_pushes_filters(spark):
    import io
    from contextlib import redirect_stdout

    from placeframe.operators import clean_locations

    raw = si.raw_locations(spark, SF_SMALL)
    wx = si.weather_records(spark, SF_SMALL, raw)
    loc_root, wx_root, out = (fresh_dir(spark, t) for t in ("n-loc", "n-wx", "n-out"))
    raw.write.json(loc_root)
    wx.write.json(wx_root)
    counts = run_enrichment(read_locations(spark, loc_root), read_weather(spark, wx_root), out, count_raw=False)
    assert "raw_locations" not in counts and counts["joined"]["n"] == enriched(raw, wx).count()
    buf = io.StringIO()
    with redirect_stdout(buf):
        clean_locations(read_locations(spark, loc_root)).explain("formatted")
    assert "PushedFilters: [" in buf.getvalue() and "IsNotNull(name)" in buf.getvalue()


def test_assemble_then_transform_jobs(spark, capsys):
    from placeframe import jobs

    raw = si.raw_locations(spark, SF_SMALL)
    daily = si.daily_observations(spark, SF_SMALL)
    year, month = si.run_month(spark, SF_SMALL)
    loc_root, daily_dir, wx_root, out, marts = (fresh_dir(spark, t) for t in ("a-loc", "a-daily", "a-wx", "a-out", "a-marts"))
    land_dated_json(raw.withColumns({"year": year, "month": month}), loc_root, ("year", "month"))
    daily.write.parquet(daily_dir)
    rc = jobs.main(["assemble", "--raw-locations", loc_root, "--daily", daily_dir, "--raw-weather", wx_root], spark=spark)
    printed = capsys.readouterr().out
    assert rc == 0, printed
    expected = si.weather_records(spark, SF_SMALL, raw)
    assert f'"succeeded": {expected.count()}' in printed
    landed = read_weather(spark, f"{wx_root}/year=*/month=*/*.json")
    assert landed.count() == expected.count()
    rc = jobs.main(["transform", "--raw-locations", loc_root, "--raw-weather", wx_root, "--output", out, "--marts", marts], spark=spark)
    assert rc == 0
    assert spark.read.parquet(out).count() == enriched(raw, expected).count()


def test_publish_job(spark, capsys):
    from placeframe import jobs

    raw = si.raw_locations(spark, SF_SMALL)
    wx = si.weather_records(spark, SF_SMALL, raw)
    year, month = si.run_month(spark, SF_SMALL)
    loc_root, wx_root, target = (fresh_dir(spark, t) for t in ("p-loc", "p-wx", "p-target"))
    land_dated_json(raw.withColumns({"year": year, "month": month}), loc_root, ("year", "month"))
    land_dated_json(wx.withColumns({"year": year, "month": month}), wx_root, ("year", "month"))
    rc = jobs.main(["publish", "--raw-locations", loc_root, "--raw-weather", wx_root, "--target", target], spark=spark)
    printed = capsys.readouterr().out
    assert rc == 0, printed
    assert f'"zone": "locations", "uploaded": 1, "failed": 0, "rows": {raw.count()}' in printed
    assert read_locations(spark, f"{target}/locations/year=*/month=*").count() == raw.count()


def test_ingest_pages_job(spark, capsys):
    from pyspark.sql import functions as F

    from placeframe import jobs

    raw = si.raw_locations(spark, SF_SMALL)
    # ten pages by a hash of the (unique) website; then the empty page that
    # ends the feed and a stale page after it that must not be taken
    numbered = raw.withColumn("page", F.pmod(F.xxhash64("website_url"), F.lit(10)) + 1)
    cols = [c for c in numbered.columns if c != "page"]
    pages = numbered.groupBy("page").agg(F.to_json(F.collect_list(F.struct(*cols))).alias("body"))
    last = pages.agg(F.max("page")).first()[0]
    extra = spark.createDataFrame([(last + 1, "[]"), (last + 2, '[{"id":"stale"}]')], "page long, body string")
    pages_dir, loc_root = fresh_dir(spark, "ip-pages"), fresh_dir(spark, "ip-loc")
    pages.unionByName(extra).write.parquet(pages_dir)
    rc = jobs.main(["ingest-pages", "--pages", pages_dir, "--raw-locations", loc_root, "--run-date", "2024-01-31"], spark=spark)
    assert rc == 0, capsys.readouterr().out
    back = read_locations(spark, f"{loc_root}/year=2024/month=01")
    assert back.count() == raw.count()
    assert back.filter("id = 'stale'").count() == 0


def test_ingest_keeps_undeclared_fields_and_fails_on_a_bad_page(spark):
    import pytest

    from placeframe import jobs

    pages_dir, loc_root = fresh_dir(spark, "ip-pages"), fresh_dir(spark, "ip-loc")
    record = '{"id":"1","name":"A","address_1":"x","tags":[1,{"a":null}]}'
    spark.createDataFrame([(1, f"[{record}]"), (2, "[]")], "page long, body string").write.json(pages_dir)
    args = ["ingest-pages", "--pages", pages_dir, "--format", "json", "--raw-locations", loc_root, "--run-date", "2024-01-31"]
    assert jobs.main(args, spark=spark) == 0
    assert [r.value for r in spark.read.text(f"{loc_root}/year=2024/month=01").collect()] == [record]
    spark.createDataFrame([(1, f"[{record}]"), (2, '[{"id":'), (3, "[]")], "page long, body string").write.mode("overwrite").json(pages_dir)
    with pytest.raises(Exception, match="page 2 holds no JSON array"):
        jobs.main(args, spark=spark)


@pytest.mark.parametrize("case", ["no weather", "malformed weather", "no kept country"])
def test_transform_survives_an_empty_stage(spark, capsys, case):
    from placeframe import jobs
    from placeframe.sinks import land_lines

    loc_root, wx_root, out, marts = (fresh_dir(spark, t) for t in ("e-loc", "e-wx", "e-out", "e-marts"))
    period = {"year": "2024", "month": "01"}
    country = "Canada" if case == "no kept country" else "United States"
    places = [f'{{"id":"{i}","name":"A","state":"Ohio","brewery_type":"micro","country":"{country}"}}' for i in range(3)]
    weather = {"no weather": [], "malformed weather": ["{oops", "nothing"], "no kept country": ['{"brewery_id":"1","fetch_date":"2024-01-31","weather":{}}']}[case]
    for root, lines in ((loc_root, places), (wx_root, weather)):
        land_lines(spark.createDataFrame([(x,) for x in lines], "value string"), root, period)
    rc = jobs.main(["transform", "--raw-locations", loc_root, "--raw-weather", wx_root, "--output", out, "--marts", marts], spark=spark)
    printed = capsys.readouterr().out
    assert rc == 0, printed
    kept = 0 if case == "no kept country" else 3
    assert read_enriched(spark, out).count() == kept
    assert spark.read.parquet(f"{marts}/fact_location_weather").filter("state_avg_temp_max_f is null").count() == kept


def test_publish_refuses_an_empty_target(spark):
    import pytest

    from placeframe import jobs

    for target in ("", "/"):
        with pytest.raises(SystemExit):
            jobs.main(["publish", "--raw-locations", "a", "--raw-weather", "b", "--target", target], spark=spark)


def test_transform_job_matched_zone_without_raw_counts(spark, capsys):
    from placeframe import jobs

    raw = si.raw_locations(spark, SF_SMALL)
    wx = si.weather_records(spark, SF_SMALL, raw)
    year, month = si.run_month(spark, SF_SMALL)
    loc_root, wx_root, out, marts = (fresh_dir(spark, t) for t in ("m-loc", "m-wx", "m-out", "m-marts"))
    land_dated_json(raw.withColumns({"year": year, "month": month}), loc_root, ("year", "month"))
    land_dated_json(wx.withColumns({"year": year, "month": month}), wx_root, ("year", "month"))
    argv = ["transform", "--raw-locations", loc_root, "--raw-weather", wx_root, "--output", out, "--marts", marts,
            "--grain", "matched_zone", "--no-raw-counts"]
    rc = jobs.main(argv, spark=spark)
    printed = capsys.readouterr().out
    assert rc == 0, printed
    assert "raw_locations" not in printed
    dim = spark.read.parquet(f"{marts}/dim_locations")
    fact = spark.read.parquet(f"{marts}/fact_location_weather")
    assert fact.count() == dim.count()  # one fact row per location at this grain
