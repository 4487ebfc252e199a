import datetime as dt
import json
import os


from placeframe.operators import (
    check_accepted_values,
    check_not_null,
    check_unique,
    clean_locations,
    dominant_category,
    filter_geocoded,
    flatten_weather,
    latest_per_key,
    left_join_weather,
    missing_weather,
    require_nonempty,
    run_suite,
    top_groups,
    trailing_window,
)
from placeframe.operators.joins import assemble_weather
from placeframe.plans.enrichment import build_marts, enriched
from placeframe.schemas import RAW_LOCATION, RAW_WEATHER

import pytest
from pyspark.sql import functions as F

from placeframe.sources import read_locations


def loc(**kw):
    base = {f.name: None for f in RAW_LOCATION.fields}
    base.update(kw)
    return tuple(base[f.name] for f in RAW_LOCATION.fields)


def test_clean_locations_filters_and_casts(spark):
    rows = [
        loc(id="1", name="A", state="Ohio", country=None, latitude="n/a", longitude="1"),
        loc(id="2", name="B", state="Ohio", country="United States", latitude="", longitude="1"),
        loc(id="3", name="C", state="Ohio", country="Canada", latitude="1", longitude="1"),
        loc(id="4", name=None, state="Ohio", latitude="1", longitude="1"),
        loc(id="5", name="E", state=None, latitude="1", longitude="1"),
        loc(id="6", name="F", state="", brewery_type="  MICRO ", latitude=" 35.5 ", longitude="2"),
        loc(id="7", name="G", state="Ohio", latitude="0", longitude="0"),
    ]
    df = clean_locations(spark.createDataFrame(rows, RAW_LOCATION))
    got = {r.brewery_id: r for r in df.collect()}
    assert sorted(got) == ["1", "2", "6", "7"]
    assert "country" not in df.columns and "phone" not in df.columns
    assert got["1"].latitude is None and got["1"].has_coordinates is False
    assert got["2"].has_coordinates is False
    assert got["6"].latitude == 35.5 and got["6"].brewery_type == "micro" and got["6"].state == ""
    assert got["7"].has_coordinates is True
    assert df.columns == [
        "brewery_id", "name", "brewery_type", "city", "state", "latitude", "longitude", "website_url", "has_coordinates",
    ]


def test_geocoded_filter(spark):
    rows = [loc(id=str(i), latitude=v, longitude="1") for i, v in enumerate(["n/a", "", None, " 35.5 ", "0"])]
    got = sorted(r.id for r in filter_geocoded(spark.createDataFrame(rows, RAW_LOCATION)).collect())
    assert got == ["0", "3"]


def test_numeric_zero_is_no_coordinate(spark, local_dir):
    with open(os.path.join(local_dir, "a.json"), "w") as f:
        for i, v in enumerate(["0", "0.0", "-0.0", "35.5", '"35.5"', "null", '""']):
            f.write(f'{{"id": "{i}", "latitude": {v}, "longitude": 1.5}}\n')
    assert sorted(r.id for r in filter_geocoded(read_locations(spark, local_dir)).collect()) == ["3", "4"]


def test_empty_weather_block_reads_and_means_are_null(spark, local_dir):
    path = os.path.join(local_dir, "w.json")
    with open(path, "w") as f:
        for i in range(3):
            f.write(json.dumps({"brewery_id": str(i), "fetch_date": "2024-01-31", "weather": {}}) + "\n")
    w = spark.read.schema(RAW_WEATHER).json(path)
    out = flatten_weather(w).collect()
    assert len(out) == 3
    assert all(r.avg_temp_max_f is None and r.avg_windspeed_mph is None for r in out)


def test_malformed_and_blank_lines(spark, local_dir):
    path = os.path.join(local_dir, "b.json")
    with open(path, "w") as f:
        f.write(json.dumps({"id": "1", "name": "A", "state": "Ohio"}) + "\n")
        f.write("{not json\n")
        f.write("\n")
    raw = spark.read.schema(RAW_LOCATION).json(path)
    assert raw.count() == 2  # blank skipped, malformed -> all-null row
    assert [r.brewery_id for r in clean_locations(raw).collect()] == ["1"]


def test_left_join_keeps_unmatched_and_null_ids(spark):
    rows = [loc(id="1", name="A", state="Ohio"), loc(id=None, name="N", state="Ohio")]
    clean = clean_locations(spark.createDataFrame(rows, RAW_LOCATION))
    w = spark.createDataFrame([("9", "2024-01-31", 70.0)], "brewery_id string, fetch_date string, avg_temp_max_f double")
    j = left_join_weather(clean, w)
    assert j.count() == 2
    assert all(r.avg_temp_max_f is None for r in j.collect())


def _weather_rows(spark, rows):
    return spark.createDataFrame(
        [(i, d, {"temperature_2m_max": t, "temperature_2m_min": t, "precipitation_sum": t, "windspeed_10m_max": t}) for i, d, t in rows],
        "brewery_id string, fetch_date string, weather struct<temperature_2m_max: array<double>, temperature_2m_min: array<double>, precipitation_sum: array<double>, windspeed_10m_max: array<double>>",
    )


def test_two_snapshots_fan_out_and_latest(spark):
    rows = [loc(id="1", name="A", state="Ohio"), loc(id="1", name="A", state="Ohio")]
    raw = spark.createDataFrame(rows, RAW_LOCATION)
    w = _weather_rows(spark, [("1", "2024-01-31", [50.0]), ("1", "2024-02-29", [90.0])])
    assert enriched(raw, w).count() == 4
    with pytest.raises(ValueError, match="year, month"):
        enriched(raw, w, snapshots="latest")
    with pytest.raises(ValueError):
        enriched(raw, w, snapshots="newest")
    dated = raw.withColumns({"year": F.lit("2024"), "month": F.lit("01")})
    latest = enriched(dated, w, snapshots="latest").collect()
    assert len(latest) == 1 and latest[0].climate_zone == "hot"


def test_repeated_days_become_one_record(spark):
    import datetime as dt

    day = dt.date(2024, 1, 31)
    rows = [("1", day - dt.timedelta(days=i % 3), 50.0 + i % 3 - i // 3, 1.0, 0.0, 0.0) for i in range(9)]
    daily = spark.createDataFrame(rows, "loc_id string, obs_date date, tmax double, tmin double, precip double, wind double")
    places = spark.createDataFrame([loc(id="1", name="A", state="Ohio", latitude="1", longitude="1")], RAW_LOCATION)
    got = assemble_weather(daily, places, as_of="2024-01-31").collect()
    assert [r.weather.temperature_2m_max for r in got] == [[52.0, 51.0, 50.0]]


def test_latest_snapshot_of_locations_by_year_month(spark):
    cols = [f.name for f in RAW_LOCATION.fields]
    rows = [loc(id="1", name="A", state="Ohio") + ("2024", "01"), loc(id="1", name="A2", state="Iowa") + ("2024", "02")]
    raw = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cols + ["year", "month"]))
    w = _weather_rows(spark, [("1", "2024-01-31", [50.0]), ("1", "2024-02-29", [90.0])])
    assert enriched(raw, w).count() == 4
    got = enriched(raw, w, snapshots="latest").collect()
    assert [(r.name, r.state, r.climate_zone) for r in got] == [("A2", "Iowa", "hot")]


def test_latest_per_key_keeps_null_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), (None, 1), (None, 2)], "k string, v int")
    got = sorted((r.k or "", r.v) for r in latest_per_key(df, "k", "v").collect())
    assert got == [("", 1), ("", 2), ("a", 3)]


def test_fact_fans_out_per_zone(spark, scratch):
    rows = [loc(id="1", name="A", state="Ohio", brewery_type="micro"), loc(id="2", name="B", state="Ohio", brewery_type="large")]
    raw = spark.createDataFrame(rows, RAW_LOCATION)
    w = _weather_rows(spark, [("1", "2024-01-31", [85.0]), ("2", "2024-01-31", [45.0])])
    m = build_marts(enriched(raw, w), stage_dir=scratch)
    assert m.summary.count() == 2
    assert m.fact.count() == 4
    assert build_marts(enriched(raw, w), grain="matched_zone").fact.count() == 2
    cats = {r.brewery_id: r.brewery_category for r in m.dim.collect()}
    assert cats == {"1": "craft", "2": "commercial"}


def test_null_id_dropped_at_staging(spark):
    rows = [loc(id=None, name="A", state="Ohio")]
    raw = spark.createDataFrame(rows, RAW_LOCATION)
    w = _weather_rows(spark, [])
    e = enriched(raw, w)
    assert e.count() == 1 and e.first().climate_zone == "unknown"
    assert build_marts(e).stg.count() == 0


def test_trailing_window_is_eight_days(spark):
    days = [dt.date(2024, 1, d) for d in range(1, 32)]
    df = spark.createDataFrame([(d,) for d in days], "obs_date date")
    got = sorted(r.obs_date for r in trailing_window(df, "obs_date", as_of="2024-01-31").collect())
    assert got[0] == dt.date(2024, 1, 24) and got[-1] == dt.date(2024, 1, 31) and len(got) == 8
    assert trailing_window(df, "obs_date").count() == 8  # default: latest date in the data


def test_assemble_keeps_null_days_aligned(spark):
    daily = spark.createDataFrame(
        [("1", dt.date(2024, 1, 2), 5.0, None, 0.1, 1.0), ("1", dt.date(2024, 1, 1), 4.0, 2.0, 0.2, 2.0)],
        "loc_id string, obs_date date, tmax double, tmin double, precip double, wind double",
    )
    locs = spark.createDataFrame([loc(id="1", name="A", state="Ohio", latitude="1", longitude="1"), loc(id="2", name="B")], RAW_LOCATION)
    env = assemble_weather(daily, locs).collect()
    assert len(env) == 1
    w = env[0].weather
    assert w.temperature_2m_max == [4.0, 5.0] and w.temperature_2m_min == [2.0, None]
    assert env[0].fetch_date == "2024-01-02"
    assert [r.id for r in missing_weather(locs, assemble_weather(daily, locs)).collect()] == ["2"]


def test_quality_checks(spark):
    df = spark.createDataFrame([("a", "craft"), ("a", "x"), (None, None), (None, "other"), ("b", "x"), ("c", "y")], "k string, c string")
    assert [(r.k, r.n) for r in check_unique(df, "k").collect()] == [("a", 2)]
    assert check_not_null(df, "k").count() == 2
    assert sorted((r.c, r.n) for r in check_accepted_values(df, "c", ["craft", "other"]).collect()) == [("x", 2), ("y", 1)]
    rep = {(r.column_name, r.test): (r.failures, r.status) for r in run_suite(
        {"m": df}, unique=[("m", "k")], not_null=[("m", "k"), ("m", "c")], accepted=[("m", "c", ["craft", "other"])]
    ).collect()}
    assert rep == {("k", "not_null"): (2, "fail"), ("c", "not_null"): (1, "fail"), ("k", "unique"): (1, "fail"), ("c", "accepted_values"): (2, "fail")}


def test_require_nonempty(spark):
    with pytest.raises(ValueError):
        require_nonempty(spark.range(0), "records")
    require_nonempty(spark.range(1), "records")


def test_top_groups_and_dominant(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("a", "y"), ("b", "x"), (None, "x")], "s string, t string")
    assert [(r.s, r.brewery_count) for r in top_groups(df, "s", 2).collect()] == [("a", 3), ("b", 1)]
    assert sorted((r.s, r.t) for r in dominant_category(df.filter("s is not null"), "s", "t").collect()) == [("a", "y"), ("b", "x")]


def test_dominant_category_ties(spark):
    df = spark.createDataFrame(
        [("a", "x"), ("a", "x"), ("a", None), ("a", None), ("b", "z"), ("b", "y"), ("c", "w"), ("c", "w"), ("c", "v")],
        "s string, t string",
    )
    got = sorted((r.s, r.t, r.n) for r in dominant_category(df, "s", "t").collect())
    assert got == [("a", "x", 2), ("b", "y", 1), ("c", "w", 2)]


def test_count_over_time_lag_and_change(spark):
    from placeframe.operators import count_over_time

    rows = [("a", "2020", 1), ("a", "2020", 1), ("a", "2020", 2), ("a", "2021", 1), ("b", "2021", 5)]
    df = spark.createDataFrame(rows, "s string, p string, m int")
    got = sorted((r.s, r.p, r.n_members, r.prev_members, r.change) for r in count_over_time(df, "s", "p", "m").collect())
    assert got == [("a", "2020", 2, None, None), ("a", "2021", 1, 2, -1), ("b", "2021", 1, None, None)]


def test_density_correlation_perfect(spark):
    from pyspark.sql import functions as F

    from placeframe.operators import density_correlation

    # group g_k has k craft rows and mean measure 10*k: correlation 1
    rows = [(f"g{k}", 10.0 * k, "micro") for k in range(1, 5) for _ in range(k)]
    df = spark.createDataFrame(rows, "s string, t double, ty string")
    r = density_correlation(df, "s", "t", F.col("ty").isin("micro")).first()
    assert r.corr_temp_density == 1.0 and r.n_groups == 4


def test_join_coverage_counts(spark):
    from placeframe.operators import join_coverage

    df = spark.createDataFrame([(1.0,), (None,), (3.0,)], "avg_temp_max_f double")
    r = join_coverage(df).first()
    assert (r.total_rows, r.with_weather) == (3, 2)
