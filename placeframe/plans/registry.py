"""queries(): one callable per operator key, each (spark, sf_dir) -> DataFrame.

Every callable derives its inputs from the given tables (see standin.py);
keys that exercise a source or sink write to a fresh folder under the
shared checkpoint root and read the result back.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from placeframe.constants import (
    ACCEPTED_CATEGORIES,
    ACCEPTED_TESTS,
    CATEGORY_RULES,
    CLIMATE_BANDS,
    CLIMATE_BELOW,
    CLIMATE_MISSING,
    DAILY_FIELDS,
    NOT_NULL_TESTS,
    PREVIEW_COLUMNS,
    PREVIEW_ORDER,
    PREVIEW_ROWS,
    STATE_CODE_LENGTH,
    UNIQUE_TESTS,
)
from placeframe.functions.columns import (
    array_mean,
    count_nulls_in,
    date_part_strings,
    is_truthy_number,
    normalize_text,
    prefix_code,
    safe_cast,
    threshold_ladder,
)
from placeframe.operators import aggregates as agg
from placeframe.operators import clean as cl
from placeframe.operators import joins as jn
from placeframe.operators import quality as qa
from placeframe.plans import standin as si
from placeframe.plans.enrichment import assemble_from_zone, build_marts, enriched, read_enriched, run_enrichment, run_enrichment_staged, stage_counts
from placeframe.schemas import RAW_LOCATION
from placeframe.operators.marts import dim_locations
from placeframe.session import fresh_dir, read_table, shared_root
from placeframe.sinks import layout as ly
from placeframe.sinks import publish as pb
from placeframe.sinks import versions as vs
from placeframe.sinks import writers as wr
from placeframe.sources import readers as rd

EVENT_RECORD = StructType(
    [
        StructField("event_id", LongType(), True),
        StructField("user_id", LongType(), True),
        StructField("event_type", StringType(), True),
        StructField("value", DoubleType(), True),
    ]
)
PAGE_RECORD = StructType([StructField("event_id", LongType(), True), StructField("event_type", StringType(), True)])
DATED = ("year", "month", "day")
#: Rows of a file in the fixed layouts: of the raw zones, and of the enriched table.
ZONE_ROWS, STATE_ROWS = 250, 40
NO_COUNT = -(1 << 63)
CRAFT_TYPES = CATEGORY_RULES[0][0]


# ---- shared derivations -----------------------------------------------------

def _enr(spark, sf_dir) -> DataFrame:
    raw = si.raw_locations(spark, sf_dir)
    return enriched(raw, si.weather_records(spark, sf_dir, raw))


def _marts(spark, sf_dir, grain: str = "state_zone"):
    return build_marts(_enr(spark, sf_dir), grain, stage_dir=fresh_dir(spark, "marts"))


def _land_raw_locations(spark, sf_dir) -> str:
    d = fresh_dir(spark, "raw-locations")
    si.raw_locations(spark, sf_dir).write.mode("overwrite").json(d)
    return d


def _land_events(spark, sf_dir, root: str | None = None) -> str:
    root = root or fresh_dir(spark, "dated-events")
    wr.land_dated_lines(si.landed_lines(spark, sf_dir), root, DATED)
    return root


def _read_events(spark, root) -> DataFrame:
    return rd.read_partitioned(spark, root, EVENT_RECORD, DATED, fmt="json")


def _write_enriched(spark, sf_dir) -> tuple[str, StructType]:
    enr = _enr(spark, sf_dir)
    out = fresh_dir(spark, "enriched")
    wr.write_partitioned_parquet(enr, out, "state")
    data_schema = StructType([f for f in enr.schema.fields if f.name != "state"])
    return out, data_schema


# ---- 2.1 sources ------------------------------------------------------------

def q_scan_ndjson_typed(spark, sf_dir):
    raw = si.raw_locations(spark, sf_dir)
    good = raw.select(F.to_json(F.struct(*raw.columns)).alias("value"))
    # one truncated (unparsable) line per record without an id: the typed
    # reader turns each into an all-null row (dropped later by cleaning)
    bad = raw.filter(F.col("id").isNull()).select(
        F.substring(F.to_json(F.struct(*raw.columns)), 1, 12).alias("value")
    )
    # and a blank (whitespace-only) line per record without a name: skipped
    blank = raw.filter(F.col("name").isNull()).select(F.lit("  ").alias("value"))
    d = fresh_dir(spark, "raw-locations-text")
    good.unionByName(bad).unionByName(blank).write.mode("overwrite").text(d)
    return rd.read_locations(spark, d)


def q_scan_ndjson_nested(spark, sf_dir):
    geo = si.geocoded_locations(spark, sf_dir)
    daily = si.daily_observations(spark, sf_dir)
    end = jn.as_of_date(daily, "obs_date")
    arrays = jn.daily_arrays(jn.trailing_window(si.repeated_days(daily), "obs_date"), "loc_id", "obs_date", ("tmax", "tmin", "precip", "wind"))
    # geocoded locations without observations get a record whose daily
    # block is empty ({}): the typed reader must still resolve the arrays
    empty = F.struct(*[F.lit(None).cast("array<double>").alias(f) for f in DAILY_FIELDS])
    env = jn.join_spreading_null_keys(geo, arrays.withColumnRenamed("loc_id", "id"), "id", "left").select(
        F.col("id").alias("brewery_id"),
        F.col("name").alias("brewery_name"),
        "state",
        "city",
        "latitude",
        "longitude",
        F.date_format(end, "yyyy-MM-dd").alias("fetch_date"),
        F.coalesce("weather", empty).alias("weather"),
    )
    d = fresh_dir(spark, "raw-weather")
    env.write.mode("overwrite").json(d)
    w = rd.read_weather(spark, d)
    return w.select(
        "brewery_id",
        "brewery_name",
        "state",
        "city",
        "latitude",
        "longitude",
        "fetch_date",
        F.coalesce(F.array_size("weather.temperature_2m_max"), F.lit(0)).cast("long").alias("n_days"),
        F.coalesce(count_nulls_in("weather.temperature_2m_min"), F.lit(0)).cast("long").alias("n_null_min"),
        F.array_max("weather.temperature_2m_max").alias("max_temp"),
    )


def q_json_decode_lines(spark, sf_dir):
    raw = si.raw_locations(spark, sf_dir)
    lines = raw.select(F.to_json(F.struct(*raw.columns)).alias("value"))
    # one whitespace-only line (spaces, tabs) per record without an id: must be skipped
    blanks = raw.filter(F.col("id").isNull()).select(F.lit(" \t \u00a0").alias("value"))
    d = fresh_dir(spark, "json-lines")
    lines.unionByName(blanks).write.mode("overwrite").text(d)
    return rd.read_json_lines(spark, d, RAW_LOCATION)


def q_scan_hive_parquet(spark, sf_dir):
    out, schema = _write_enriched(spark, sf_dir)
    return build_marts(rd.read_partitioned(spark, out, schema, ["state"])).stg


def q_snapshot_latest(spark, sf_dir):
    # only the latest day's directory is scanned (chosen from the listing)
    return rd.read_latest_partition(spark, _land_events(spark, sf_dir), EVENT_RECORD, DATED)


def q_external_json_table(spark, sf_dir):
    d = _land_raw_locations(spark, sf_dir)
    name = f"raw_locations_{uuid.uuid4().hex[:12]}"
    db_dir = f"{shared_root(spark)}/placeframe/warehouse/placeframe_raw.db"
    return rd.create_external_json_table(spark, "placeframe_raw", name, RAW_LOCATION, d, db_dir)


def q_paged_records(spark, sf_dir):
    # the records' own text, and their typed fields
    lines = rd.staged_page_lines(si.event_pages(spark, sf_dir), fresh_dir(spark, "pages"))
    return lines.select("page", "value", F.from_json("value", PAGE_RECORD, {"mode": "FAILFAST"}).alias("r")).select("page", "r.*", F.col("value").alias("record"))


def q_file_manifest(spark, sf_dir):
    # listing only, over two zones below one root, beside what their writer counted
    root = fresh_dir(spark, "raw-zones")
    zones = {"events": (si.plain_lines(spark, sf_dir), DATED), "orders": (si.order_lines(spark, sf_dir), ("year",))}
    counted = None
    for zone, (lines, parts) in zones.items():
        record = ly.write_fixed_layout(lines, f"{root}/{zone}", parts, ZONE_ROWS, "text")
        folder = F.concat_ws("/", F.lit(zone), *[F.concat(F.lit(f"{p}="), p) for p in parts])
        own = record.select(folder.alias("partition_key"), "n_rows", F.col("n_files").alias("counted_files"), F.col("n_bytes").alias("counted_bytes"))
        counted = own if counted is None else counted.unionByName(own)
    listed = rd.file_manifest(spark, root).groupBy(F.regexp_replace("key", r"/[^/]+$", "").alias("partition_key")).agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("file_size").alias("n_bytes")
    )
    same = (F.col("n_files") == F.col("counted_files")) & (F.col("n_bytes") == F.col("counted_bytes"))
    return listed.join(counted, "partition_key", "full_outer").select("partition_key", "n_rows", "n_files", "n_bytes", F.coalesce(same, F.lit(False)).alias("as_counted"))


# ---- 2.2 sinks --------------------------------------------------------------

def q_sink_partitioned_parquet(spark, sf_dir):
    out, schema = _write_enriched(spark, sf_dir)
    return rd.read_partitioned(spark, out, schema, ["state"])


def q_sink_file_count(spark, sf_dir):
    # a fixed layout: how many files a state has follows from its rows
    out = fresh_dir(spark, "fixed-layout")
    ly.write_fixed_layout(_enr(spark, sf_dir), out, "state", STATE_ROWS)
    return wr.files_per_partition(spark, out, "state")


def q_sink_dated_json(spark, sf_dir):
    root = _land_events(spark, sf_dir)
    # re-land the latest day with revised records: only that day is replaced
    latest = rd.latest_snapshot(si.landed_lines(spark, sf_dir), DATED)
    kind = F.get_json_object("value", "$.event_type")
    revised = latest.withColumn("value", F.replace("value", F.concat(F.lit('"'), kind, F.lit('"')), F.concat(F.lit('"'), F.upper(kind), F.lit('"'))))
    wr.land_dated_lines(revised, root, DATED)
    text = rd.read_partitioned(spark, root, StructType([StructField("value", StringType(), True)]), DATED, fmt="text")
    record = F.from_json("value", EVENT_RECORD, {"mode": "FAILFAST"})
    undeclared = F.get_json_object("value", "$.undeclared").cast("long")
    return text.select(record.alias("r"), undeclared.alias("undeclared"), *DATED).select("r.*", "undeclared", *DATED)


def q_publish_raw_zone(spark, sf_dir):
    src = _land_events(spark, sf_dir)
    return wr.assert_published(wr.publish_zone(spark, src, fresh_dir(spark, "published"), DATED))


def q_publish_files(spark, sf_dir):
    """Publishes a zone file by file, damages the copy (one file changed, one lost) and publishes again."""
    src, dst = fresh_dir(spark, "file-zone"), fresh_dir(spark, "file-target")
    ly.write_fixed_layout(si.plain_lines(spark, sf_dir), src, DATED, ZONE_ROWS, "text")
    first = pb.publish_files(spark, src, dst)
    ends = first.agg(F.min("key").alias("low"), F.max("key").alias("high")).first()
    if ends.low is not None:
        si.damage_zone(spark, dst, ends.low, ends.high)
    again = pb.assert_files_published(pb.publish_files(spark, src, dst))
    runs = first.withColumn("run", F.lit(1)).unionByName(again.withColumn("run", F.lit(2)))
    how_many = {s: F.count_if(F.col("status") == s).alias(s) for s in ("uploaded", "unchanged", "failed")}
    return runs.groupBy("run", *[ly.part_value("key", p).alias(p) for p in DATED]).agg(F.count(F.lit(1)).alias("files"), F.sum("lines").alias("lines"), *how_many.values())


def q_materialize_model(spark, sf_dir):
    m = _marts(spark, sf_dir)
    tag = uuid.uuid4().hex[:12]
    # staging as a view, the dimension as a table, as the model config says
    stg = wr.materialize(m.stg, f"stg_locations_{tag}", "view")
    dim = dim_locations(stg)
    return wr.materialize(dim, f"dim_locations_{tag}", "table", fresh_dir(spark, "dim-table"))


def q_publish_versions(spark, sf_dir):
    """Marts published twice: a reader that began before the second run still sees the first one whole."""
    root, m = fresh_dir(spark, "versions"), _marts(spark, sf_dir)
    vs.publish_version({"dim_locations": m.dim.filter("has_coordinates"), "summary": m.summary}, root)
    before = vs.read_version(spark, root, "dim_locations")
    vs.publish_version({"dim_locations": m.dim, "summary": m.summary}, root)
    after = vs.read_version(spark, root, "dim_locations")
    seen = before.withColumn("reader", F.lit("before")).unionByName(after.withColumn("reader", F.lit("after")))
    return seen.groupBy("reader", "state", "brewery_category").agg(F.count(F.lit(1)).alias("n"))


def q_preview(spark, sf_dir):
    return wr.preview(_enr(spark, sf_dir), PREVIEW_COLUMNS, PREVIEW_ORDER, PREVIEW_ROWS)


# ---- 2.3 projections --------------------------------------------------------

def q_clean_locations(spark, sf_dir):
    return cl.clean_locations(si.raw_locations(spark, sf_dir))


def q_safe_cast_coords(spark, sf_dir):
    raw = si.raw_locations(spark, sf_dir)
    return raw.select("id", safe_cast("latitude").alias("latitude"), safe_cast("longitude").alias("longitude"))


def q_normalize_category(spark, sf_dir):
    return si.raw_locations(spark, sf_dir).select("id", normalize_text("brewery_type").alias("brewery_type"))


def q_flag_coordinates(spark, sf_dir):
    raw = si.raw_locations(spark, sf_dir)
    flag = safe_cast("latitude").isNotNull() & safe_cast("longitude").isNotNull()
    return raw.select("id", flag.alias("has_coordinates"))


def q_flatten_weather(spark, sf_dir):
    return cl.flatten_weather(si.weather_records(spark, sf_dir))


def q_threshold_ladder(spark, sf_dir):
    e = _enr(spark, sf_dir)
    zone = threshold_ladder("avg_temp_max_f", CLIMATE_BANDS, CLIMATE_BELOW, CLIMATE_MISSING)
    return e.select("brewery_id", "avg_temp_max_f", zone.alias("climate_zone"))


def q_prefix_code(spark, sf_dir):
    c = cl.clean_locations(si.raw_locations(spark, sf_dir))
    return c.select("brewery_id", "state", prefix_code("state", STATE_CODE_LENGTH).alias("state_code"))


def q_stg_locations(spark, sf_dir):
    return _marts(spark, sf_dir).stg


def q_dim_locations(spark, sf_dir):
    return _marts(spark, sf_dir).dim


def q_fact_location_weather(spark, sf_dir):
    return _marts(spark, sf_dir).fact


def q_fact_matched_zone(spark, sf_dir):
    # the count is null for rows without a matching zone: shown as -1, so that
    # the bigint stays one through every client conversion
    f = _marts(spark, sf_dir, grain="matched_zone").fact
    return f.withColumn("breweries_in_state", F.coalesce("breweries_in_state", F.lit(-1).cast("long")))


def q_assemble_weather(spark, sf_dir):
    return _by_day(si.weather_records(spark, sf_dir))


def _by_day(w: DataFrame) -> DataFrame:
    exploded = w.select("brewery_id", "fetch_date", "weather", F.posexplode("weather." + DAILY_FIELDS[0]).alias("pos", "_v"))
    return exploded.select(
        "brewery_id",
        "fetch_date",
        (F.col("pos") + 1).cast("long").alias("day_index"),
        *[F.get(F.col("weather").getField(f), F.col("pos")).alias(f) for f in DAILY_FIELDS],
    )


def q_assemble_from_zone(spark, sf_dir):
    # an observation zone laid out by day, of which only the window's folders are opened
    root = fresh_dir(spark, "observations")
    daily = si.repeated_days(si.daily_observations(spark, sf_dir))
    wr.write_partitioned_parquet(daily.select("*", *date_part_strings("obs_date", DATED)), root, DATED)
    w = assemble_from_zone(spark, root, daily.schema, si.geocoded_locations(spark, sf_dir), DATED)
    return _by_day(w)


# ---- 2.4 filters ------------------------------------------------------------

def q_filter_country(spark, sf_dir):
    return cl.filter_country(si.raw_locations(spark, sf_dir)).select("id", "name", "country")


def q_filter_required(spark, sf_dir):
    return cl.filter_required(si.raw_locations(spark, sf_dir), "name", "state").select("id", "name", "state")


def q_filter_geocoded(spark, sf_dir):
    return si.geocoded_locations(spark, sf_dir).select("id", "name", "state", "latitude", "longitude")


def q_trailing_window(spark, sf_dir):
    # dates are presented as ISO strings (as the raw zone stores them)
    w = jn.trailing_window(si.daily_observations(spark, sf_dir), "obs_date")
    return w.withColumn("obs_date", F.date_format("obs_date", "yyyy-MM-dd"))


# ---- 2.5 joins --------------------------------------------------------------

def q_left_join_weather(spark, sf_dir):
    raw = si.raw_locations(spark, sf_dir)
    c = cl.clean_locations(raw)
    return jn.left_join_weather(c, cl.flatten_weather(si.weather_records(spark, sf_dir, raw)))


def q_missing_weather(spark, sf_dir):
    raw = si.raw_locations(spark, sf_dir)
    geo = si.geocoded_locations(spark, sf_dir, raw)
    return jn.missing_weather(geo, si.weather_records(spark, sf_dir, raw)).select("id", "name", "state")


def q_lookup_report(spark, sf_dir):
    raw = si.raw_locations(spark, sf_dir)
    geo = si.geocoded_locations(spark, sf_dir, raw)
    return agg.lookup_report(geo, si.weather_records(spark, sf_dir, raw))


# ---- 2.6 aggregations -------------------------------------------------------

def q_join_coverage(spark, sf_dir):
    return agg.join_coverage(_enr(spark, sf_dir))


def q_state_weather_summary(spark, sf_dir):
    return _marts(spark, sf_dir).summary


def q_stage_counts(spark, sf_dir):
    raw = si.raw_locations(spark, sf_dir)
    return stage_counts(raw, si.weather_records(spark, sf_dir, raw))


def q_stage_counts_written(spark, sf_dir):
    """The job by way of written stages; the counts are of the files."""
    period = si.run_period(spark, sf_dir)
    roots = {k: fresh_dir(spark, f"counted-{k}") for k in ("locations", "weather", "stage", "out")}
    base = si.raw_locations(spark, sf_dir)
    wr.land_period_json(base, roots["locations"], period)
    wr.land_period_json(si.weather_records(spark, sf_dir, base), roots["weather"], period)
    locations = rd.read_locations(spark, f"{roots['locations']}/year=*/month=*/*.json")
    weather = rd.read_weather(spark, f"{roots['weather']}/year=*/month=*/*.json")
    return run_enrichment_staged(locations, weather, roots["out"], roots["stage"])


def q_geocode_coverage(spark, sf_dir):
    return agg.geocode_coverage(si.raw_locations(spark, sf_dir), is_truthy_number("latitude") & is_truthy_number("longitude"))


def q_top_groups(spark, sf_dir):
    return agg.top_groups(si.raw_locations(spark, sf_dir), "state")


def q_dominant_category(spark, sf_dir):
    return agg.dominant_category(_marts(spark, sf_dir).dim, "state", "brewery_type")


def q_density_correlation(spark, sf_dir):
    stg = _marts(spark, sf_dir).stg
    return agg.density_correlation(stg, "state", "avg_temp_max_f", F.col("brewery_type").isin(list(CRAFT_TYPES)))


def q_count_over_time(spark, sf_dir):
    c = agg.count_over_time(si.location_orders(spark, sf_dir), "state", "period", "location")
    # the first period has no previous count: shown as the smallest bigint
    return c.withColumns({k: F.coalesce(k, F.lit(NO_COUNT)) for k in ("prev_members", "change")})


# ---- 2.7 quality ------------------------------------------------------------

def _models(spark, sf_dir) -> dict[str, DataFrame]:
    m = _marts(spark, sf_dir)
    return {"stg_locations": m.stg, "state_weather_summary": m.summary, "dim_locations": m.dim, "fact_location_weather": m.fact}


def q_check_unique(spark, sf_dir):
    models = _models(spark, sf_dir)
    parts = [
        qa.check_unique(models[m], "brewery_id").select(F.lit(m).alias("model"), "brewery_id", "n")
        for m in ("stg_locations", "dim_locations", "fact_location_weather")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


KNOWN_TYPES = tuple(t for values, _ in CATEGORY_RULES for t in values)


def q_check_not_null(spark, sf_dir):
    models = _models(spark, sf_dir)
    by_model: dict[str, list[str]] = {}
    for m, c in NOT_NULL_TESTS:
        by_model.setdefault(m, []).append(c)
    parts = [qa.not_null_counts(m, models[m], cols) for m, cols in by_model.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.drop("test")


def q_check_accepted_values(spark, sf_dir):
    models = _models(spark, sf_dir)
    checks = [("dim_locations", "brewery_category", ACCEPTED_CATEGORIES), ("stg_locations", "brewery_type", KNOWN_TYPES)]
    parts = [
        qa.check_accepted_values(models[m], c, v).select(
            F.lit(m).alias("model"), F.lit(c).alias("column_name"), F.col(c).alias("value"), "n"
        )
        for m, c, v in checks
    ]
    return parts[0].unionByName(parts[1])


def q_quality_report(spark, sf_dir):
    return qa.run_suite(_models(spark, sf_dir), UNIQUE_TESTS, NOT_NULL_TESTS, ACCEPTED_TESTS)


# ---- 2.8 set operations -----------------------------------------------------

def q_union_snapshots(spark, sf_dir):
    snaps = si.location_snapshots(spark, sf_dir)
    out = None
    for label, df in snaps:
        tagged = df.select(F.lit(label).alias("snapshot"), "id", "name", "state")
        out = tagged if out is None else out.unionByName(tagged)
    return out


# ---- 2.9 scalar functions ---------------------------------------------------

def _at_least_50(x):
    return x >= F.lit(50.0)


def q_array_mean(spark, sf_dir):
    w = si.weather_records(spark, sf_dir)
    tmax = F.col("weather").getField(DAILY_FIELDS[0])
    tmin = F.col("weather").getField(DAILY_FIELDS[1])
    return w.select(
        "brewery_id",
        array_mean(tmax).cast("float").alias("mean_max"),
        array_mean(tmin).cast("float").alias("mean_min"),
        array_mean(F.filter(tmax, _at_least_50)).cast("float").alias("mean_max_hot"),
    )


def q_partition_parts(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    return o.select("o_orderkey", *date_part_strings("o_orderdate", ("year", "month")))


def q_json_encode_lines(spark, sf_dir):
    e = read_table(spark, sf_dir, "events").select("event_id", "event_type")
    return wr.encode_json_lines(e, ["event_id", "event_type"], keep=["event_id"])


# ---- 2.12 composites ----------------------------------------------------------

def q_enrich(spark, sf_dir):
    return _enr(spark, sf_dir)


def q_enrichment_job(spark, sf_dir):
    """Whole job: land raw NDJSON under year=/month=, read it back through
    the typed readers, clean, join, enrich, write by state, read back."""
    period = si.run_period(spark, sf_dir)
    loc_root = fresh_dir(spark, "raw-zone-locations")
    wx_root = fresh_dir(spark, "raw-zone-weather")
    base = si.raw_locations(spark, sf_dir)
    wr.land_period_json(base, loc_root, period)
    wr.land_period_json(si.weather_records(spark, sf_dir, base), wx_root, period)
    out = fresh_dir(spark, "enriched-output")
    run_enrichment(
        rd.read_locations(spark, f"{loc_root}/year=*/month=*/*.json"),
        rd.read_weather(spark, f"{wx_root}/year=*/month=*/*.json"),
        out,
    )
    return read_enriched(spark, out)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "scan_ndjson_typed": q_scan_ndjson_typed,
    "scan_ndjson_nested": q_scan_ndjson_nested,
    "json_decode_lines": q_json_decode_lines,
    "scan_hive_parquet": q_scan_hive_parquet,
    "snapshot_latest": q_snapshot_latest,
    "external_json_table": q_external_json_table,
    "paged_records": q_paged_records,
    "file_manifest": q_file_manifest,
    "sink_partitioned_parquet": q_sink_partitioned_parquet,
    "sink_file_count": q_sink_file_count,
    "sink_dated_json": q_sink_dated_json,
    "publish_raw_zone": q_publish_raw_zone,
    "publish_files": q_publish_files,
    "materialize_model": q_materialize_model,
    "publish_versions": q_publish_versions,
    "preview": q_preview,
    "clean_locations": q_clean_locations,
    "safe_cast_coords": q_safe_cast_coords,
    "normalize_category": q_normalize_category,
    "flag_coordinates": q_flag_coordinates,
    "flatten_weather": q_flatten_weather,
    "threshold_ladder": q_threshold_ladder,
    "prefix_code": q_prefix_code,
    "stg_locations": q_stg_locations,
    "dim_locations": q_dim_locations,
    "fact_location_weather": q_fact_location_weather,
    "fact_matched_zone": q_fact_matched_zone,
    "assemble_weather": q_assemble_weather,
    "assemble_from_zone": q_assemble_from_zone,
    "filter_country": q_filter_country,
    "filter_required": q_filter_required,
    "join_coverage": q_join_coverage,
    "state_weather_summary": q_state_weather_summary,
    "filter_geocoded": q_filter_geocoded,
    "trailing_window": q_trailing_window,
    "left_join_weather": q_left_join_weather,
    "missing_weather": q_missing_weather,
    "lookup_report": q_lookup_report,
    "stage_counts": q_stage_counts,
    "stage_counts_written": q_stage_counts_written,
    "geocode_coverage": q_geocode_coverage,
    "top_groups": q_top_groups,
    "dominant_category": q_dominant_category,
    "density_correlation": q_density_correlation,
    "count_over_time": q_count_over_time,
    "check_unique": q_check_unique,
    "check_not_null": q_check_not_null,
    "check_accepted_values": q_check_accepted_values,
    "quality_report": q_quality_report,
    "union_snapshots": q_union_snapshots,
    "array_mean": q_array_mean,
    "partition_parts": q_partition_parts,
    "json_encode_lines": q_json_encode_lines,
    "enrich": q_enrich,
    "enrichment_job": q_enrichment_job,
}
