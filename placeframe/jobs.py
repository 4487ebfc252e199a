"""Command-line jobs. Submit with spark-submit; paths may be any Hadoop URI.

transform (default): transform the raw zone, build the marts, run the
quality suite; exits non-zero when a quality test fails.

  spark-submit --py-files placeframe.zip placeframe/jobs.py \\
      --raw-locations .../raw/locations --raw-weather .../raw/weather \\
      --output .../processed --marts .../marts

assemble: weather records for the latest location snapshot from a daily
observation table (loc_id, obs_date, tmax, tmin, precip, wind), for the
trailing window ending at --as-of (default: latest date), landed as NDJSON
under year=/month= of the window end; exits non-zero when none is found.

  spark-submit --py-files placeframe.zip placeframe/jobs.py assemble \\
      --raw-locations .../raw/locations --daily .../daily_obs \\
      --raw-weather .../raw/weather [--as-of 2024-01-31]

ingest-pages: landed page bodies (columns page, body: a JSON array of
location records) -> the records, as they came, of the pages before the first
empty one, landed one a line under year=/month= of --run-date; stops without
writing when there are no records and fails on a page that holds no array.

  spark-submit --py-files placeframe.zip placeframe/jobs.py ingest-pages \\
      --pages .../landed_pages --format parquet --raw-locations .../raw/locations \\
      --run-date 2024-01-31

publish: bring <target>/locations and <target>/weather up to date with the raw
zones, file by file under the same keys: only absent and changed files are copied,
and the copies' content is compared; prints how many files were uploaded,
unchanged and failed, and exits non-zero when one failed or a zone holds no records.

  spark-submit --py-files placeframe.zip placeframe/jobs.py publish \\
      --raw-locations .../raw/locations --raw-weather .../raw/weather --target s3a://bucket/raw
"""

from __future__ import annotations

import argparse
import datetime
import json
import sys

from pyspark.sql import functions as F

from placeframe.constants import ACCEPTED_TESTS, NOT_NULL_TESTS, UNIQUE_TESTS
from placeframe.operators.aggregates import lookup_report
from placeframe.operators.clean import filter_geocoded
from placeframe.operators.joins import assemble_weather
from placeframe.operators.quality import require_nonempty, run_suite
from placeframe.plans.enrichment import (
    SNAPSHOT_PARTS,
    build_marts,
    publish_marts,
    read_enriched,
    run_enrichment,
)
from placeframe.schemas import DAILY_OBSERVATION, RAW_LOCATION, RAW_WEATHER
from placeframe.session import build_session, fresh_dir, remove_scratch
from placeframe.sinks.publish import file_counts, publish_files
from placeframe.sinks.writers import land_lines, land_period_json, write_table
from placeframe.sinks.versions import publish_version, read_version
from placeframe.sources.readers import read_latest_partition, read_partitioned, staged_page_lines
from placeframe.sources.zones import read_day_window


def main(argv: list[str] | None = None, spark=None) -> int:
    argv = list(sys.argv[1:] if argv is None else argv)
    if argv and argv[0] == "assemble":
        return assemble(argv[1:], spark)
    if argv and argv[0] == "publish":
        return publish(argv[1:], spark)
    if argv and argv[0] == "ingest-pages":
        return ingest_pages(argv[1:], spark)
    if argv and argv[0] == "transform":
        argv = argv[1:]
    return transform(argv, spark)


def assemble(argv: list[str], spark=None) -> int:
    ap = argparse.ArgumentParser(prog="placeframe.jobs assemble")
    ap.add_argument("--raw-locations", required=True, help="root of year=/month= location NDJSON")
    ap.add_argument("--daily", required=True, help="Parquet daily observations")
    ap.add_argument("--raw-weather", required=True, help="root to land year=/month= weather NDJSON")
    ap.add_argument("--as-of", default=None, help="window end date (default: latest observation date)")
    ap.add_argument("--daily-by-day", action="store_true", help="the observations lie under year=/month=/day=: open only the window's folders")
    a = ap.parse_args(argv)

    own = spark is None
    spark = spark or build_session(app_name="placeframe-assemble")
    locations = read_latest_partition(spark, a.raw_locations, RAW_LOCATION, SNAPSHOT_PARTS).drop(*SNAPSHOT_PARTS)
    geocoded = filter_geocoded(locations)
    if a.daily_by_day:
        daily, end = read_day_window(spark, a.daily, DAILY_OBSERVATION, as_of=a.as_of)
        a.as_of = str(end) if end else None
    else:
        daily = spark.read.parquet(a.daily)
    # one value, resolved once: a literal bound then prunes the observations
    as_of = a.as_of or daily.agg(F.date_format(F.max("obs_date"), "yyyy-MM-dd").alias("d")).first()["d"]
    found = False
    if as_of is not None:
        # the assembly runs once, into a scratch folder; the report and the landing read that
        staged = f"{fresh_dir(spark, 'assembled')}/weather"
        weather = write_table(assemble_weather(daily, geocoded, as_of=as_of), staged)
        report = lookup_report(geocoded, weather).first()
        print(json.dumps({"succeeded": report["succeeded"], "failed": report["failed"]}))
        found = report["succeeded"] > 0
        if found:
            land_period_json(weather, a.raw_weather, {"year": as_of[:4], "month": as_of[5:7]})
        remove_scratch(spark, staged.rsplit("/", 1)[0])
    if not found:
        print(json.dumps({"error": "no weather records assembled"}))
    if own:
        spark.stop()
    return 0 if found else 1


def ingest_pages(argv: list[str], spark=None) -> int:
    ap = argparse.ArgumentParser(prog="placeframe.jobs ingest-pages")
    ap.add_argument("--pages", required=True, help="landed pages: columns page (int), body (JSON array)")
    ap.add_argument("--format", default="parquet", help="format of the landed pages (parquet, json, ...)")
    ap.add_argument("--raw-locations", required=True, help="root to land year=/month= location NDJSON")
    ap.add_argument("--run-date", required=True, help="date whose year/month names the landing")
    a = ap.parse_args(argv)

    own = spark is None
    spark = spark or build_session(app_name="placeframe-ingest-pages")
    pages = spark.read.format(a.format).schema("page long, body string").load(a.pages)
    # the records' own text: fields that no schema declares land too
    staged = fresh_dir(spark, "landed-pages")
    records = staged_page_lines(pages, staged).select("value")
    found = not records.isEmpty()
    if found:
        run = datetime.date.fromisoformat(a.run_date)
        land_lines(records, a.raw_locations, {"year": f"{run:%Y}", "month": f"{run:%m}"})
    else:
        print(json.dumps({"error": "no location records in the landed pages"}))
    remove_scratch(spark, staged)
    if own:
        spark.stop()
    return 0 if found else 1


def publish(argv: list[str], spark=None) -> int:
    ap = argparse.ArgumentParser(prog="placeframe.jobs publish")
    ap.add_argument("--raw-locations", required=True, help="root of year=/month= location NDJSON")
    ap.add_argument("--raw-weather", required=True, help="root of year=/month= weather NDJSON")
    ap.add_argument("--target", required=True, help="target root (keeps each zone's layout)")
    a = ap.parse_args(argv)
    if not a.target.strip("/ "):
        ap.error("--target must name a folder")  # never the file system's root

    own = spark is None
    spark = spark or build_session(app_name="placeframe-publish")
    target = a.target.rstrip("/")
    failed = 0
    for name, src in {"locations": a.raw_locations, "weather": a.raw_weather}.items():
        report = publish_files(spark, src, f"{target}/{name}")
        counts = file_counts(report)
        rows = report.filter("status <> 'failed'").agg(F.sum("lines")).first()[0] or 0
        bad = [r.key for r in report.filter("status = 'failed'").select("key").limit(20).collect()]
        print(json.dumps({"zone": name, "uploaded": counts["uploaded"], "failed": counts["failed"], "rows": rows, "unchanged": counts["unchanged"], "failures": bad}))
        failed += counts["failed"]
        if not sum(counts.values()):
            print(json.dumps({"zone": name, "error": "no records to publish"}))
            failed += 1
    if own:
        spark.stop()
    return 1 if failed else 0


def transform(argv: list[str], spark=None) -> int:
    ap = argparse.ArgumentParser(prog="placeframe.jobs transform")
    ap.add_argument("--raw-locations", required=True, help="root of year=/month= location NDJSON")
    ap.add_argument("--raw-weather", required=True, help="root of year=/month= weather NDJSON")
    ap.add_argument("--output", required=True, help="enriched Parquet, partitioned by state")
    ap.add_argument("--marts", required=True, help="folder for the mart tables")
    ap.add_argument("--snapshots", choices=("all", "latest"), default="latest", help="all: every snapshot of one side with every one of the other")
    ap.add_argument("--grain", choices=("state_zone", "matched_zone"), default="state_zone")
    ap.add_argument(
        "--no-raw-counts",
        action="store_true",
        help="skip raw row counts so cleaning filters are pushed into the JSON scan",
    )
    ap.add_argument("--one-pass", action="store_true", help="no written clean tables: counts are observed during the write, and a repeated task counts again")
    ap.add_argument("--versioned", action="store_true", help="write the marts as a new version and point readers to it when all are written")
    a = ap.parse_args(argv)

    own = spark is None
    spark = spark or build_session(app_name="placeframe-job")
    # year/month come from the directories, declared as strings ("01")
    locations = read_partitioned(spark, a.raw_locations, RAW_LOCATION, SNAPSHOT_PARTS, fmt="json")
    weather = read_partitioned(spark, a.raw_weather, RAW_WEATHER, SNAPSHOT_PARTS, fmt="json")
    require_nonempty(locations, "location records")
    stage = None if a.one_pass else fresh_dir(spark, "clean-stage")
    counts = run_enrichment(locations, weather, a.output, snapshots=a.snapshots, count_raw=not a.no_raw_counts, stage_dir=stage)
    if stage:
        remove_scratch(spark, stage)
    print(json.dumps({"stage_counts": counts}, default=str))

    enr = read_enriched(spark, a.output)
    # the enriched input is already a written table: stage only the summary
    staged = fresh_dir(spark, "marts-stage")
    marts = build_marts(enr, a.grain, stage_dir=staged, stage=("summary",))
    if a.versioned:
        version = publish_version({"dim_locations": marts.dim, "fact_location_weather": marts.fact}, a.marts)
        tables = {n: read_version(spark, a.marts, n, version) for n in ("dim_locations", "fact_location_weather")}
    else:
        tables = publish_marts(marts, a.marts)
    models = {
        "stg_locations": marts.stg,
        "state_weather_summary": marts.summary,
        "dim_locations": tables["dim_locations"],
        "fact_location_weather": tables["fact_location_weather"],
    }
    report = run_suite(models, UNIQUE_TESTS, NOT_NULL_TESTS, ACCEPTED_TESTS).collect()  # one row per test
    failed = [r.asDict() for r in report if r.status != "pass"]
    remove_scratch(spark, staged)
    print(json.dumps({"tests": len(report), "failed": failed}))
    if own:
        spark.stop()
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
