"""Location and weather inputs derived from the test tables.

The given tables hold no location or weather records, so these Spark
derivations stand in for them; every row of the source tables flows
through (defects are injected into values, never by dropping rows):

  raw locations  <- customer x nation x region (one record per customer);
                    ids, names, states, coordinates and types are blanked
                    or garbled on a fixed arithmetic pattern of the key
  daily obs      <- events aggregated per (user, day): max, min, count,
                    range; some minima are nulled to exercise null days
  pages          <- events cut into pages of 200 by event_id
  snapshots      <- raw locations, and those with orders of even and of odd years
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placeframe.constants import PAGE_SIZE
from placeframe.operators.clean import filter_geocoded
from placeframe.operators.joins import as_of_date, assemble_weather
from placeframe.session import _folder, read_table


def raw_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    # nation/region are dimension files; the planner broadcasts them only if
    # their measured size is under the broadcast threshold.
    j = c.join(n, c["c_nationkey"] == n["n_nationkey"]).join(r, F.col("n_regionkey") == r["r_regionkey"])
    k = F.col("c_custkey")
    seg = F.col("c_mktsegment")
    region = F.col("r_name")
    return j.select(
        F.when(k % 97 == 0, F.lit(None)).otherwise(k.cast("string")).alias("id"),
        F.when(k % 31 == 0, F.lit(None)).otherwise(F.col("c_name")).alias("name"),
        F.when(seg == "AUTOMOBILE", " Micro ")
        .when(seg == "BUILDING", "BREWPUB")
        .when(seg == "FURNITURE", "regional")
        .when(seg == "MACHINERY", "Taproom")
        .otherwise("contract")
        .alias("brewery_type"),
        seg.alias("city"),
        F.when(k % 37 == 0, F.lit(None)).otherwise(F.col("n_name")).alias("state"),
        F.when(region == "ASIA", "Canada")
        .when(region == "EUROPE", F.lit(None))
        .otherwise("United States")
        .alias("country"),
        F.when(k % 7 == 0, F.lit(None))
        .when(k % 11 == 0, "")
        .when(k % 13 == 0, "n/a")
        .otherwise(F.col("c_acctbal").cast("string"))
        .alias("latitude"),
        F.when(k % 5 == 0, F.lit(None)).otherwise((-F.col("c_acctbal")).cast("string")).alias("longitude"),
        F.concat(F.lit("https://x/"), k.cast("string")).alias("website_url"),
        F.lit(None).cast("string").alias("phone"),
    )


def daily_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(loc_id, obs_date, tmax, tmin, precip, wind, n): one row per user-day.
    The aggregate combines map-side, so a hot user costs one row per task."""
    e = read_table(spark, sf_dir, "events").select("user_id", "ts", "value")
    g = e.groupBy("user_id", F.to_date("ts").alias("obs_date")).agg(
        F.max("value").alias("tmax"),
        F.min("value").alias("_vmin"),
        F.count(F.lit(1)).alias("n"),
    )
    null_day = ((F.col("user_id") % 10) == 3) & ((F.dayofmonth("obs_date") % 2) == 0)
    return g.select(
        F.col("user_id").cast("string").alias("loc_id"),
        "obs_date",
        "tmax",
        F.when(null_day, F.lit(None)).otherwise(F.col("_vmin")).alias("tmin"),
        (F.col("n").cast("double") / 10).alias("precip"),
        (F.col("tmax") - F.col("_vmin")).alias("wind"),
        "n",
    )


def repeated_days(daily: DataFrame) -> DataFrame:
    """The observations, with a second, smaller record for every third day's rows:
    an assembly must reduce them to one record a day."""
    twice = F.dayofmonth("obs_date") % 3 == 0
    readings = F.when(twice, F.array(F.col("tmax"), F.col("tmax") - 1)).otherwise(F.array("tmax"))
    return daily.withColumn("tmax", F.explode(readings))


def geocoded_locations(spark: SparkSession, sf_dir: str, raw: DataFrame | None = None) -> DataFrame:
    return filter_geocoded(raw if raw is not None else raw_locations(spark, sf_dir))


def weather_records(spark: SparkSession, sf_dir: str, raw: DataFrame | None = None) -> DataFrame:
    """Nested weather records for geocoded locations (trailing window), from
    observations of which some days are repeated."""
    return assemble_weather(repeated_days(daily_observations(spark, sf_dir)), geocoded_locations(spark, sf_dir, raw))


def run_month(spark: SparkSession, sf_dir: str) -> tuple:
    """(year, month) strings of the run: the weather window's end date."""
    end = as_of_date(daily_observations(spark, sf_dir), "obs_date")
    return F.date_format(end, "yyyy"), F.date_format(end, "MM")


def run_period(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """The run's year and month as constants (one value comes to the driver)."""
    end = daily_observations(spark, sf_dir).agg(F.max("obs_date").alias("d")).first()["d"]
    return {"year": f"{end:%Y}", "month": f"{end:%m}"}


def landed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as JSON lines with a field that no schema declares, and their date parts."""
    e = landed_events(spark, sf_dir)
    fields = [c for c in e.columns if c not in ("year", "month", "day")]
    return e.select(F.to_json(F.struct(*fields, (F.col("event_id") % 7).alias("undeclared"))).alias("value"), "year", "month", "day")


def landed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events with zero-padded year/month/day strings for dated landings."""
    e = read_table(spark, sf_dir, "events")
    d = F.col("ts")
    return e.select(
        "event_id",
        "user_id",
        "event_type",
        "value",
        F.date_format(d, "yyyy").alias("year"),
        F.date_format(d, "MM").alias("month"),
        F.date_format(d, "dd").alias("day"),
    )


def plain_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as JSON lines of whole numbers and text, and their date parts: lines whose
    length any engine gives alike."""
    e = landed_events(spark, sf_dir)
    return e.select(F.to_json(F.struct("event_id", "user_id", "event_type")).alias("value"), "year", "month", "day")


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as JSON lines, and their year."""
    o = read_table(spark, sf_dir, "orders")
    return o.select(F.to_json(F.struct("o_orderkey", "o_custkey")).alias("value"), F.date_format("o_orderdate", "yyyy").alias("year"))


def damage_zone(spark: SparkSession, root: str, first: str, last: str) -> None:
    """Plants two faults in a zone: other content in the file ``first``, and ``last`` lost."""
    fs, where = _folder(spark, f"{root}/{first}")
    out = fs.create(where, True)
    out.writeBytes("{}\n")
    out.close()
    fs.delete(_folder(spark, f"{root}/{last}")[1], False)


def event_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page, body): events cut into pages of PAGE_SIZE by event_id, then the
    empty page that ends the feed and one stale page after it (a copy of the
    first page) that a reader must not take. Records have a field, user_id, that
    the typed schema doesn't declare."""
    e = read_table(spark, sf_dir, "events").select("event_id", "event_type", "user_id")
    page = (F.floor(F.col("event_id") / PAGE_SIZE) + 1).alias("page")
    # at most PAGE_SIZE records per page (event_id is the page's sort key)
    pages = e.groupBy(page).agg(
        F.to_json(F.array_sort(F.collect_list(F.struct("event_id", "event_type", "user_id")))).alias("body")
    )
    last = pages.select(F.max("page")).scalar()
    first = pages.select(F.min("page")).scalar()
    end = pages.filter(F.col("page") == first).select((last + 1).alias("page"), F.lit("[]").alias("body"))
    stale = pages.filter(F.col("page") == first).select((last + 2).alias("page"), "body")
    return pages.unionByName(end).unionByName(stale)


def location_snapshots(spark: SparkSession, sf_dir: str) -> list[tuple[str, DataFrame]]:
    """Three snapshots of the location feed: everything, the locations with an
    order of an even year, and those with one of an odd year (semi joins: no
    fan-out)."""
    raw = raw_locations(spark, sf_dir).select("id", "name", "state")
    # distinct keys first: a customer with a third of all orders becomes
    # two rows per task before the shuffle that feeds the semi joins
    active = (
        read_table(spark, sf_dir, "orders")
        .select(F.col("o_custkey").cast("string").alias("_k"), (F.year("o_orderdate") % 2).alias("_odd"))
        .distinct()
    )
    out = [("a", raw)]
    for label, odd in (("b", 0), ("c", 1)):
        own = active.filter(F.col("_odd") == odd)
        out.append((label, raw.join(own, raw["id"] == own["_k"], "left_semi")))
    return out


def location_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(state, period, location) per order: who was active in which year."""
    # distinct (customer, year) first: combines map-side, so a customer with
    # a third of all orders becomes one row per year before any join shuffle
    o = (
        read_table(spark, sf_dir, "orders")
        .select("o_custkey", F.date_format("o_orderdate", "yyyy").alias("period"))
        .distinct()
    )
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    cn = c.join(n, c["c_nationkey"] == n["n_nationkey"])
    j = o.join(cn, o["o_custkey"] == cn["c_custkey"])
    return j.select(
        F.col("n_name").alias("state"),
        "period",
        F.col("o_custkey").alias("location"),
    )
