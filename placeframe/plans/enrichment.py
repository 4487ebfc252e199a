"""Composed jobs: raw records -> enriched table -> marts, plus the
single-pass stage counts."""

from __future__ import annotations

from functools import cached_property

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from placeframe.operators.aggregates import latest_per_key
from placeframe.operators.clean import clean_locations, flatten_weather, kept_by_cleaning
from placeframe.constants import WINDOW_DAYS
from placeframe.operators.joins import assemble_weather, left_join_weather
from placeframe.operators.marts import (
    dim_locations,
    enrich,
    fact_location_weather,
    state_weather_summary,
    stg_locations,
)
from placeframe.schemas import RAW_LOCATION, RAW_WEATHER
from placeframe.sinks.writers import write_partitioned_parquet, write_table
from placeframe.sources.zones import read_day_window


SNAPSHOT_PARTS = ("year", "month")


def latest_locations(raw_locations: DataFrame, parts=SNAPSHOT_PARTS) -> DataFrame:
    """One record per id: the one from the greatest (year, month) snapshot. The
    snapshot columns must be there (read with ``basePath``)."""
    missing = [p for p in parts if p not in raw_locations.columns]
    if missing:
        raise ValueError(f"the latest snapshot needs the columns {', '.join(parts)}; missing: {', '.join(missing)}")
    latest = latest_per_key(raw_locations, "id", F.struct(*parts))
    return latest.drop(*parts)


def latest_weather(flat_weather: DataFrame) -> DataFrame:
    """One weather record per location: the greatest ISO fetch_date."""
    return latest_per_key(flat_weather, "brewery_id", "fetch_date")


def enriched(raw_locations: DataFrame, raw_weather: DataFrame, snapshots: str = "all") -> DataFrame:
    """clean -> left join -> enrich.

    snapshots="all" (default) joins every snapshot of both sides, as the
    modelled job does (k snapshots give k x k rows per location);
    snapshots="latest" keeps one location record per id (by year/month when
    present) and one weather record per id (by fetch_date) first.
    """
    return enrich(left_join_weather(*_cleaned(raw_locations, raw_weather, snapshots)))


def _cleaned(raw_locations: DataFrame, raw_weather: DataFrame, snapshots: str) -> tuple[DataFrame, DataFrame]:
    """The clean tables that the join takes."""
    if snapshots not in ("all", "latest"):
        raise ValueError(f"snapshots must be all or latest, not {snapshots!r}")
    weather = flatten_weather(raw_weather)
    if snapshots == "latest":
        return clean_locations(latest_locations(raw_locations)), latest_weather(weather)
    return clean_locations(raw_locations.drop(*SNAPSHOT_PARTS)), weather


class Marts:
    """stg -> (summary, dim) -> fact, built on first use.

    With ``stage_dir`` (a folder in the shared checkpoint root) the staging
    model is written once and every mart reads it, instead of each mart
    recomputing the enrichment; the summary (one row per state and zone)
    is written too when the fact needs it, so the fact join broadcasts it on
    its measured size and the large dimension side is never shuffled.
    """

    def __init__(
        self,
        enriched_df: DataFrame,
        grain: str = "state_zone",
        stage_dir: str | None = None,
        stage: tuple[str, ...] = ("stg", "summary"),
    ):
        self._enriched = enriched_df
        self.grain = grain
        self.stage_dir = stage_dir
        self.stage = stage if stage_dir else ()

    @cached_property
    def stg(self) -> DataFrame:
        stg = stg_locations(self._enriched)
        return write_table(stg, f"{self.stage_dir}/stg_locations") if "stg" in self.stage else stg

    @cached_property
    def summary(self) -> DataFrame:
        summary = state_weather_summary(self.stg)
        if "summary" in self.stage:
            return write_table(summary, f"{self.stage_dir}/state_weather_summary")
        return summary

    @cached_property
    def dim(self) -> DataFrame:
        return dim_locations(self.stg)

    @cached_property
    def fact(self) -> DataFrame:
        return fact_location_weather(self.dim, self.summary, self.grain)


def build_marts(
    enriched_df: DataFrame,
    grain: str = "state_zone",
    stage_dir: str | None = None,
    stage: tuple[str, ...] = ("stg", "summary"),
) -> Marts:
    """Marts over an enriched table. ``stage`` names the models written to
    ``stage_dir``: stage "stg" when the enriched input is an expensive plan;
    when it is already a written table, staging only the (tiny) summary is
    enough."""
    return Marts(enriched_df, grain, stage_dir, stage)


def register_models(marts: Marts, prefix: str = "") -> dict[str, str]:
    """Expose the models as temp views so SQL written against them runs
    through spark.sql (views are inlined by the optimizer)."""
    names = {
        "stg_locations": marts.stg,
        "state_weather_summary": marts.summary,
        "dim_locations": marts.dim,
        "fact_location_weather": marts.fact,
    }
    out = {}
    for name, df in names.items():
        view = f"{prefix}{name}"
        df.createOrReplaceTempView(view)
        out[name] = view
    return out


def publish_marts(marts: Marts, out_root: str) -> dict[str, DataFrame]:
    """Write the mart tables (dimension and fact) under ``out_root``."""
    return {
        "dim_locations": write_table(marts.dim, f"{out_root}/dim_locations"),
        "fact_location_weather": write_table(marts.fact, f"{out_root}/fact_location_weather"),
    }


def stage_counts(raw_locations: DataFrame, raw_weather: DataFrame) -> DataFrame:
    """Raw and clean rows of both inputs in one row, from one pass over each."""
    one = F.lit(1)
    counts = F.struct(F.count(one).alias("raw"), F.count_if(F.col("brewery_id").isNotNull()).alias("clean"))
    weather = raw_weather.select(counts).scalar()
    return raw_locations.agg(F.count(one).alias("raw_locations"), F.count_if(kept_by_cleaning()).alias("clean_locations")).select(
        "raw_locations", "clean_locations", weather["raw"].alias("raw_weather"), weather["clean"].alias("clean_weather")
    )


def enriched_schema(spark) -> StructType:
    """The enriched table's schema, from the raw schemas (no data is read)."""
    raw = spark.createDataFrame([], RAW_LOCATION)
    return enriched(raw, spark.createDataFrame([], RAW_WEATHER)).schema


def read_enriched(spark, path: str, partition_col: str = "state") -> DataFrame:
    """Scan the enriched output with its partition column kept as a string
    ("" and values like "01" are not re-typed). The schema is the job's own, so
    an output without rows reads as an empty table."""
    from placeframe.sources.readers import read_partitioned

    data = StructType([f for f in enriched_schema(spark).fields if f.name != partition_col])
    return read_partitioned(spark, path, data, [partition_col])


def _observed(observation: Observation, *names: str) -> dict:
    """The metrics of an observation; 0 where its stage was optimised away as empty."""
    try:
        found = observation.get
    except (AssertionError, Py4JError, PySparkException):
        found = {}
    return {n: found.get(n) or 0 for n in names}


def run_enrichment_staged(
    raw_locations: DataFrame, raw_weather: DataFrame, output_path: str, stage_dir: str, snapshots: str = "all", count_raw: bool = True
) -> DataFrame:
    """The enrichment by way of written clean tables; returns ``written_counts``. The join reads the
    written tables, so a lost executor costs no second cleaning, and their real sizes
    decide how they are joined."""
    clean, weather = _cleaned(raw_locations, raw_weather, snapshots)
    clean = write_table(clean, f"{stage_dir}/clean_locations")
    weather = write_table(weather, f"{stage_dir}/clean_weather")
    write_partitioned_parquet(enrich(left_join_weather(clean, weather)), output_path, "state")
    raw = {"raw_locations": raw_locations, "raw_weather": raw_weather} if count_raw else {}
    return written_counts({**raw, "clean_locations": clean, "clean_weather": weather}, read_enriched(clean.sparkSession, output_path))


def written_counts(stages: dict[str, DataFrame], joined: DataFrame) -> DataFrame:
    """One row with the rows of each stage, of the joined table and of those with weather: plain
    aggregates over written files (row counts come from the footers), so a repeated task counts once."""
    rows = F.count(F.lit(1))
    counts = [df.select(rows).scalar().alias(name) for name, df in stages.items()]
    return joined.agg(rows.alias("joined"), F.count("avg_temp_max_f").alias("with_weather")).select(*counts, "joined", "with_weather")


def assemble_from_zone(spark, root: str, schema: StructType, locations: DataFrame, parts=("year", "month", "day"), as_of=None, days: int = WINDOW_DAYS) -> DataFrame:
    """Weather records for the trailing window of an observation zone laid out by day. Only the
    window's folders are opened; its end is ``as_of`` or the zone's last day."""
    window, end = read_day_window(spark, root, schema, parts, days, as_of)
    return assemble_weather(window, locations, as_of=end, days=days)


def run_enrichment(
    raw_locations: DataFrame,
    raw_weather: DataFrame,
    output_path: str,
    snapshots: str = "all",
    count_raw: bool = True,
    stage_dir: str | None = None,
) -> dict:
    """Whole enrichment job.

    With ``stage_dir`` (a scratch folder) the clean tables are written there and the
    stage counts are taken from what was written (``written_counts``): each is
    right whatever was repeated after a lost executor. Raw rows are counted by
    a pass of their own, which splits lines and decodes none.

    Without it the job is one write pass. Stage counts are gathered with ``observe`` while the write runs, so the
    raw inputs are scanned once (no count() actions, no cache). They are for
    the log: a stage that runs again after a lost executor counts its rows
    again. A stage without rows counts 0. Counting raw rows needs every row,
    so that metric sits under the cleaning filters and keeps them out of the
    JSON scan; ``count_raw=False`` drops the two raw counts and lets the
    filters reach the reader."""
    if stage_dir is not None:
        counts = run_enrichment_staged(raw_locations, raw_weather, output_path, stage_dir, snapshots, count_raw).first().asDict()
        both = counts.pop("with_weather")
        return {k: {"n": n} | ({"with_weather": both} if k == "joined" else {}) for k, n in counts.items()}
    names = ["clean_locations", "clean_weather", "joined"]
    if count_raw:
        names = ["raw_locations", "raw_weather", *names]
    obs = {k: Observation(k) for k in names}
    one = F.count(F.lit(1)).alias("n")
    rl, rw = raw_locations, raw_weather
    if count_raw:
        rl = rl.observe(obs["raw_locations"], one)
        rw = rw.observe(obs["raw_weather"], one)
    clean, weather = _cleaned(rl, rw, snapshots)
    clean = clean.observe(obs["clean_locations"], one)
    weather = weather.observe(obs["clean_weather"], one)
    joined = left_join_weather(clean, weather).observe(
        obs["joined"], one, F.count("avg_temp_max_f").alias("with_weather")
    )
    write_partitioned_parquet(enrich(joined), output_path, "state")
    return {k: _observed(o, "n", *(["with_weather"] if k == "joined" else [])) for k, o in obs.items()}
