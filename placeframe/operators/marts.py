"""Enrichment and the staging / dimension / fact models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeframe.constants import (
    CATEGORY_DEFAULT,
    CATEGORY_RULES,
    CLIMATE_BANDS,
    CLIMATE_BELOW,
    CLIMATE_MISSING,
    MEAN_COLUMNS,
    STATE_CODE_LENGTH,
    SUMMARY_COLUMNS,
)
from placeframe.functions.columns import bucket_by_membership, prefix_code, threshold_ladder


def enrich(joined: DataFrame) -> DataFrame:
    """Add climate_zone (ladder on avg_temp_max_f) and state_code."""
    return joined.withColumns(
        {
            "climate_zone": threshold_ladder("avg_temp_max_f", CLIMATE_BANDS, CLIMATE_BELOW, CLIMATE_MISSING),
            "state_code": prefix_code("state", STATE_CODE_LENGTH),
        }
    )


def stg_locations(enriched: DataFrame) -> DataFrame:
    """Staging view: id and name required, name -> brewery_name,
    coordinates widened to double; state_code is not carried."""
    return enriched.filter(F.col("brewery_id").isNotNull() & F.col("name").isNotNull()).select(
        "brewery_id",
        F.col("name").alias("brewery_name"),
        "brewery_type",
        "city",
        "state",
        F.col("latitude").cast("double").alias("latitude"),
        F.col("longitude").cast("double").alias("longitude"),
        "website_url",
        "has_coordinates",
        *MEAN_COLUMNS,
        "climate_zone",
        "fetch_date",
    )


def state_weather_summary(stg: DataFrame) -> DataFrame:
    """Per (state, climate_zone) with a known zone: round(avg, 2) of the four
    means and the row count. Partial aggregation runs before the shuffle,
    so a hot state costs one pre-aggregated row per task."""
    aggs = [F.round(F.avg(src), 2).alias(dst) for src, dst in zip(MEAN_COLUMNS, SUMMARY_COLUMNS)]
    return (
        stg.filter(F.col("climate_zone") != F.lit(CLIMATE_MISSING))
        .groupBy("state", "climate_zone")
        .agg(*aggs, F.count(F.lit(1)).alias("brewery_count"))
    )


DIM_COLUMNS = (
    "brewery_id",
    "brewery_name",
    "brewery_type",
    "city",
    "state",
    "latitude",
    "longitude",
    "website_url",
    "has_coordinates",
    "climate_zone",
)


def dim_locations(stg: DataFrame) -> DataFrame:
    """Dimension: staging columns plus brewery_category buckets."""
    return stg.select(
        *DIM_COLUMNS,
        bucket_by_membership("brewery_type", CATEGORY_RULES, CATEGORY_DEFAULT).alias("brewery_category"),
    )


def fact_location_weather(dim: DataFrame, summary: DataFrame, grain: str = "state_zone") -> DataFrame:
    """Fact: dimension left-joined to the state summary.

    grain="state_zone" joins on state only, as the modelled workload does:
    one row per (location, known zone of its state). grain="matched_zone"
    joins on (state, climate_zone): one row per location.
    The summary has at most (#states x #zones) rows; no broadcast hint is
    given: AQE measures the finished summary stage and switches to a
    broadcast join when it is under the threshold, else keeps the shuffle.
    """
    keys = ["state"] if grain == "state_zone" else ["state", "climate_zone"]
    w = summary.select(*keys, *SUMMARY_COLUMNS, F.col("brewery_count").alias("breweries_in_state"))
    cond = [dim[k] == w[k] for k in keys]
    joined = dim.join(w, cond, "left")
    return joined.select(
        dim["brewery_id"],
        dim["brewery_name"],
        dim["brewery_type"],
        dim["brewery_category"],
        dim["city"],
        dim["state"],
        dim["latitude"],
        dim["longitude"],
        dim["climate_zone"],
        dim["has_coordinates"],
        *[w[c] for c in SUMMARY_COLUMNS],
        w["breweries_in_state"],
    )
