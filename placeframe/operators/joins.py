"""Joins, the trailing window, and assembly of nested weather records."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType

from placeframe.constants import DAILY_FIELDS, WINDOW_DAYS


def as_of_date(daily: DataFrame, date_col: str, as_of: str | _dt.date | None = None) -> Column:
    """The window end: a given date, else the latest date in the data.

    The latest date is a scalar subquery (one small aggregate, evaluated
    once) rather than a cross join or a driver round trip.
    """
    if as_of is not None:
        return F.lit(str(as_of)).cast("date")
    return daily.select(F.max(date_col)).scalar()


def trailing_window(
    daily: DataFrame,
    date_col: str = "obs_date",
    days: int = WINDOW_DAYS,
    as_of: str | _dt.date | None = None,
) -> DataFrame:
    """Rows with date in [as_of - days, as_of], both ends inclusive. The bounds are
    on the column itself, so they reach the Parquet reader when ``as_of`` is given."""
    return daily.filter(_in_window(daily, date_col, days, as_of_date(daily, date_col, as_of)))


def _in_window(daily: DataFrame, date_col: str, days: int, end: Column) -> Column:
    date = F.col(date_col)
    end = end.cast("date")
    if isinstance(daily.schema[date_col].dataType, DateType):
        return date.between(F.date_sub(end, days), end)
    if isinstance(daily.schema[date_col].dataType, StringType):
        date = date.cast("date")
        return date.between(F.date_sub(end, days), end)
    return (date >= F.date_sub(end, days)) & (date < F.date_add(end, 1))  # times of the last day too


def _shuffle_width(df: DataFrame) -> int:
    try:
        return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    except (TypeError, ValueError):
        return 200


def join_spreading_null_keys(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str = "left",
    buckets: int | None = None,
) -> DataFrame:
    """Left outer / left anti equi-join on ``key`` (kept once, from the left).

    Left rows whose key is null can never match, yet hash partitioning would
    send all of them to one reducer; if a third of the rows lack a key that
    task holds a third of the data. A second join column spreads them: 0
    for every right row and every keyed left row (so keyed rows partition
    exactly as on ``key`` alone), and a deterministic hash bucket 1..buckets
    for null-key left rows. ``buckets`` defaults to the session's shuffle
    width, so the null rows are spread over every reducer. Results are
    unchanged; a retried task recomputes the same buckets. Skew on a real
    key is left to AQE's skew-join split. Cost: both sides are partitioned
    on (key, salt), so a right side already hash-partitioned on ``key``
    alone is shuffled once more; when the left key column is declared
    non-nullable no salt is added and existing partitioning is reused.
    """
    if not left.schema[key].nullable:
        return left.join(right, on=key, how=how)
    buckets = buckets or _shuffle_width(left)
    salt = F.when(
        F.col(key).isNull(),
        F.pmod(F.xxhash64(*[F.col(c) for c in left.columns]), F.lit(buckets)) + 1,
    ).otherwise(F.lit(0))
    l = left.withColumn("_null_spread", salt)
    # the right side's 0 must not be a literal: the optimizer would turn
    # "salt = 0" into a join filter and shuffle on ``key`` alone, putting the
    # null rows back into one partition. pmod(hash, 1) is 0 but not foldable.
    r = right.withColumn("_null_spread", F.pmod(F.xxhash64(F.col(key)), F.lit(1)))
    return l.join(r, on=[key, "_null_spread"], how=how).drop("_null_spread")


def left_join_weather(locations: DataFrame, weather: DataFrame, key: str = "brewery_id") -> DataFrame:
    """Left equi-join on one key column (kept once). Null keys never match
    and are kept; duplicate keys fan out n x m. The planner picks broadcast
    only for a side measured under the threshold; otherwise a sort-merge
    join where null-key rows are spread and AQE splits skewed keys."""
    return join_spreading_null_keys(locations, weather, key, "left")


def _field(name: str):
    def pick(x: Column) -> Column:
        return x.getField(name)

    return pick


def daily_arrays(
    window_rows: DataFrame,
    key: str,
    date_col: str,
    measures: Sequence[str],
    fields: Sequence[str] = DAILY_FIELDS,
) -> DataFrame:
    """One row per key with one array per measure, ordered by date.

    Collects struct(date, measures...) so null measurements survive
    (collect_list drops null elements, not structs holding nulls) and the
    arrays stay aligned day by day. Repeated days are reduced to one record
    first (the greatest by the measures in their order), before the shuffle,
    so a group never exceeds the window's length.
    """
    date = F.to_date(date_col).alias("_date")
    one = window_rows.groupBy(key, date).agg(F.max(F.struct(*measures)).alias("_m")).select(key, "_date", "_m.*")
    days = F.array_sort(F.collect_list(F.struct("_date", *measures)))
    grouped = one.groupBy(key).agg(days.alias("_days"))
    block = F.struct(*[F.transform("_days", _field(m)).alias(f) for m, f in zip(measures, fields)])
    return grouped.select(key, block.alias("weather"))


def assemble_weather(
    daily: DataFrame,
    locations: DataFrame,
    measures: Sequence[str] = ("tmax", "tmin", "precip", "wind"),
    daily_key: str = "loc_id",
    date_col: str = "obs_date",
    days: int = WINDOW_DAYS,
    as_of: str | _dt.date | None = None,
) -> DataFrame:
    """Per-location weather records for the trailing window.

    The lookup of the original workload (one request per geocoded location
    for [as_of-7, as_of]) becomes: window filter -> per-location arrays ->
    equi-join with the geocoded locations. Locations without any day in the
    window get no record (see ``missing_weather``).
    Output: brewery_id, brewery_name, state, city, latitude, longitude,
    fetch_date (ISO string), weather struct of four aligned arrays.
    """
    end = as_of_date(daily, date_col, as_of)
    win = daily.filter(_in_window(daily, date_col, days, end))
    arrays = daily_arrays(win, daily_key, date_col, measures)
    loc = locations.select(
        F.col("id").alias("brewery_id"),
        F.col("name").alias("brewery_name"),
        "state",
        "city",
        "latitude",
        "longitude",
    )
    joined = loc.join(arrays, loc["brewery_id"] == arrays[daily_key], "inner")
    return joined.select(
        "brewery_id",
        "brewery_name",
        "state",
        "city",
        "latitude",
        "longitude",
        F.date_format(end, "yyyy-MM-dd").alias("fetch_date"),
        "weather",
    )


def missing_weather(locations: DataFrame, weather: DataFrame, key: str = "id", weather_key: str = "brewery_id") -> DataFrame:
    """Locations that received no weather record (anti join; null keys kept).
    The right side is reduced to distinct keys first (map-side), so a key
    repeated across many records never builds up in one task."""
    w = weather.select(F.col(weather_key).alias(key)).filter(F.col(key).isNotNull()).distinct()
    return join_spreading_null_keys(locations, w, key, "left_anti")
