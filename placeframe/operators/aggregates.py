"""Coverage counts and the dashboard questions (top states, dominant type,
climate/density correlation, counts over time)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from placeframe.constants import TOP_K


def count_where(cond: Column) -> Column:
    return F.count_if(cond)


def join_coverage(enriched: DataFrame, measure: str = "avg_temp_max_f") -> DataFrame:
    """One pass: total rows and rows with a weather measure."""
    return enriched.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count(measure).alias("with_weather"),
    )


def lookup_report(requested: DataFrame, received: DataFrame, key: str = "id", received_key: str = "brewery_id") -> DataFrame:
    """One row: requested rows that got a record (succeeded) and that did not
    (failed). Received keys are reduced to distinct values map-side first;
    null request keys count as failed."""
    got = received.select(F.col(received_key).alias("_k")).filter(F.col("_k").isNotNull()).distinct()
    from placeframe.operators.joins import join_spreading_null_keys

    flagged = join_spreading_null_keys(
        requested.select(F.col(key).alias("_k")),
        got.withColumn("_hit", F.lit(True)),
        "_k",
        "left",
    )
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    return flagged.agg(count_where(hit).alias("succeeded"), count_where(~hit).alias("failed"))


def geocode_coverage(raw: DataFrame, cond: Column) -> DataFrame:
    """One pass: rows meeting and failing a predicate (null counts as failing)."""
    hit = F.coalesce(cond, F.lit(False))
    return raw.agg(count_where(hit).alias("geocoded"), count_where(~hit).alias("skipped"))


def top_groups(df: DataFrame, key: str, k: int = TOP_K, count_name: str = "brewery_count") -> DataFrame:
    """Top-k groups by row count; ties broken by key (nulls last).
    Planned as partial/final aggregate + TakeOrderedAndProject."""
    return (
        df.groupBy(key)
        .agg(F.count(F.lit(1)).alias(count_name))
        .orderBy(F.col(count_name).desc(), F.col(key).asc_nulls_last())
        .limit(k)
    )


def dominant_category(df: DataFrame, group: str, category: str) -> DataFrame:
    """Most frequent category per group: (group, category, n); ties go to the
    smallest category, a null category last.

    Both steps are aggregates that combine map-side: counts per (group,
    category), then min_by over the key (-n, category is null, category).
    No window sorts a group's categories in one task, however many there are.
    """
    counts = df.groupBy(group, category).agg(F.count(F.lit(1)).alias("n"))
    rank = F.struct(
        (-F.col("n")).alias("neg_n"),
        F.col(category).isNull().alias("is_null"),
        F.col(category).alias("value"),
    )
    best = counts.groupBy(group).agg(F.min_by(F.struct(category, "n"), rank).alias("_best"))
    return best.select(group, "_best.*")


def density_correlation(
    stg: DataFrame,
    group: str,
    measure: str,
    member: Column,
) -> DataFrame:
    """Per group: mean measure and count of member rows; then the Pearson
    correlation across groups (rounded to 6 places)."""
    per_group = stg.groupBy(group).agg(
        F.avg(measure).alias("_m"),
        F.count_if(member).cast("double").alias("_n"),
    )
    return per_group.agg(
        F.round(F.corr("_m", "_n"), 6).alias("corr_temp_density"),
        F.count(F.lit(1)).alias("n_groups"),
    )


def count_over_time(df: DataFrame, group: str, period: str, member: str) -> DataFrame:
    """Distinct members per (group, period), the previous period's count and
    the change. Distinct counting is planned as a two-level aggregate (no
    group is collected); the window sees one row per (group, period)."""
    counts = df.groupBy(group, period).agg(F.countDistinct(member).alias("n_members"))
    w = Window.partitionBy(group).orderBy(period)
    prev = F.lag("n_members").over(w)
    return counts.withColumn("prev_members", prev).withColumn(
        "change", F.col("n_members") - F.col("prev_members")
    )


def latest_per_key(df: DataFrame, key: str, order: str | Column) -> DataFrame:
    """Keep, per key, the row with the greatest ``order`` (a column name or
    expression, e.g. struct(year, month)); rows with a null key pass through.
    Uses max_by, which combines map-side, so a hot key never lands in one
    task as a group of raw rows."""
    cols = df.columns
    order_col = F.col(order) if isinstance(order, str) else order
    # ties on ``order`` are broken by a hash of the whole row, so a retried
    # task picks the same row (max_by alone may pick either)
    rank = F.struct(order_col.alias("o"), F.xxhash64(*[F.col(c) for c in cols]).alias("h"))
    keyed = df.filter(F.col(key).isNotNull())
    best = keyed.groupBy(key).agg(F.max_by(F.struct(*cols), rank).alias("_r"))
    return best.select("_r.*").unionByName(df.filter(F.col(key).isNull()))
