"""Skew handling: a key holding most rows must not land in one task."""

from pyspark.sql import functions as F

from placeframe.operators.joins import join_spreading_null_keys


def _no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    aqe = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # keep the 8 raw shuffle partitions visible
    return old, aqe


def _restore(spark, old, aqe):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    spark.conf.set("spark.sql.adaptive.enabled", aqe)


def test_null_keys_spread_over_partitions(spark):
    old, aqe = _no_broadcast(spark)
    prev_width = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        n = 6000
        left = spark.range(n).select(
            F.when(F.col("id") % 3 != 0, F.lit(None)).otherwise(F.col("id").cast("string")).alias("k"),
            F.col("id").alias("v"),
        )  # two thirds of the rows have no key
        right = spark.range(0, n, 3).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("w"))
        out = join_spreading_null_keys(left, right, "k", "left")
        per_part = out.groupBy(F.spark_partition_id().alias("p")).count().collect()
        biggest = max(r["count"] for r in per_part)
        assert len(per_part) == 8
        assert biggest < 0.3 * n  # without spreading one partition would hold >= 4000 rows
        plain = left.join(right, "k", "left")
        assert out.exceptAll(plain.select(*out.columns)).isEmpty() and out.count() == plain.count() == n
        anti = join_spreading_null_keys(left, right.filter("k < '1000'"), "k", "left_anti")
        assert anti.count() == left.join(right.filter("k < '1000'"), "k", "left_anti").count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", prev_width)
        _restore(spark, old, aqe)


def test_hot_key_aggregates_combine_map_side(spark):
    """A key with a third of the rows reaches the shuffle as one partial row
    per input partition (partial aggregation), not as raw rows."""
    from placeframe.operators import check_unique

    df = spark.range(30000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"))
    res = {r.k: r.n for r in check_unique(df.repartition(6), "k").collect()}
    assert res == {"hot": 10000}
    import io
    from contextlib import redirect_stdout

    buf = io.StringIO()
    with redirect_stdout(buf):
        check_unique(df, "k").explain()
    plan = buf.getvalue()
    assert "partial_count" in plan


def test_hot_partition_value_written_by_several_tasks(spark, scratch):
    from placeframe.sinks import files_per_partition, write_partitioned_parquet

    prev = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16k")
    try:
        n = 60000
        df = spark.range(n).repartition(8).select(
            F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("s"), (F.col("id") % 7).cast("string"))).alias("state"),
            (F.col("id") * 7919 % 1000003).alias("v"),
        )
        write_partitioned_parquet(df, scratch, "state")
        f = {r.state: (r.n_files, r.n_rows) for r in files_per_partition(spark, scratch, "state").collect()}
        assert f["hot"][1] == n // 3
        assert f["hot"][0] > 1  # the hot value was split over several writers
        assert sum(rows for _, rows in f.values()) == n
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", prev)


def test_no_salt_for_non_nullable_key(spark):
    import io
    from contextlib import redirect_stdout

    left = spark.range(10).select(F.col("id").alias("k"))  # id is never null
    right = spark.range(5).select(F.col("id").alias("k"), F.lit(1).alias("w"))
    out = join_spreading_null_keys(left, right, "k", "left")
    buf = io.StringIO()
    with redirect_stdout(buf):
        out.explain()
    assert "_null_spread" not in buf.getvalue()
    assert out.count() == 10
