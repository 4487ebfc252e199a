"""Writers. All writes are idempotent overwrites (a retried task or a
re-run job gives the same files), and partitioned writes are rebalanced
first so one hot partition value is split over several tasks/files rather
than written by a single task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _rebalanced(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    # REBALANCE clusters rows by the partition columns; with AQE it splits
    # skewed values into advisory-sized pieces and merges tiny ones, so a
    # small value is one file and a huge value is several.
    return df.hint("rebalance", *cols)


def write_partitioned_parquet(
    df: DataFrame,
    path: str,
    col: str | Sequence[str] = "state",
    max_records_per_file: int | None = None,
) -> str:
    """Full (static) overwrite of a Parquet dataset partitioned by ``col``.
    ``max_records_per_file`` additionally caps file size (rows are never
    dropped; a writer rolls over to a new file)."""
    cols = [col] if isinstance(col, str) else list(col)
    w = _rebalanced(df, cols).write.mode("overwrite").partitionBy(*cols)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", int(max_records_per_file))
    w.parquet(path)
    return path


def files_per_partition(spark: SparkSession, path: str, col: str, fmt: str = "parquet") -> DataFrame:
    """(value, files, rows) of a partitioned dataset, on any filesystem. Only the
    partition column is declared, as a string ("01" stays "01"), so no data is read."""
    df = spark.read.format(fmt).schema(f"`{col}` string").load(path).select(col, "_metadata.file_path")
    return df.groupBy(col).agg(
        F.countDistinct("file_path").alias("n_files"),
        F.count(F.lit(1)).alias("n_rows"),
    )


def land_dated_json(df: DataFrame, root: str, parts: Sequence[str] = ("year", "month")) -> str:
    """NDJSON under k=v directories. Only the partitions present in ``df``
    are replaced (dynamic overwrite): re-landing a period keeps the others."""
    (
        _rebalanced(df, parts)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*parts)
        .json(root)
    )
    return root


def land_dated_lines(lines: DataFrame, root: str, parts: Sequence[str], col: str = "value") -> str:
    """Like ``land_dated_json`` for records that are JSON text already: they land as they came."""
    (
        _rebalanced(lines.select(F.col(col).alias("value"), *parts), parts)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*parts)
        .text(root)
    )
    return root


def period_path(root: str, parts: dict[str, str]) -> str:
    return "/".join([root.rstrip("/"), *(f"{k}={v}" for k, v in parts.items())])


def land_lines(lines: DataFrame, root: str, parts: dict[str, str], col: str = "value") -> str:
    """Records (JSON text, one a line) of one period, as they came, under its k=v
    folder. The parts are constants, so nothing is shuffled and only that folder
    is replaced."""
    path = period_path(root, parts)
    lines.select(F.col(col).alias("value")).write.mode("overwrite").text(path)
    return path


def land_period_json(df: DataFrame, root: str, parts: dict[str, str]) -> str:
    """Like ``land_lines`` for a table, written as NDJSON."""
    path = period_path(root, parts)
    df.write.mode("overwrite").json(path)
    return path


def _zone_lines(spark: SparkSession, root: str, parts: Sequence[str]) -> DataFrame:
    """A zone's lines as text, with its partition columns as strings."""
    schema = ", ".join(f"`{c}` string" for c in ("value", *parts))
    return spark.read.format("text").schema(schema).option("basePath", root).option("lineSep", "\n").load(root)


def _content(lines: DataFrame, parts: Sequence[str], side: str) -> DataFrame:
    """Rows and an order-free hash of the text of each partition."""
    named = [F.coalesce(F.col(p), F.lit("")).alias(p) for p in parts]
    return lines.groupBy(*named).agg(
        F.count(F.lit(1)).alias(f"{side}_rows"),
        F.sum(F.xxhash64("value").cast("decimal(38,0)")).alias(f"{side}_hash"),
    )


def publish_zone(spark: SparkSession, source_root: str, target_root: str, parts: Sequence[str]) -> DataFrame:
    """Copy a partitioned zone of text records to another root, line by line and
    without a shuffle, then compare each source partition's rows and content.

    Returns the partitions of the source with source_rows, target_rows and
    status (``uploaded`` or ``failed``). Partitions that only the target has
    (the source may have dropped older ones) are left as they are.
    """
    src = _zone_lines(spark, source_root, parts)
    (
        src.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("lineSep", "\n")
        .partitionBy(*parts)
        .text(target_root)
    )
    s = _content(src, parts, "source")
    t = _content(_zone_lines(spark, target_root, parts), parts, "target")
    same = F.col("source_rows").eqNullSafe(F.col("target_rows")) & F.col("source_hash").eqNullSafe(F.col("target_hash"))
    return s.join(t, list(parts), "left").select(
        *parts, "source_rows", F.coalesce("target_rows", F.lit(0)).alias("target_rows"), F.when(same, "uploaded").otherwise("failed").alias("status")
    )


def assert_published(report: DataFrame, sample: int = 20) -> DataFrame:
    """Fail when any source partition isn't in the target as it is. Only a bounded
    sample of the failed partitions is brought to the driver, for the message."""
    rows = report.filter(F.col("status") != "uploaded").limit(sample).collect()
    if rows:
        raise RuntimeError(f"{len(rows)}+ partition(s) not published intact, e.g. {[r.asDict() for r in rows[:3]]}")
    return report


def materialize(df: DataFrame, name: str, kind: str = "view", path: str | None = None) -> DataFrame:
    """view -> temp view (inlined by the optimizer); table -> written table
    (at ``path`` when given, e.g. the shared folder), returned as a scan."""
    spark = df.sparkSession
    if kind == "view":
        df.createOrReplaceTempView(name)
        return spark.table(name)
    w = df.write.mode("overwrite").format("parquet")
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)
    return spark.table(name)


def write_table(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as Parquet at ``path`` (overwrite) and return a scan of it.

    Cuts the lineage in the shared folder: later stages read the files
    instead of recomputing the plan, a lost executor re-reads files rather
    than re-running upstream stages, and the planner sees the real file
    size (so a small result is broadcast on a measured, not estimated, size).
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def preview(df: DataFrame, cols: Sequence[str], order: Sequence[str], n: int = 10) -> DataFrame:
    """First ``n`` rows of a projection in a fixed order (top-k plan)."""
    return df.select(*cols).orderBy(*[F.col(c).asc_nulls_last() for c in order]).limit(n)


def encode_json_lines(df: DataFrame, cols: Sequence[str], name: str = "line", keep: Sequence[str] = ()) -> DataFrame:
    """One JSON object per row (the NDJSON line of the record), next to the
    ``keep`` columns."""
    return df.select(*keep, F.to_json(F.struct(*cols)).alias(name))
