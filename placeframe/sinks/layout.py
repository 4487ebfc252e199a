"""Writes with a layout that follows from the rows: every partition value has
``ceil(rows / rows_per_file)`` files, and the writer keeps a record of them.

Rows are numbered within their partition value by counts of the tasks that
hold them (no window over a value's rows), and a value's files are dealt over
the tasks, so a value with a third of all rows is written by many tasks. The
record (``_layout``, a folder that scans don't see) has rows, files and, for
text, bytes of each value as the writer counted them, before any listing; it is
laid out as the data, so that landing some periods again replaces their part of it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from placeframe.functions.columns import object_key
from placeframe.session import _folder, fresh_dir, remove_scratch
from placeframe.sinks.writers import write_table
from placeframe.sources.readers import _listing

RECORD = "_layout"
_COUNTED = [StructField(c, LongType()) for c in ("n_rows", "n_files", "n_bytes")]
_PLACE = (1 << 33) - 1  # bits of a row's place in monotonically_increasing_id


def numbered_in_values(df: DataFrame, parts: Sequence[str], scratch: str) -> tuple[DataFrame, DataFrame]:
    """(rows, counts): the rows with ``__n``, their number from 0 within their value of ``parts``, and
    the rows (and for a ``value`` column the bytes) of each value. The rows are written to
    ``scratch`` once, sorted in their tasks, so that their numbers cannot change."""
    by = [f"__g{i}" for i in range(len(parts))]
    placed = write_table(
        df.withColumns({g: F.coalesce(F.col(f"`{p}`").cast("string"), F.lit("")) for g, p in zip(by, parts)})
        .sortWithinPartitions(*by)
        .withColumns({"__part": F.spark_partition_id(), "__at": F.monotonically_increasing_id().bitwiseAND(_PLACE)}),
        f"{scratch}/placed",
    )
    size = F.sum(F.coalesce(F.octet_length("value"), F.lit(0)) + 1) if "value" in df.columns else F.lit(None)
    held = placed.groupBy("__part", *by).agg(F.count(F.lit(1)).alias("__rows"), F.min("__at").alias("__first"), size.cast("long").alias("__bytes"))
    held = write_table(held, f"{scratch}/held")
    before = Window.partitionBy(*by).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = write_table(
        held.select("__part", *by, (F.coalesce(F.sum("__rows").over(before), F.lit(0)) - F.col("__first")).alias("__offset")), f"{scratch}/offsets"
    )
    rows = placed.join(offsets, ["__part", *by]).withColumn("__n", F.col("__at") + F.col("__offset")).drop("__part", "__at", "__offset", *by)
    counts = held.groupBy(*by).agg(F.sum("__rows").alias("n_rows"), F.sum("__bytes").alias("n_bytes"))
    return rows, counts.withColumnsRenamed(dict(zip(by, parts)))


def write_fixed_layout(
    df: DataFrame,
    path: str,
    parts: str | Sequence[str],
    rows_per_file: int | None = None,
    fmt: str = "parquet",
    replace_values_only: bool = False,
) -> DataFrame:
    """Writes ``df`` by ``parts`` with ``ceil(rows / rows_per_file)`` files for each value,
    or one file for each value if ``rows_per_file`` is None (then one task writes a
    value: for values of a known, modest size). Null and "" are one value, as
    their folder is one. ``replace_values_only`` keeps the values that ``df`` doesn't
    have. ``fmt`` "text" takes the column ``value``. Returns the record: parts,
    n_rows, n_files, n_bytes (null unless text)."""
    if rows_per_file is not None and rows_per_file < 1:
        raise ValueError("rows_per_file must be 1 at least")
    spark, parts = df.sparkSession, [parts] if isinstance(parts, str) else list(parts)
    if fmt == "text":
        df = df.select(F.col("value"), *parts)
    one = df.withColumns({p: F.when(F.col(f"`{p}`") != "", F.col(f"`{p}`")) for p in parts if isinstance(df.schema[p].dataType, StringType)})
    scratch = fresh_dir(spark, "layout")
    rows, counts = numbered_in_values(one, parts, scratch)
    per_file = F.col("n_rows") if rows_per_file is None else F.lit(rows_per_file)
    counts = counts.withColumns({p: F.when(F.col(p) != "", F.col(p)) for p in parts})
    record = counts.select(*parts, "n_rows", F.ceil(F.col("n_rows") / per_file).cast("long").alias("n_files"), "n_bytes")
    file = F.lit(0) if rows_per_file is None else F.floor(F.col("__n") / rows_per_file)
    dealt = rows.withColumn("__file", file).repartition(*parts, "__file").sortWithinPartitions(*parts, "__file").drop("__n", "__file")

    def write(df: DataFrame, kind: str, to: str, most: int | None = None) -> None:
        w = df.write.mode("overwrite").partitionBy(*parts)
        if replace_values_only:
            w = w.option("partitionOverwriteMode", "dynamic")
        # a task's files of one value are full ones and at most one rest, in any order
        w.option("maxRecordsPerFile", most or 0).format(kind).save(to)

    write(dealt, fmt, path, rows_per_file)
    write(record.coalesce(1), "parquet", f"{path.rstrip('/')}/{RECORD}")
    remove_scratch(spark, scratch)
    return layout_record(spark, path, parts)


def layout_record(spark: SparkSession, path: str, parts: str | Sequence[str]) -> DataFrame:
    """What the writer counted: parts (strings), n_rows, n_files, n_bytes."""
    parts = [parts] if isinstance(parts, str) else list(parts)
    where = f"{path.rstrip('/')}/{RECORD}"
    schema = StructType([*_COUNTED, *(StructField(p, StringType()) for p in parts)])
    fs, folder = _folder(spark, where)
    if not fs.exists(folder):
        return spark.createDataFrame([], schema).select(*parts, *(f.name for f in _COUNTED))
    return spark.read.schema(schema).option("basePath", where).parquet(where).select(*parts, *(f.name for f in _COUNTED))


def part_value(key: str, part: str):
    """The value of a partition column in an object key ("year=2024/..."), unescaped; null for the null folder."""
    raw = F.regexp_extract(F.col(key), rf"(?:^|/){part}=([^/]*)/", 1)
    text = F.coalesce(F.try_url_decode(F.replace(raw, F.lit("+"), F.lit("%2B"))), raw)
    return F.when((raw != "") & (raw != "__HIVE_DEFAULT_PARTITION__"), text)


def listed_layout(spark: SparkSession, path: str, parts: str | Sequence[str], pattern: str = "part-*") -> DataFrame:
    """What a listing of the folder shows: parts, listed_files, listed_bytes. No file is opened."""
    parts = [parts] if isinstance(parts, str) else list(parts)
    files = _listing(spark, path, pattern).select(object_key("path", path).alias("key"), "length")
    return files.groupBy(*[part_value("key", p).alias(p) for p in parts]).agg(F.count(F.lit(1)).alias("listed_files"), F.sum("length").alias("listed_bytes"))


def layout_report(spark: SparkSession, path: str, parts: str | Sequence[str]) -> DataFrame:
    """The record beside the listing: parts, n_rows, n_files, n_bytes, listed_files, listed_bytes and
    status: ``intact``, ``differs``, ``lost`` (recorded, not listed) or ``unrecorded``."""
    parts = [parts] if isinstance(parts, str) else list(parts)
    r, n = layout_record(spark, path, parts).alias("r"), listed_layout(spark, path, parts).alias("n")
    on = [F.col(f"r.{p}").eqNullSafe(F.col(f"n.{p}")) for p in parts]
    both = r.join(n, on, "full_outer")
    same = (F.col("n_files") == F.col("listed_files")) & (F.col("n_bytes").isNull() | (F.col("n_bytes") == F.col("listed_bytes")))
    status = F.when(F.col("listed_files").isNull(), "lost").when(F.col("n_files").isNull(), "unrecorded").when(same, "intact").otherwise("differs")
    return both.select(*[F.coalesce(f"r.{p}", f"n.{p}").alias(p) for p in parts], "n_rows", "n_files", "n_bytes", "listed_files", "listed_bytes", status.alias("status"))
