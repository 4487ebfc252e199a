"""Readers. Every reader takes an explicit schema: no inference pass, stable
types, string partition values, and only the declared nested fields."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from placeframe.functions.columns import object_key, strip_text
from placeframe.schemas import RAW_LOCATION, RAW_WEATHER, with_string_parts
from placeframe.session import folder_names


def read_ndjson(spark: SparkSession, path: str | list[str], schema: StructType, base_path: str | None = None) -> DataFrame:
    """Typed NDJSON scan. Malformed lines become all-null rows (PERMISSIVE);
    blank lines are skipped. Uncompressed NDJSON splits across tasks."""
    r = spark.read.schema(schema)
    if base_path:
        r = r.option("basePath", base_path)
    return r.json(path)


def read_locations(spark: SparkSession, path: str | list[str], base_path: str | None = None) -> DataFrame:
    return read_ndjson(spark, path, RAW_LOCATION, base_path)


def read_weather(spark: SparkSession, path: str | list[str], base_path: str | None = None) -> DataFrame:
    """Nested weather records. Only the four daily arrays are declared, so
    unknown fields are never materialised and an all-empty ``weather`` block
    still resolves."""
    return read_ndjson(spark, path, RAW_WEATHER, base_path)


def decode_json_lines(lines: DataFrame, schema: StructType, col: str = "value", fail_fast: bool = True) -> DataFrame:
    """Text lines -> records: strip white space of every kind, skip blank lines,
    decode each line. With ``fail_fast`` a malformed line fails the job instead of becoming null."""
    opts = {"mode": "FAILFAST"} if fail_fast else {}
    text = strip_text(col)
    return lines.filter(text != F.lit("")).select(F.from_json(text, schema, opts).alias("_r")).select("_r.*")


def read_json_lines(spark: SparkSession, path: str, schema: StructType, fail_fast: bool = True) -> DataFrame:
    return decode_json_lines(spark.read.text(path), schema, fail_fast=fail_fast)


def read_partitioned(
    spark: SparkSession,
    root: str,
    schema: StructType,
    parts: Sequence[str],
    fmt: str = "parquet",
) -> DataFrame:
    """Hive-layout scan (``k=v`` directories). Partition columns are declared
    as strings so "01" stays "01" and "" reads back as null. Filters on them
    prune directories."""
    return (
        spark.read.format(fmt)
        .schema(with_string_parts(schema, parts))
        .option("basePath", root)
        .load(root)
    )


def latest_snapshot(df: DataFrame, parts: Sequence[str]) -> DataFrame:
    """Rows of the greatest (parts...) tuple of any DataFrame. The maximum is
    a scalar subquery (no join, no driver loop), and the filter then prunes
    partitions at run time. On a file zone the subquery still reads every
    file to learn which partitions hold rows; use ``read_latest_partition``
    there, which decides from the listing alone."""
    key = F.struct(*parts)
    latest = df.select(F.max(key)).scalar()
    return df.filter(key == latest)


def _listing(spark: SparkSession, root: str, pattern: str | None = None) -> DataFrame:
    """Files under ``root`` (any depth) as rows, without opening them.

    The binaryFile scan is split by file bytes (one task per 128 MB of a
    100 TB zone would be ~10^6 tasks that each emit a few paths); coalescing
    right after the scan runs it in about one task per core, each covering
    many files, with no shuffle."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern:
        r = r.option("pathGlobFilter", pattern)
    return r.load(root).select("path", "length", "modificationTime").coalesce(_cores(spark))


def _cores(spark: SparkSession) -> int:
    try:
        return max(1, spark.sparkContext.defaultParallelism)
    except Exception:  # noqa: BLE001 - no context handle (e.g. Spark Connect)
        try:
            return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
        except (TypeError, ValueError):
            return 200


def _latest_folder(spark: SparkSession, path: str, parts: list[str]) -> str | None:
    """``k=v/...`` of the greatest folder below ``path`` that has all the levels."""
    if not parts:
        return ""
    prefix = f"{parts[0]}="
    for name in sorted((n for n in folder_names(spark, path) if n.startswith(prefix) and n != prefix), reverse=True):
        below = _latest_folder(spark, f"{path}/{name}", parts[1:])
        if below is not None:
            return f"{name}/{below}".rstrip("/")
    return None


def read_latest_partition(
    spark: SparkSession,
    root: str,
    schema: StructType,
    parts: Sequence[str],
    fmt: str = "json",
) -> DataFrame:
    """Read only the greatest (parts...) directory of a Hive-layout zone.

    The directory is found level by level (the greatest ``year=``, in it the
    greatest ``month=``, ...), so the driver lists a few folders, never the
    zone's files. Comparison is on the string values (zero-padded parts); a
    folder without the next level is passed over. Only that directory is then
    scanned.
    """
    sub = _latest_folder(spark, root.rstrip("/"), list(parts))
    if sub is None:
        raise FileNotFoundError(f"no partitions under {root}")
    return (
        spark.read.format(fmt)
        .schema(with_string_parts(schema, parts))
        .option("basePath", root)
        .load(f"{root.rstrip('/')}/{sub}")
    )


def create_external_json_table(
    spark: SparkSession,
    database: str,
    table: str,
    schema: StructType,
    location: str,
    database_location: str | None = None,
) -> DataFrame:
    """CREATE DATABASE IF NOT EXISTS (at ``database_location`` when given,
    e.g. in the shared folder rather than a local warehouse), then an
    external JSON table over ``location`` with a declared schema (created
    only if absent). The table goes through the catalog API, so its path
    needs no SQL quoting."""
    name = f"{database}.{table}"
    if not spark.catalog.databaseExists(database):
        where = ""
        if database_location:
            escaped = database_location.replace("\\", "\\\\").replace("'", "\\'")
            where = f" LOCATION '{escaped}'"
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{where}")
    if not spark.catalog.tableExists(name):
        spark.catalog.createTable(name, path=location, source="json", schema=schema)
    return spark.table(name)


def page_record_lines(pages: DataFrame, page_col: str = "page", body_col: str = "body") -> DataFrame:
    """(page, value): every record of landed page bodies (JSON arrays) as its JSON
    text, whole, so that fields no schema declares are kept.

    Pages are read in ascending order until the first empty page (an array
    without records); that page and everything after it are ignored. A body
    before it that is null, truncated or no array fails the job: it must not
    pass for the end of the feed. The stop page is a scalar subquery that only
    measures array lengths; each page is then cut into records independently,
    so no page order is materialised in one task.
    """
    length = F.json_array_length(F.col(body_col))
    stop = pages.filter(length == 0).select(F.min(page_col)).scalar()
    kept = pages.filter(stop.isNull() | (F.col(page_col) < stop))
    broken = F.raise_error(F.concat(F.lit("page "), F.coalesce(F.col(page_col).cast("string"), F.lit("null")), F.lit(" holds no JSON array")))
    body = F.when(length.isNull(), broken.cast("string")).otherwise(F.col(body_col))
    lines = F.from_json(body, "array<string>", {"mode": "FAILFAST"})
    return kept.select(F.col(page_col).alias("page"), F.explode(lines).alias("value"))


def staged_page_lines(pages: DataFrame, path: str, page_col: str = "page", body_col: str = "body") -> DataFrame:
    """``page_record_lines`` in one pass over the pages: they are cut into records at
    once and written to ``path`` (a scratch folder), with a mark for each page that ends the feed
    or holds no array. The end is then the least mark of its kind, from two narrow columns,
    and only records before it are read back; a bad page before it fails the job.
    For bodies that are dear to read or to make; records after the end are written too.
    """
    length = F.json_array_length(F.col(body_col))
    lines = F.from_json(F.col(body_col), "array<string>")
    kind = F.when(length.isNull() | lines.isNull(), "bad").when(length == 0, "end").otherwise("record")
    marked = pages.select(F.col(page_col).alias("page"), kind.alias("kind"), F.when(length > 0, lines).alias("lines"))
    staged = marked.select("page", "kind", F.explode_outer("lines").alias("value"))
    staged.write.mode("overwrite").parquet(path)
    staged = pages.sparkSession.read.schema(staged.schema).parquet(path)
    stop = staged.filter("kind = 'end'").select(F.min("page")).scalar()
    kept = staged.filter((F.col("kind") != "end") & (stop.isNull() | (F.col("page") < stop)))
    bad = F.raise_error(F.concat(F.lit("page "), F.coalesce(F.col("page").cast("string"), F.lit("null")), F.lit(" holds no JSON array")))
    return kept.select("page", F.when(F.col("kind") == "bad", bad.cast("string")).otherwise(F.col("value")).alias("value"))


def paged_records(pages: DataFrame, record_schema: StructType, page_col: str = "page", body_col: str = "body") -> DataFrame:
    """Landed page bodies as typed records (see ``page_record_lines`` for where the
    feed ends); a record that doesn't fit the schema fails the job."""
    lines = page_record_lines(pages, page_col, body_col)
    return lines.select("page", F.from_json("value", record_schema, {"mode": "FAILFAST"}).alias("_r")).select("page", "_r.*")


def file_manifest(spark: SparkSession, root: str, pattern: str = "*.{json,txt}") -> DataFrame:
    """Files under ``root`` matching ``pattern`` at any depth: a listing without
    file contents (the binaryFile source reads none unless asked), with the
    object key relative to the root, zones kept (``\\`` normalised to ``/``).
    The driver holds the listing, as for any scan.
    Returns (file_path, key, file_size, modified)."""
    df = _listing(spark, root, pattern).select(
        F.col("path").alias("file_path"),
        F.col("length").alias("file_size"),
        F.col("modificationTime").alias("modified"),
    )
    return df.select("file_path", object_key("file_path", root).alias("key"), "file_size", "modified")
