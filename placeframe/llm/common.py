"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from placeframe.session import fresh_dir, remove_scratch

#: Rows and bytes of one Arrow batch sent to a Python task; bounds its memory.
BATCH_ROWS = 2000
BATCH_BYTES = 32 << 20
#: Folders that ``stored`` wrote and nobody has removed yet.
_written: list[str] = []


def prepare(spark: SparkSession) -> SparkSession:
    """Bounds Arrow batches and makes the package importable in Python tasks."""
    for key, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        name = f"spark.sql.execution.arrow.{key}"
        now = spark.conf.get(name, None)
        digits = now[:-1] if now and now[-1:].lower() == "b" else now
        if not (digits and digits.isdigit() and 0 < int(digits) <= most):
            spark.conf.set(name, str(most))
    _ship(spark)
    return spark


def _ship(spark: SparkSession) -> None:
    """Adds the package to the session's Python files, once per context (as ``--py-files`` would)."""
    sc = spark.sparkContext
    if getattr(sc, "_placeframe_shipped", False):
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if os.path.isdir(top):  # not when the package itself came as a zip
        path = os.path.join(tempfile.mkdtemp(prefix="placeframe-py-"), "placeframe.zip")
        with zipfile.ZipFile(path, "w") as z:
            for folder, _, names in os.walk(top):
                for name in sorted(names):
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        z.write(full, os.path.relpath(full, os.path.dirname(top)))
        sc.addPyFile(path)
    sc._placeframe_shipped = True


def in_batches(
    df: DataFrame, function: Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]], schema: StructType | str
) -> DataFrame:
    """``mapInArrow`` with a function from one batch to some batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from function(batch)

    prepare(df.sparkSession)
    return df.mapInArrow(run, schema)


def stored(df: DataFrame, tag: str) -> DataFrame:
    """Writes ``df`` to a fresh folder under the shared ``spark.checkpoint.dir`` and
    reads it back: later steps neither repeat the work nor depend on executors."""
    path = fresh_dir(df.sparkSession, tag)
    _written.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settled(spark: SparkSession, make: Callable[[], DataFrame], tag: str) -> DataFrame:
    """``stored`` for what ``make`` returns; the tables that were stored on the way to
    it are removed once it is written (after an error they stay, for another look)."""
    mark = len(_written)
    result = stored(make(), tag)
    for path in _written[mark:-1]:
        remove_scratch(spark, path)
    _written[mark:] = _written[-1:]
    return result


def in_order(df: DataFrame, keys: Sequence[str], part: str, at: str) -> DataFrame:
    """``df`` sorted by ranges of its columns ``keys``, with the number of each row's
    range and its place there. Rows with equal keys may lie in several ranges, so no
    key makes a range large. To be written before the numbers are used twice."""
    dealt = [*(F.col(f"`{k}`") for k in keys), F.col("__salt")]
    return (
        df.withColumn("__salt", F.monotonically_increasing_id())
        .repartitionByRange(*dealt)
        .sortWithinPartitions(*dealt)
        .withColumn(part, F.spark_partition_id())
        .withColumn(at, F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1))
        .drop("__salt")
    )


def quoted(name: str) -> Column:
    """The column of that name, whatever signs are in it."""
    return F.col("`" + name.replace("`", "``") + "`")


def carried(docs: DataFrame, names: Sequence[str], **more: str) -> tuple[DataFrame, list[str], list[StructField]]:
    """The columns ``names`` under inner names, and ``more`` columns under the names given, so that no
    column of the input can clash with what an operator adds. Also the inner names and their fields."""
    inner = [f"__{i}" for i in range(len(names))]
    fields = [StructField(i, docs.schema[n].dataType) for i, n in zip(inner, names)]
    return docs.select(*(quoted(n).alias(i) for i, n in zip(inner, names)), *(quoted(c).alias(a) for a, c in more.items())), inner, fields


def remainder4(column: Column) -> Column:
    """crc32 of the id's decimal text modulo 4 (null ids: of the empty text)."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % 4


def held_out(column: Column) -> Column:
    return remainder4(column) == 2


def ranges(sizes: Iterable[int], most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive items of about ``most`` in size together (one item at least)."""
    low = high = size = 0
    for high, n in enumerate(sizes):  # noqa: B007
        if size and size + n > most:
            yield low, high
            low, size = high, 0
        size += n
    else:
        high += 1
    if size or low < high:
        yield low, high


def text_batches(texts: Sequence[str | None], most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of about ``most`` characters (one at least)."""
    return ranges((len(t) if t else 0 for t in texts), most) if len(texts) else iter(())


#: Links of a node that meet in one group when labels are passed on; a node with more has several groups.
HUB_LINKS = 256


def connected(edges: DataFrame, a: str, b: str, tag: str, most_rounds: int = 60) -> DataFrame:
    """(node, root) of the graph's connected components; root is the smallest node.

    Each round every node takes the smallest label among its own and its
    neighbours' ones and then the label of that label (pointer jumping), so
    the rounds grow with the logarithm of a component's width. A node with very
    many links is no hot spot: its links are dealt over groups of ``HUB_LINKS`` and its
    label goes to each group, and the labels that come back to it are combined by
    ``min`` in the tasks before the shuffle. Each round is written to the shared folder.
    """
    links = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v")
    both = stored(links.union(links.select("v", "u")).distinct(), f"{tag}-links")
    label = both.groupBy(F.col("u").alias("node")).agg(F.least(F.min("v"), F.col("u")).alias("root"))
    if both.isEmpty():
        return label
    hubs = both.groupBy(F.col("v").alias("hub")).agg(F.ceil(F.count(F.lit(1)) / HUB_LINKS).cast("int").alias("groups")).filter("groups > 1")
    hubs = stored(hubs, f"{tag}-hubs")
    dealt = both.join(hubs, F.col("v") == F.col("hub"), "left").select("u", "v", F.coalesce(F.pmod(F.xxhash64("u"), F.col("groups")), F.lit(0)).cast("int").alias("g"))
    dealt = stored(dealt, f"{tag}-dealt")
    for i in range(1, most_rounds + 1):
        group = F.explode(F.sequence(F.lit(0), F.coalesce("groups", F.lit(1)) - 1))
        given = label.join(hubs, F.col("node") == F.col("hub"), "left").select(F.col("node").alias("v"), group.alias("g"), F.col("root").alias("there"))
        near = dealt.join(given, ["v", "g"]).groupBy(F.col("u").alias("node")).agg(F.min("there").alias("there"))
        step = stored(label.join(near, "node").select("node", "root", F.least("root", "there").alias("next")), f"{tag}-step-{i}")
        # many nodes have one label: its own label, looked up once, is broadcast, or the nodes are split among tasks
        jump = label.select(F.col("node").alias("next"), F.col("root").alias("far"))
        jump = stored(step.select("next").distinct().join(jump, "next"), f"{tag}-jump-{i}")
        least = F.least("next", F.coalesce("far", "next"))
        new = stored(step.join(jump, "next", "left").select("node", least.alias("root"), (least < F.col("root")).alias("moved")), f"{tag}-{i}")
        label = new.select("node", "root")
        if new.filter("moved").isEmpty():
            return label
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
