"""Global row numbers without bringing all rows, or all rows of a group, to one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from placeframe.llm.common import stored

#: Offsets (one for each partition and group in it) up to which they are broadcast.
BROADCAST_ROWS = 200_000


def numbered(df: DataFrame, order: Sequence[str], tag: str, group: Sequence[str] = (), out: str = "__n") -> DataFrame:
    """``df`` with each row's number from 0 in the order of the columns ``order``
    (within its ``group``, whose columns then lead the order).

    Rows are dealt by ranges of the order and sorted in their partitions; a row's
    number is its place there plus the rows of earlier partitions. The sorted rows
    are written once, so the places cannot change between the two uses. Rows that
    tie in ``order`` go by a hash of all their columns; equal rows may be split
    between partitions, as any order of them gives the same result.
    """
    names = df.columns
    keys = [*group, *(c for c in order if c not in group), "__tie", "__salt"]
    every = [F.col(f"`{c}`") for c in names]
    spread = df.withColumn("__tie", F.xxhash64(*every)).withColumn("__salt", F.monotonically_increasing_id())
    low = (1 << 33) - 1  # the place within the partition
    placed = stored(
        spread.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("__part", F.spark_partition_id())
        .withColumn("__at", F.monotonically_increasing_id().bitwiseAND(low))
        .drop("__tie", "__salt"),
        f"{tag}-sorted",
    )
    same = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in group]
    by = [f"__g{i}" for i in range(len(group))]
    placed = placed.select("*", *(c.alias(n) for c, n in zip(same, by)))
    counts = placed.groupBy("__part", *by).agg(F.count(F.lit(1)).alias("__rows"), F.min("__at").alias("__first"))
    earlier = Window.partitionBy(*by).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stored(
        counts.select("__part", *by, (F.coalesce(F.sum("__rows").over(earlier), F.lit(0)) - F.col("__first")).alias("__offset")), f"{tag}-offsets"
    )
    if offsets.count() <= BROADCAST_ROWS:
        offsets = F.broadcast(offsets)
    return placed.join(offsets, ["__part", *by]).select(*every, (F.col("__at") + F.col("__offset")).alias(out))
