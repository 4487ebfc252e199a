"""Mixing sources to target weights by Pfair scheduling.

A source's documents, in the order of their ids, form blocks. With a share
``w`` (its weight over all weights) the source's block ``j`` (from 0) may be
placed from slot ``floor(j / w)`` on (its release) and before slot ``ceil((j +
1) / w)`` (its deadline). In each slot the released block with the earliest
deadline is placed, so at every slot each source has had its share of the
slots to within less than one block. As the weights are integers, the
schedule repeats after as many slots as they sum to: one period is scheduled
and a block's slot in any period is computed from it. All the documents' work
is DataFrame expressions.

No document is left out: the mixture goes on until every block has been placed
once. A source that runs out before begins again (its next epoch), as its
weight asks for more documents than it has. Without given weights a source's
weight grows as its number of blocks to the power ``FLATTEN``, and the period is
as long as the smallest source needs for one slot in it: a source of one block
beside a million is placed about as often as its real share says, not once in
each short period. A period has at least ``PERIOD`` slots and is not lengthened
beyond ``MOST_SLOTS``: a source with a share below one in so many slots still gets
one. Two bounds are checked and raise: ``MOST_SOURCES`` sources (they are counted
on the driver), and twice ``MOST_SLOTS`` for the sum of given weights, after
division by what is common to all.

Edge cases: a null source counts as the empty one; null ids come first, ties
in the id go by a hash of the row and equal rows are interchangeable; a
source without a given weight is an error, one without documents is left out;
a source's last block may be shorter; an empty table gives an empty table.
"""

from __future__ import annotations

import heapq
import json
import math
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from placeframe.llm.common import stored
from placeframe.llm.numbering import BROADCAST_ROWS, numbered

BLOCK = 16
FLATTEN = 0.9
#: Least slots of a period when the weights are derived (more, if there are very many or very small sources).
PERIOD = 1000
#: A period isn't made longer than this for the sake of small sources.
MOST_SLOTS = 1 << 20
#: Sources that a mixture may have.
MOST_SOURCES = 10_000


def small_table(spark: SparkSession, rows: Sequence[dict], schema: str) -> DataFrame:
    """A bounded table from the driver, as a literal."""
    kind = StructType.fromDDL(schema)
    return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), f"array<{kind.simpleString()}>")))


def derived_weights(sizes: dict[str, int], flatten: float = FLATTEN, period: int = PERIOD, block: int = BLOCK) -> dict[str, int]:
    """Integer weights of at least 1 that grow as the sizes, counted in blocks, to a power."""
    wanted = {s: (-(-n // block)) ** flatten for s, n in sizes.items()}
    total, least = sum(wanted.values()), min(wanted.values(), default=1)
    period = max(period, 20 * len(sizes), min(MOST_SLOTS, math.ceil(total / least)))
    return {s: max(1, round(period * w / total)) for s, w in wanted.items()}


def period_schedule(weights: Sequence[int]) -> Iterator[tuple[int, int, int, int, int]]:
    """(source, block, slot, release, deadline) of one period: as many slots as the
    weights sum to, in each the released block with the earliest deadline (ties: the first source)."""
    period = sum(weights)
    waiting = [(0, i, 0) for i, w in enumerate(weights) if w]  # (release, source, block)
    ready: list[tuple[int, int, int, int]] = []  # (deadline, source, block, release)
    heapq.heapify(waiting)
    for slot in range(period):
        while waiting and waiting[0][0] <= slot:
            release, i, j = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(j + 1) * period // weights[i]), i, j, release))
        deadline, i, j, release = heapq.heappop(ready)
        yield i, j, slot, release, deadline
        if j + 1 < weights[i]:
            heapq.heappush(waiting, ((j + 1) * period // weights[i], i, j + 1))


def mix_sources(
    docs: DataFrame,
    weights: dict[str, int] | None = None,
    block: int = BLOCK,
    source: str = "source",
    key: str = "doc_id",
    tag: str = "mix",
) -> DataFrame:
    """``docs`` with ``__slot`` (the block's place in the mixture), ``__place`` (the
    document's in its block), ``__block``, ``__epoch``, ``__release`` and ``__deadline``.
    Sorting by slot and place gives the mixture."""
    spark = docs.sparkSession
    names = docs.columns
    named = docs.withColumn("__source", F.coalesce(F.col(f"`{source}`").cast("string"), F.lit("")))
    rows = numbered(named, [key], tag, group=["__source"])
    counted = rows.groupBy("__source").agg(F.count(F.lit(1)).alias("n")).limit(MOST_SOURCES + 1).collect()
    if len(counted) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    sizes = {r["__source"]: r["n"] for r in counted}
    weights = derived_weights(sizes, block=block) if weights is None else {s: weights[s] for s in sizes}
    if any(int(w) != w or w < 1 for w in weights.values()):
        raise ValueError("weights must be positive integers")
    common = math.gcd(*map(int, weights.values()))
    if weights and sum(weights.values()) // common > 2 * MOST_SLOTS:
        raise ValueError(f"weights sum to more than {2 * MOST_SLOTS}")
    order = sorted(sizes)
    slots: list[list[int]] = [[] for _ in order]
    for i, _, slot, _, _ in period_schedule([int(weights[s]) // common for s in order]):
        slots[i].append(slot)
    period = sum(map(len, slots))
    blocks = [-(-sizes[s] // block) for s in order]
    slot_of = lambda i, j: j // len(slots[i]) * period + slots[i][j % len(slots[i])]
    end = max((slot_of(i, b - 1) for i, b in enumerate(blocks)), default=-1) + 1
    given = [end // period * len(s) + sum(x < end % period for x in s) for s in slots]  # blocks placed before the end
    sources = small_table(
        spark,
        [{"__source": s, "__blocks": blocks[i], "__weight": len(slots[i]), "__given": given[i]} for i, s in enumerate(order)],
        "__source string, __blocks long, __weight long, __given long",
    )
    plan = small_table(spark, [{"__source": s, "__slots": slots[i]} for i, s in enumerate(order)], "__source string, __slots array<long>")
    plan = plan.select("__source", F.posexplode("__slots").alias("__turn", "__in"))
    if period > BROADCAST_ROWS:
        plan = stored(plan, f"{tag}-period")
    else:
        plan = F.broadcast(plan)
    block_no = F.expr(f"__n div {block}")
    epochs = F.expr("sequence(0L, (__given - 1 - __block) div __blocks)")
    placed = (
        rows.join(F.broadcast(sources), "__source")  # MOST_SOURCES rows at most
        .withColumn("__block", block_no)
        .withColumn("__epoch", F.explode(epochs))
        .withColumn("__j", F.col("__block") + F.col("__epoch") * F.col("__blocks"))
        .withColumn("__turn", F.col("__j") % F.col("__weight"))
        .join(plan, ["__source", "__turn"])  # a row for each slot of the period
    )
    shift = F.expr(f"__j div __weight * {period}")
    return placed.select(
        *(F.col(f"`{c}`") for c in names),
        (shift + F.col("__in")).alias("__slot"),
        (F.col("__n") % block).cast("int").alias("__place"),
        "__block",
        "__epoch",
        (shift + F.expr(f"__turn * {period} div __weight")).alias("__release"),
        (shift + F.expr(f"((__turn + 1) * {period} + __weight - 1) div __weight")).alias("__deadline"),
    )


def mixed(docs: DataFrame, weights: dict[str, int] | None = None, block: int = BLOCK, source: str = "source", key: str = "doc_id") -> DataFrame:
    """The mixture itself: ``docs``' columns, a row for each time that a document is
    placed, dealt by ranges of the mixture's order and sorted in it."""
    names = docs.columns
    placed = mix_sources(docs, weights, block, source, key)
    order = ["__slot", "__place", F.xxhash64(*(F.col(f"`{c}`") for c in names))]
    return placed.repartitionByRange(*order).sortWithinPartitions(*order).select(*(F.col(f"`{c}`") for c in names))
