"""Mixing sources to target weights by Pfair scheduling of their blocks."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterable, Iterator, Mapping
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from changeflow.llm.common import ready as prepare
from changeflow.session import written

BLOCK_ROWS = 100
POWER = 0.8  # default weights: the power of a source's row count
PIECE = 1 << 16  # slots of the schedule that are held at once


def whole(weights: list[Fraction]) -> list[int]:
    """Whole numbers in exactly the same proportions."""
    scale = math.lcm(*(w.denominator for w in weights))
    numbers = [int(w * scale) for w in weights]
    shared = math.gcd(*numbers)
    return [n // shared for n in numbers]


def schedule(weights: list[Fraction], blocks: list[int]) -> Iterator[tuple[int, int, int, int]]:
    """(source, turn, release, deadline) of slot after slot, earliest deadline first.

    A source of share w has its k-th turn between the slots floor(k / w), its release,
    and ceil((k + 1) / w), its deadline; both are taken from the exact weights. As the
    shares add up to one, each slot has a turn that is released and no deadline is
    missed: after t slots a source has run between w * t - 1 and w * t + 1 blocks, both
    ends left out, however long the schedule is. It ends when every source has run as
    many turns as it has blocks. Two heaps of one entry a source are all it holds.
    """
    shares = whole(weights)
    total = sum(shares)
    ran = [0] * len(shares)
    short = sum(n > 0 for n in blocks)
    waiting = [(0, i) for i in range(len(shares))]
    released: list[tuple[int, int, int]] = []
    slot = 0
    while short:
        while waiting and waiting[0][0] <= slot:
            start, i = heapq.heappop(waiting)
            heapq.heappush(released, (-(-(ran[i] + 1) * total // shares[i]), i, start))
        end, i, start = heapq.heappop(released)
        yield i, ran[i], start, end
        ran[i] += 1
        short -= ran[i] == blocks[i]
        heapq.heappush(waiting, (ran[i] * total // shares[i], i))
        slot += 1


def exact_weights(counts: Mapping[str | None, int],
                  weights: Mapping[str | None, float] | None) -> list[Fraction]:
    """The weight of each counted source; see ``mix`` for sources that are not named."""
    given = {n: Fraction(w) for n, w in (weights or {}).items() if n in counts}
    own = {n: Fraction(counts[n] ** POWER) for n in counts}
    scale = sum(given.values()) / sum(own[n] for n in given) if given else 1
    return [given.get(n, own[n] * scale) for n in counts]


def mix(spark: SparkSession, docs: DataFrame, weights: Mapping[str | None, float] | None = None,
        source: str = "source", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The mix as rows (row, epoch, block, release, deadline, slot).

    ``row`` is a row of ``docs``. A source's rows, in the order of a hash, are cut
    into blocks of about ``block_rows`` that differ by one row at most. The mix
    is a row of slots, each filled with one block: after any number of slots, a
    source's blocks are less than one away from its share. It ends when every
    block has run once; sources that are through by then start over, which
    ``epoch`` counts. So no row is left out, and the whole mix has the target
    shares, one block more or less.

    ``weights`` are shares of any sum for the sources named; without them, and
    for sources they do not name, the weight is the row count to the power
    ``POWER`` (not named: scaled so that the named ones keep their sum's part).
    No weight is rounded, however small; weights that are not above zero are refused.
    Sources without rows take no slots. Null is a source of its own. Repeated rows are
    rows of their own; texts are moved, not read, however long. Columns keep their
    names inside ``row``, so none can clash. Ties of deadlines go to the source whose
    name sorts first, null last. An empty table gives no rows.

    The slots follow from each other, so one task makes them, a slot for each block of
    the mix, from one count a source; it holds ``PIECE`` of them at once and writes them
    to the shared folder, where rows are joined with them by source and block. Nothing
    of it passes through the driver.
    """
    if any(w <= 0 for w in (weights or {}).values()):
        raise ValueError("weights must be above zero")
    prepare(spark)
    packed = docs.select(F.struct("*").alias("row"), F.col(source).cast("string").alias("source"),
                         F.xxhash64(*docs.columns).alias("order"))
    # One sort; a row's number in its source follows from its place in the sorted table.
    placed = written(packed.repartitionByRange("source", "order")
                     .sortWithinPartitions("source", "order")
                     .withColumn("place", F.monotonically_increasing_id()), "mix")
    part = F.shiftright("place", 33)
    parts = placed.groupBy("source", part.alias("part")).agg(
        F.count(F.lit(1)).alias("rows"), F.min("place").alias("first"))
    of_source = Window.partitionBy("source")
    before = of_source.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # A row for each source and partition that has some of it.
    starts = written(parts.select(
        "source", "part", "first", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("before"),
        F.sum("rows").over(of_source).alias("rows"))
        .withColumn("blocks", F.expr(f"(rows + {block_rows - 1}) DIV {block_rows}")), "starts")
    slots = written(_slots(starts.select("source", "rows", "blocks").distinct(), weights), "slots")
    ranked = placed.alias("d").join(
        starts.alias("r"), (F.shiftright("d.place", 33) == F.col("r.part"))
        & F.col("d.source").eqNullSafe(F.col("r.source"))) \
        .select("row", "d.source", "order", F.expr(
            "(place - first + before) * blocks DIV rows").alias("block"))
    return ranked.alias("t").join(
        slots.alias("s"), F.col("t.source").eqNullSafe(F.col("s.source"))
        & (F.col("t.block") == F.col("s.block"))).select(
        "row", "order", "epoch", "t.block", "release", "deadline", "slot")


def _slots(sources: DataFrame, weights: Mapping[str | None, float] | None) -> DataFrame:
    """(source, block, epoch, release, deadline, slot) of the whole mix."""
    names = ["source", "block", "epoch", "release", "deadline", "slot"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [row for batch in batches for row in batch.to_pylist()]
        found.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
        counts = {r["source"]: r["rows"] for r in found}
        blocks = [r["blocks"] for r in found]
        known = pa.array(list(counts), pa.string())
        held: list[tuple] = []

        def piece(first: int) -> pa.RecordBatch:
            at, turn, release, deadline = zip(*held)
            return pa.RecordBatch.from_arrays([
                known.take(pa.array(at)), pa.array([t % blocks[i] for i, t in zip(at, turn)]),
                pa.array([t // blocks[i] for i, t in zip(at, turn)]), pa.array(release),
                pa.array(deadline), pa.array(range(first, first + len(held)), pa.int64())], names)

        first = 0
        for slot in schedule(exact_weights(counts, weights), blocks) if counts else ():
            held.append(slot)
            if len(held) == PIECE:
                yield piece(first)
                first, held = first + PIECE, []
        if held:
            yield piece(first)

    return sources.repartition(1).mapInArrow(
        run, "source string, block bigint, epoch bigint, release bigint, deadline bigint, slot bigint")


def mixed(spark: SparkSession, docs: DataFrame, weights: Mapping[str | None, float] | None = None,
          source: str = "source", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The rows of ``docs`` as often and in the order as the mix has them.

    Partitions follow each other in the order of slots, and so do their rows.
    """
    return mix(spark, docs, weights, source, block_rows) \
        .repartitionByRange("slot", "order").sortWithinPartitions("slot", "order").select("row.*")
