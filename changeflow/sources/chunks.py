"""Half-open key chunks of a table, for reading it piece by piece."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from decimal import ROUND_CEILING, Decimal
from itertools import accumulate
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegralType

from changeflow.functions.number import whole_quotient
from changeflow.session import written

# Default rows per chunk and bounds of the distribution factor.
CHUNK_ROWS = 8096
FACTOR_LOW = 0.05
FACTOR_HIGH = 1000.0


@dataclass(frozen=True)
class EvenChunks:
    """Chunk ``i`` holds ``ends[i-1] <= key < ends[i]``; first and last are open.

    Null keys belong to chunk 0. The ends are a ``range``, whatever their number.
    """

    key: str
    ends: range = range(0)

    def __len__(self) -> int:
        return len(self.ends) + 1

    def bounds(self, i: int) -> tuple[int | None, int | None]:
        return (self.ends[i - 1] if i else None, self.ends[i] if i < len(self.ends) else None)

    def number(self) -> Column:
        """The chunk of a row, by arithmetic."""
        if not self.ends:
            return F.lit(0)
        key, start = F.col(self.key), F.lit(self.ends[0])
        at = whole_quotient(key - start, self.ends.step) + 1
        return F.when(key >= start, F.least(at, F.lit(len(self.ends)))).otherwise(0).cast("int")

    def label(self, df: DataFrame, name: str = "chunk_id", later: bool = False) -> DataFrame:
        """Add each row's chunk; no row moves."""
        return df.withColumn(name, self.number())


@dataclass(frozen=True)
class RankedChunks:
    """Chunks of whole keys, as a table (key, chunk) of every key there was.

    Null keys belong to chunk 0. The table may have any number of chunks; none of
    it is held by the driver.
    """

    key: str
    keys: DataFrame
    count: int

    def __len__(self) -> int:
        return self.count

    def starts(self) -> DataFrame:
        """(chunk, key): the first key of each chunk but chunk 0."""
        return self.keys.where("chunk > 0").groupBy("chunk").agg(F.min("key").alias("key"))

    def bounds(self, i: int) -> tuple[Any, Any]:
        near = self.starts().where(F.col("chunk").isin(i, i + 1)).collect()
        found = {r["chunk"]: r["key"] for r in near}
        return found.get(i), found.get(i + 1)

    def label(self, df: DataFrame, name: str = "chunk_id", later: bool = False) -> DataFrame:
        """Add each row's chunk by a join on the key.

        With ``later``, keys that the plan has not seen get the chunk of the last
        known key before them (chunk 0 if there is none).
        """
        known = self.keys if not later else _placed(df.sparkSession, df, self.key, self.starts())
        key = one_name(df, "key")
        joined = df.join(known.select(F.col("key").alias(key), F.col("chunk").alias(name)),
                         df[quoted(self.key)] == F.col(key), "left").drop(key)
        return joined.withColumn(name, F.coalesce(F.col(quoted(name)), F.lit(0)))


ChunkPlan = EvenChunks | RankedChunks


def chunk_rows(plan: ChunkPlan, first: int, last: int | None = None) -> Column:
    """The filter of chunks ``first..last`` of a plan."""
    lower, upper = plan.bounds(first)[0], plan.bounds(first if last is None else last)[1]
    key, term = F.col(quoted(plan.key)), F.lit(True)
    if upper is not None:
        term = (key < F.lit(upper)) | key.isNull() if lower is None else key < F.lit(upper)
    return term if lower is None else (key >= F.lit(lower)) & term


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def one_name(df: DataFrame, want: str) -> str:
    """``want``, or a name like it that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while want.lower() in taken:
        want = f"_{want}"
    return want


def distribution_factor(low: int, high: int, rows: int) -> float:
    """Key span per row, rounded up at the fourth decimal."""
    if rows == 0:
        return float("inf")
    return float((Decimal(high - low + 1) / Decimal(rows)).quantize(Decimal("0.0001"),
                                                                    ROUND_CEILING))


def even_ends(low: int, high: int, rows: int, size: int, step: int) -> range:
    """Chunk ends ``low + step, low + 2*step, ...`` up to ``high``; none for a table
    of at most ``size`` rows."""
    return range(0) if rows <= size else range(low + step, high + 1, step)


def plan_chunks(spark: SparkSession, df: DataFrame, key: str, size: int = CHUNK_ROWS,
                factor_low: float = FACTOR_LOW, factor_high: float = FACTOR_HIGH,
                path: str | None = None) -> ChunkPlan:
    """Chunks of about ``size`` rows; ``path`` is where ranked ones are written.

    One aggregate finds the key's span and the row count. An evenly spread
    whole-number key is cut by arithmetic; any other by the ranks of its values.
    """
    kind = df.schema[key].dataType
    whole = isinstance(kind, IntegralType) or (isinstance(kind, DecimalType) and kind.scale == 0)
    column = quoted(key)
    low, high, rows = df.agg(F.min(column), F.max(column), F.count(F.lit(1))).first()
    if low is None or low == high:
        return EvenChunks(key)
    if whole:
        low, high = int(low), int(high)
        factor = distribution_factor(low, high, rows)
        if factor_low <= factor <= factor_high:
            step = max(int(factor * size), 1)
            return EvenChunks(key, even_ends(low, high, rows, size, step))
    return plan_by_rank(spark, df, key, size, path)


def plan_by_rank(spark: SparkSession, df: DataFrame, key: str, size: int = CHUNK_ROWS,
                 path: str | None = None) -> RankedChunks:
    """Chunk ends at every (size-1)-th row in key order, moved to whole keys.

    A chunk end is the ``size``-th key counted from the previous end, that end
    included, and stays below the largest key. A key's rows never part; a key
    that spans a whole step gets a chunk of its own. Repeated keys do not shift
    later ends, which is what lets all ends be found at once instead of one
    after the other. A key's chunk is the number of ends up to it: a running sum
    inside each range partition and an offset for the partition. Only one row per
    range partition comes to the driver. The plan is a table, at ``path`` or in
    the shared folder.
    """
    parts = sorted_counts(df, key)
    totals = _by_part(parts, F.sum("n").alias("rows"), F.max_by("n", "key").alias("last_n"),
                      F.max("key").alias("high"))
    high = F.lit(totals[-1]["high"] if totals else None)
    begins = starts_chunk(size) & F.coalesce(F.col("key") < high, F.lit(False))
    window = Window.partitionBy("part").orderBy("key") \
        .rowsBetween(Window.unboundedPreceding, 0)
    inside = written(with_ranks(spark, parts, totals)
                     .select("part", "key", F.sum(begins.cast("int")).over(window).alias("inside")),
                     "chunk-ranks")
    counts = _by_part(inside, F.max("inside").alias("n"))
    keys = _carried(spark, inside, [(r["part"], r["n"]) for r in counts], lambda a, b: a + b) \
        .select("key", (F.col("inside") + F.col("carried")).cast("int").alias("chunk"))
    if path is None:
        keys = written(keys, "chunk-keys")
    else:
        keys.write.mode("overwrite").parquet(path)
        keys = spark.read.schema(keys.schema).parquet(path)
    return RankedChunks(key, keys, sum(r["n"] for r in counts) + 1)


def _by_part(df: DataFrame, *measures: Column) -> list:
    """One row for each range partition, in their order."""
    return sorted(df.groupBy("part").agg(*measures).collect(), key=lambda r: r["part"])


def _carried(spark: SparkSession, df: DataFrame, values: list[tuple],
             joined: Callable[[int, int], int]) -> DataFrame:
    """Add to each row what the partitions before its own come to, 0 for the first."""
    before = list(accumulate((v for _, v in values), joined, initial=0))
    table = spark.createDataFrame([(part, v) for (part, _), v in zip(values, before)],
                                  "part int, carried bigint")
    return df.join(F.broadcast(table), "part")


def _placed(spark: SparkSession, df: DataFrame, key: str, starts: DataFrame) -> DataFrame:
    """(key, chunk) of the keys of ``df``: the last start up to a key tells its chunk."""
    own = df.select(F.col(quoted(key)).alias("key")).where("key IS NOT NULL").distinct()
    both = own.withColumn("chunk", F.lit(0)).unionByName(starts.select("key", "chunk")) \
        .groupBy("key").agg(F.max("chunk").alias("chunk"))
    parted = written(both.repartitionByRange("key").withColumn("part", F.spark_partition_id()),
                     "chunk-places")
    highest = [(r["part"], r["n"]) for r in _by_part(parted, F.max("chunk").alias("n"))]
    window = Window.partitionBy("part").orderBy("key") \
        .rowsBetween(Window.unboundedPreceding, 0)
    running = parted.withColumn("chunk", F.max("chunk").over(window))
    return _carried(spark, running, highest, max) \
        .select("key", F.greatest("chunk", "carried").cast("int").alias("chunk"))


def sorted_counts(df: DataFrame, key: str) -> DataFrame:
    """Each distinct ``key`` with its row count ``n``, range-partitioned by ``part``.

    Counts are combined before they move. The result is written once, so that
    everything computed from it sees the same partitions.
    """
    column = F.col(quoted(key))
    counts = df.where(column.isNotNull()).groupBy(column.alias("key")) \
        .agg(F.count(F.lit(1)).alias("n"))
    return written(counts.repartitionByRange("key")
                   .withColumn("part", F.spark_partition_id()), "ranks")


def with_ranks(spark: SparkSession, parts: DataFrame, totals: list) -> DataFrame:
    """Add the rows ``before`` each key and the count ``previous`` of the key before it.

    A global window would put all keys on one task. Here windows run inside the
    range partitions, and what precedes a partition comes from ``totals``, which
    has one row for each of them.
    """
    starts = accumulate((t["rows"] for t in totals), initial=0)
    previous = [None, *(t["last_n"] for t in totals)]
    carried = spark.createDataFrame(
        [(t["part"], start, n) for t, start, n in zip(totals, starts, previous)],
        "part int, start bigint, carried bigint")
    window = Window.partitionBy("part").orderBy("key")
    inside = F.sum("n").over(window.rowsBetween(Window.unboundedPreceding, -1))
    return (parts.withColumns({"inside": F.coalesce(inside, F.lit(0)),
                               "near": F.lag("n").over(window)})
            .join(F.broadcast(carried), "part")
            .select("part", "key", "n", (F.col("inside") + F.col("start")).alias("before"),
                    F.coalesce("near", "carried").alias("previous")))


def starts_chunk(size: int) -> Column:
    """Whether a key begins a chunk: it holds a step row, or follows a key that
    spans a whole step."""
    step = max(size - 1, 1)
    first, last = F.col("before"), F.col("before") + F.col("n") - 1
    holds_step = whole_quotient(last, step) > whole_quotient(first - 1, step)
    return (first > 0) & (holds_step | F.coalesce(F.col("previous") > step, F.lit(False)))
