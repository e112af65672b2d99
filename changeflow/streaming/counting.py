"""Counts that follow a change stream, retractions included."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

from changeflow.operators.changelog import RETRACTS
from changeflow.operators.counting import bucket_of, bucket_text
from changeflow.streaming.ledger import Ledger, Segments


def weight(op: str | None = "op") -> Column:
    """+1 for a row that adds, -1 for one that retracts."""
    return F.lit(1) if op is None else F.when(F.col(op).isin(*RETRACTS), -1).otherwise(1)


class ContinuousPvUv:
    """Page views and unique visitors, kept up to date by micro-batches.

    Two ledgers hold the state: rows per (bucket, group, who), and the pv/uv of
    each (bucket, group). A batch is summed per (bucket, group, who) first, so a
    hot group or visitor is combined before it moves, and looks up only earlier
    counts of the buckets and visitors it contains, in the files whose range of
    buckets meets the batch's. ``fan`` batches are merged at a time.
    """

    def __init__(self, spark: SparkSession, path: str, schema: StructType, ts: str,
                 by: Sequence[str], who: str, grain: str = "day", op: str | None = "op",
                 fan: int = 8, small: int = 1 << 16,
                 on_update: Callable[[DataFrame, int], object] | None = None):
        self.ts, self.by, self.who, self.grain, self.op = ts, list(by), who, grain, op
        self.on_update = on_update
        groups = [StructField("dt", StringType()), *[schema[c] for c in by]]
        person = StructField("who", schema[who].dataType)
        self.visits = Ledger(spark, f"{path}/visits", [*groups, person], ["n"], "dt", fan, small)
        self.results = Ledger(spark, f"{path}/results", groups, ["pv", "uv"], "dt", fan, small)

    def _group(self) -> list[str]:
        return ["dt", *self.by]

    def process(self, batch: DataFrame, batch_id: int) -> None:
        """Take in one micro-batch; running the same one again changes nothing."""
        summed = (batch.groupBy(bucket_of(self.ts, self.grain).alias("_bucket"), *self.by,
                                F.col(self.who).alias("who"))
                  .agg(F.sum(weight(self.op)).cast("bigint").alias("n"))
                  .withColumn("dt", bucket_text("_bucket", self.grain)).drop("_bucket"))
        added = self.visits.append(summed, batch_id)
        # The days or hours of one batch are few; rows without a time are a group too.
        found = [r["dt"] for r in added.select("dt").distinct().collect()]
        there = F.col("dt").isin([dt for dt in found if dt is not None])
        met = (there | F.col("dt").isNull()) if None in found else there

        def same(left: DataFrame, right: DataFrame, names: Sequence[str]) -> Column:
            return reduce(and_, (left[c].eqNullSafe(right[c]) for c in names))

        names = [*self._group(), "who"]
        earlier = self.visits.before(batch_id, found).where(met)
        touched = added.select(*names)
        known = (earlier.join(touched, same(earlier, touched, names), "left_semi")
                 .groupBy(*names).agg(F.sum("n").alias("had")))
        joined = added.join(known, same(added, known, names), "left").select(
            *[added[c] for c in names], "n", F.coalesce("had", F.lit(0)).alias("had"))
        somebody = F.col("who").isNotNull()
        gained = (somebody & (F.col("had") + F.col("n") > 0)).cast("bigint") \
            - (somebody & (F.col("had") > 0)).cast("bigint")
        stored = self.results.append(
            joined.groupBy(*self._group()).agg(F.sum("n").alias("pv"), F.sum(gained).alias("uv")),
            batch_id)
        if self.on_update is not None:
            now = self.current(batch_id + 1)
            fresh = stored.select(*self._group())
            self.on_update(now.join(fresh, same(now, fresh, self._group()), "left_semi"), batch_id)

    def current(self, before: int = (1 << 62)) -> DataFrame:
        """``dt``, the group, ``pv`` and ``uv``; groups without rows are gone."""
        return self.results.totals(before).where(F.col("pv") > 0)

    def start(self, changes: DataFrame, checkpoint: str) -> StreamingQuery:
        """Follow the stream until its available input is done."""
        return (changes.writeStream.foreachBatch(self.process)
                .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


class CountChanges:
    """A running count as changes: first (+, n), then (-, old) and (+, new).

    Each micro-batch is one change of the count. The running total is noted with each
    batch, so a batch needs only the one before. The changes are runs of files merged
    by level, ``fan`` at a time, so that their number stays small for ever.
    """

    def __init__(self, spark: SparkSession, path: str, op: str | None = None, fan: int = 8):
        self.spark, self.op = spark, op
        schema = StructType([StructField("is_add", BooleanType()), StructField("n", LongType()),
                             StructField("batch", LongType())])
        self.files = Segments(spark, path, schema, "batch", lambda rows: rows, fan)

    def process(self, batch: DataFrame, batch_id: int) -> None:
        old = int(self.files.note(batch_id) or 0)
        new = old + (batch.agg(F.sum(weight(self.op))).first()[0] or 0)
        rows = [] if new == old else [(False, old, batch_id)] * (old != 0) \
            + [(True, new, batch_id)] * (new != 0)
        self.files.add(self.spark.createDataFrame(rows, self.files.schema), batch_id, str(new))

    def changes(self) -> DataFrame:
        """All changes, with the batch that made them."""
        return self.files.read()

    def start(self, rows: DataFrame, checkpoint: str) -> StreamingQuery:
        return (rows.writeStream.foreachBatch(self.process)
                .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
