"""Each message once, with a place for those that come too late."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from changeflow.functions.time import epoch_ms
from changeflow.session import child_names, path_exists, remove_dir
from changeflow.streaming.sinks import Sink


class OnceSink:
    """Passes one delivery of each message to ``good``; those that come too late to ``late``.

    A message with a known id is a repetition and goes nowhere. The ids of a batch are
    kept until its newest message is older than ``delay_ms`` before the newest of all.
    A message older than that when its batch begins may be a repetition or not, which can
    no longer be told: it goes to ``late`` as it came, so that good, late and repeated
    messages are all there are. A message without an id stops the batch, one without a
    time is never late. Without ``delay_ms`` none is late and ids are kept for ever.

    All deliveries of a message have to carry the same time: a batch looks only at known
    ids of the times it holds. State is files in ``path``, the ids of each batch and one
    short record of it; a batch that is run again replaces both, and its numbers in
    ``counts`` too.
    """

    RECORD = "newest long, cut long, messages long, good long, late long"

    def __init__(self, spark: SparkSession, path: str, id_col: str, good: Sink, late: Sink,
                 time_col: str | None = None, delay_ms: int | None = None):
        if delay_ms is not None and time_col is None:
            raise ValueError("a delay needs a time column")
        self.spark, self.path, self.id_col = spark, path, id_col
        self.good, self.late = good, late
        self.time_col, self.delay_ms = time_col, delay_ms

    def _records(self) -> DataFrame:
        if not path_exists(self.spark, f"{self.path}/records"):
            return self.spark.createDataFrame([], f"{self.RECORD}, batch long")
        return self.spark.read.schema(f"{self.RECORD}, batch long").json(f"{self.path}/records")

    def _known(self, batch_id: int, low: int | None, high: int | None,
               schema: StructType) -> DataFrame:
        """The ids of earlier batches that have no time, or one from ``low`` to ``high``."""
        if not path_exists(self.spark, f"{self.path}/ids"):
            return self.spark.createDataFrame([], schema).select(F.col("id").alias("_id"))
        numbered = StructType([*schema.fields, StructField("batch", LongType())])
        ids = self.spark.read.schema(numbered).parquet(f"{self.path}/ids")
        return ids.where((F.col("batch") < batch_id) & (
            F.col("at").isNull() | F.col("at").between(low, high))).select(F.col("id").alias("_id"))

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        before = self._records().where(F.col("batch") < batch_id) \
            .agg(F.max("newest").alias("newest")).first()["newest"]
        # What was too old when the batch began is late, so the batch itself makes nothing late.
        cut = before - self.delay_ms if self.delay_ms is not None and before is not None else None
        stop = F.raise_error(F.lit("message without an id"))
        at = epoch_ms(F.col(self.time_col)) if self.time_col else F.lit(None).cast("bigint")
        held = batch.withColumns({
            "_id": F.when(F.col(self.id_col).isNull(), stop.cast(batch.schema[self.id_col].dataType))
            .otherwise(F.col(self.id_col)), "_at": at}).persist()
        try:
            found = held.agg(F.count(F.lit(1)).alias("n"), F.min("_at").alias("oldest"),
                             F.max("_at").alias("newest")).first()
            newest = max((t for t in (before, found["newest"]) if t is not None), default=None)
            too_late = F.lit(False) if cut is None else F.coalesce(F.col("_at") < cut, F.lit(False))
            ids = StructType([StructField("id", batch.schema[self.id_col].dataType),
                              StructField("at", LongType())])
            known = self._known(batch_id, found["oldest"], found["newest"], ids)
            fresh = held.where(~too_late).dropDuplicates(["_id"]) \
                .join(known, "_id", "left_anti").persist()
            try:
                self.good(fresh.drop("_id", "_at"), batch_id)
                late = held.where(too_late).drop("_id", "_at")
                self.late(late, batch_id)
                fresh.select(F.col("_id").alias("id"), F.col("_at").alias("at")) \
                    .sortWithinPartitions("at").write.mode("overwrite").parquet(f"{self.path}/ids/batch={batch_id}")
                record = [(newest, cut, found["n"], fresh.count(), late.count())]
                self.spark.createDataFrame(record, self.RECORD).coalesce(1).write \
                    .mode("overwrite").json(f"{self.path}/records/batch={batch_id}")
            finally:
                fresh.unpersist()
        finally:
            held.unpersist()
        self._forget(cut, batch_id)

    def _forget(self, cut: int | None, batch_id: int) -> None:
        """Remove the ids of batches whose newest time is too old to be repeated."""
        if cut is None:
            return
        kept = {int(n.removeprefix("batch=")) for n in child_names(self.spark, f"{self.path}/ids")
                if n.startswith("batch=")}
        old = self._records().where((F.col("newest") < cut) & F.col("batch").isin(sorted(kept))) \
            .select("batch").collect()
        for row in old:
            if row["batch"] < batch_id:
                remove_dir(self.spark, f"{self.path}/ids/batch={row['batch']}")

    def counts(self) -> dict[str, int]:
        """How many messages came, passed, were repetitions and were late."""
        sums = self._records().agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c)
                                     for c in ("messages", "good", "late")]).first()
        return {**sums.asDict(), "repeated": sums["messages"] - sums["good"] - sums["late"]}
