"""Micro-batch sinks. Each can be run again for a batch without harm."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from changeflow.functions.time import epoch_ms, with_time_parts
from changeflow.operators.shaping import explode_json, parse_json, unreadable_json
from changeflow.sinks.files import rebalanced

Sink = Callable[[DataFrame, int], object]

# Fixed value: how long after a partition's time it is committed, in milliseconds.
COMMIT_DELAY_MS = 10_000


def file_sink(path: str, partitions: Sequence[str] = (), fmt: str = "parquet") -> Sink:
    """Write each batch to its own folder, which a repeated batch replaces."""
    def write(batch: DataFrame, batch_id: int) -> None:
        writer = (rebalanced(batch, partitions) if partitions else batch).write.mode("overwrite")
        writer = writer.option("partitionOverwriteMode", "static")
        writer = writer.partitionBy(*partitions) if partitions else writer
        writer.format(fmt).save(f"{path}/batch={batch_id}")
    return write


def run_to_files(rows: DataFrame, path: str, checkpoint: str, partitions: Sequence[str] = (),
                 every_seconds: int | None = None, fmt: str = "parquet") -> StreamingQuery:
    """Stream into one file table with Spark's own sink, which counts every row once.

    Its log of finished files is what readers of ``path`` go by.
    """
    writer = rows.writeStream.format(fmt).option("checkpointLocation", checkpoint)
    writer = writer.partitionBy(*partitions) if partitions else writer
    return writer.trigger(**_pace(every_seconds)).start(path)


def _pace(every_seconds: int | None) -> dict:
    return {"processingTime": f"{every_seconds} seconds"} if every_seconds else \
        {"availableNow": True}


def read_files(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path).drop("batch")


def write_all(batch: DataFrame, sinks: Mapping[str, Sink], batch_id: int = 0,
              hold: bool = True) -> None:
    """Every row to every sink.

    The rows are computed once and held in between. For a whole table that is
    cheap to read but too large to hold, ``hold=False`` reads it for each sink.
    """
    if not hold:
        for sink in sinks.values():
            sink(batch, batch_id)
        return
    held = batch.persist()
    try:
        for sink in sinks.values():
            sink(held, batch_id)
    finally:
        held.unpersist()


def parsed_sink(schema: StructType | str, good: Sink, bad: Sink, column: str = "value",
                array: bool = False) -> Sink:
    """For a stream of raw JSON messages: rows to ``good``, unreadable messages to ``bad``.

    Every message is in one of the two. Blank and missing messages are unreadable.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        read = explode_json if array else parse_json
        good(read(batch, column, schema, on_error="quarantine"), batch_id)
        bad(unreadable_json(batch, column, schema, array), batch_id)
    return write


def run_stream(rows: DataFrame, sink: Sink, checkpoint: str,
               every_seconds: int | None = None) -> StreamingQuery:
    """Start a stream into ``sink``.

    With ``every_seconds`` it goes on forever, flushing at that pace; otherwise
    it ends with the available input. A batch's offsets are committed only after
    ``sink`` returned, so rows are written before the checkpoint moves on.
    """
    writer = rows.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    return writer.trigger(**_pace(every_seconds)).start()


class TimePartitionSink:
    """Day/hour partitioned files with a commit mark per finished partition.

    A partition is committed once the event time all sources have reached passes
    its start plus the delay. With ``source_col`` (a broker's partition, say) the
    slowest source counts: a fast one does not commit hours that another still
    fills. ``sources``, if given, must all have been seen before anything is
    committed. With ``idle_ms`` a source that is further than that behind the
    newest one holds nothing up until it goes on. Without ``source_col`` there is
    one source.

    Each batch stores the partitions still open and how far each source is, so the
    next one reads nothing older. Rows that come late open their partition again
    and it is committed anew. ``on_commit`` is called with the partitions a batch
    commits, for example to add them to a catalog; it may be called again for the
    same batch.
    """

    STATE = "dt string, hr string, newest bigint, source string"

    def __init__(self, spark: SparkSession, path: str, ms_col: str, zone: str = "UTC",
                 delay_ms: int = COMMIT_DELAY_MS, on_commit: Sink | None = None,
                 source_col: str | None = None, sources: Sequence[str] | None = None,
                 idle_ms: int | None = None):
        self.on_commit = on_commit
        self.spark, self.path, self.ms_col = spark, path, ms_col
        self.zone, self.delay_ms = zone, delay_ms
        self.source_col, self.sources, self.idle_ms = source_col, sources, idle_ms
        self._data = file_sink(f"{path}/data", ["dt", "hr"])

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        parted = with_time_parts(batch, self.ms_col, self.zone).persist()
        try:
            self._data(parted, batch_id)
            newest = F.max(F.col(self.ms_col).cast("bigint")).alias("newest")
            source = F.lit("") if self.source_col is None else \
                F.coalesce(F.col(self.source_col).cast("string"), F.lit(""))
            none = F.lit(None).cast("string")
            seen = parted.groupBy("dt", "hr").agg(newest).withColumn("source", none)
            reached = parted.groupBy(source.alias("source")).agg(newest) \
                .where(F.col("newest").isNotNull()).select(
                none.alias("dt"), none.alias("hr"), "newest", "source")
            self._advance(seen.unionByName(reached), batch_id)
        finally:
            parted.unpersist()

    def _slowest(self, progress: DataFrame) -> int | None:
        """The time that all sources have reached; a row for each source comes here."""
        if self.idle_ms is not None:
            last = progress.agg(F.max("newest").alias("last"))
            progress = progress.join(F.broadcast(last), F.col("newest") >= F.col("last") - self.idle_ms)
        found = progress.agg(F.min("newest"), F.collect_set("source")).first()
        if self.sources is not None and not set(self.sources) <= set(found[1]):
            return None
        return found[0]

    def _advance(self, seen: DataFrame, batch_id: int) -> None:
        state = self.spark.createDataFrame([], self.STATE)
        if batch_id > 0:
            state = self.spark.read.schema(self.STATE).parquet(
                f"{self.path}/open/batch={batch_id - 1}")
        merged = seen.unionByName(state).groupBy("dt", "hr", "source") \
            .agg(F.max("newest").alias("newest"))
        progress = merged.where(F.col("source").isNotNull())
        slowest = self._slowest(progress)
        starts = F.to_timestamp_ntz(F.concat_ws(" ", "dt", "hr"), F.lit("yyyy-MM-dd HH"))
        due = F.coalesce(epoch_ms(starts, self.zone) + self.delay_ms < F.lit(slowest).cast("bigint"),
                         F.lit(False))
        named = merged.where(F.col("dt").isNotNull() & F.col("hr").isNotNull())
        (named.where(due).select("dt", "hr").coalesce(1).write.mode("overwrite")
         .parquet(f"{self.path}/commits/batch={batch_id}"))
        if self.on_commit is not None:
            marks = self.spark.read.schema("dt string, hr string").parquet(
                f"{self.path}/commits/batch={batch_id}")
            if not marks.isEmpty():
                self.on_commit(marks, batch_id)
        # a row per open partition, and a row per source
        (named.where(~due).unionByName(progress).select("dt", "hr", "newest", "source").coalesce(1)
         .write.mode("overwrite").parquet(f"{self.path}/open/batch={batch_id}"))

    def committed(self) -> DataFrame:
        """The committed partitions."""
        schema = StructType.fromDDL("dt string, hr string")
        return self.spark.read.schema(schema).parquet(f"{self.path}/commits") \
            .select("dt", "hr").distinct()

    def rows(self, committed: bool = False) -> DataFrame:
        """The rows written, or only those of committed partitions."""
        rows = read_files(self.spark, f"{self.path}/data") \
            .withColumns({c: F.col(c).cast("string") for c in ("dt", "hr")})
        if not committed:
            return rows
        marks = self.committed()
        return rows.join(marks, [F.lpad(rows["hr"], 2, "0") == marks["hr"],
                                 rows["dt"] == marks["dt"]], "left_semi")
