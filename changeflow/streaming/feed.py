"""A snapshot and then the changes after it, as one numbered series of batches."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from changeflow.operators.shaping import parse_json
from changeflow.session import child_names, path_exists
from changeflow.streaming.sinks import Sink, run_stream
from changeflow.streaming.sources import envelope_type, of_tables

HANDOVER = "batches bigint"
POSITION = "position"
POSITIONS = StructType([StructField("written", TimestampType()), StructField("file", StringType()),
                        StructField("block", LongType()), StructField("line", LongType())])


def positioned_text(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """The lines of a folder's files, as they come, with the ``position`` of their split."""
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    place = F.struct(
        F.col("_metadata.file_modification_time").alias("written"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"))
    return reader.load(path).select("value", place.alias(POSITION))


def in_order(batch: DataFrame) -> DataFrame:
    """Complete the positions of a micro-batch's rows, before anything moves them.

    Positions compare as the log was written: older files first, files of the
    same age by name, and lines in their order inside a file, also where a large
    file is read in several splits.
    """
    return batch.withColumn(POSITION, F.col(POSITION).withField(
        "line", F.monotonically_increasing_id()))


class InitialFeed:
    """Change envelopes of a snapshot's rows, then those of the change log.

    The two phases are streams with checkpoints of their own, and where the feed
    stands is part of its state in ``checkpoint``: while the snapshot is not
    through, only its files are read; when it is, the number of its batches is
    recorded, and the batches of the log are numbered on from there. So a sink
    that applies batches in the order of their numbers never meets a snapshot row
    after a change, whatever the files' sizes and however many a batch takes, and
    a restart goes on in the phase it stopped in. Inside a batch, ``position``
    tells the order of rows; no time of the rows is used.

    The log has to begin no later than the snapshot was read; changes that the
    snapshot already has are applied again and change nothing in the end. Files
    that are added to the snapshot's folder after the handover are not read.
    """

    def __init__(self, spark: SparkSession, image: StructType | str, checkpoint: str,
                 snapshot: str, log: str, databases: Sequence[str] = (".*",),
                 tables: Sequence[str] = (".*",), on_error: str = "fail",
                 files_per_batch: int | None = None, since: datetime | None = None):
        self.spark, self.checkpoint = spark, checkpoint
        self.snapshot, self.log, self.since = snapshot, log, since
        self.schema, self.on_error = envelope_type(image), on_error
        self.names = (databases, tables)
        self.files_per_batch = files_per_batch

    def handed_over(self) -> int | None:
        """The number of the snapshot's batches, once it is through."""
        if not path_exists(self.spark, f"{self.checkpoint}/handover/_SUCCESS"):
            return None
        return self.spark.read.schema(HANDOVER).json(f"{self.checkpoint}/handover").first()[0]

    def run(self, sink: Sink, every_seconds: int | None = None) -> StreamingQuery:
        """Feed ``sink`` with (envelopes and position, batch number).

        Returns when the snapshot is through; the query that is returned follows the
        log, for ever at the pace ``every_seconds``, else to its present end.
        """
        if self.handed_over() is None:
            self._follow(self.snapshot, "snapshot", sink, 0, None, None).awaitTermination()
            done = [int(n) for n in child_names(self.spark, f"{self.checkpoint}/snapshot/commits")
                    if n.isdigit()]
            self.spark.createDataFrame([(max(done, default=-1) + 1,)], HANDOVER).coalesce(1) \
                .write.mode("overwrite").json(f"{self.checkpoint}/handover")  # a single row
        return self._follow(self.log, "log", sink, self.handed_over(), every_seconds, self.since)

    def _follow(self, path: str, phase: str, sink: Sink, first: int, every_seconds: int | None,
                since: datetime | None) -> StreamingQuery:
        lines = positioned_text(self.spark, path, self.files_per_batch)
        if since is not None:
            lines = lines.where(F.col("position.written") > F.lit(since))
        events = of_tables(parse_json(lines, "value", self.schema, self.on_error),
                           *self.names)
        return run_stream(events, lambda batch, number: sink(in_order(batch), first + number),
                          f"{self.checkpoint}/{phase}", every_seconds)


def row_changes(envelopes: DataFrame, ops: Mapping[str, str] | None = None) -> DataFrame:
    """Envelopes as changes (op, position, the image's columns); empty ones drop out.

    A row with an image after it only is an insert, with both an update, with one
    before it only a delete.
    """
    named = {"insert": "+I", "update": "+U", "delete": "-D", **(ops or {})}
    op = F.when(F.col("after").isNull(), named["delete"]) \
        .when(F.col("before").isNull(), named["insert"]).otherwise(named["update"])
    return envelopes.where(F.col("before").isNotNull() | F.col("after").isNotNull()) \
        .select(op.alias("op"), POSITION, F.coalesce("after", "before").alias("row")) \
        .select("op", POSITION, "row.*")
