"""Streaming readers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from changeflow.operators.shaping import parse_json


def text_stream(spark: SparkSession, path: str | None = None, fmt: str = "text",
                options: Mapping[str, str] | None = None) -> DataFrame:
    """Messages as one string column ``value``; a broker's bytes are cast."""
    reader = spark.readStream.format(fmt).options(**(options or {}))
    raw = reader.load(path) if path else reader.load()
    return raw.select(F.col("value").cast("string").alias("value"))


def json_stream(spark: SparkSession, schema: StructType | str, path: str | None = None,
                fmt: str = "text", options: Mapping[str, str] | None = None,
                on_error: str = "fail") -> DataFrame:
    """Messages that are JSON objects of a declared schema, as typed columns.

    Where to start is the source's option: ``startingOffsets`` for a broker, a
    file source always starts with the oldest file.
    """
    return parse_json(text_stream(spark, path, fmt, options), "value", schema, on_error)


def table_stream(spark: SparkSession, path: str, schema: StructType | str,
                 files_per_batch: int | None = None) -> DataFrame:
    """All partitions of a parquet table, then new ones as they come."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def envelope_type(image: StructType | str) -> StructType:
    """The envelope around a table's row type."""
    row = image if isinstance(image, StructType) else StructType.fromDDL(image)
    source = StructType.fromDDL("ts_ms bigint, db string, table string")
    return StructType().add("before", row).add("after", row).add("source", source)


def change_stream(spark: SparkSession, image: StructType | str, path: str | None = None,
                  databases: Sequence[str] = (".*",), tables: Sequence[str] = (".*",),
                  startup: str = "initial", since: datetime | None = None,
                  on_error: str = "fail", files_per_batch: int | None = None, fmt: str = "text",
                  options: Mapping[str, str] | None = None) -> DataFrame:
    """Change envelopes of the databases and tables whose names match.

    ``fmt`` and ``options`` name any source with a column ``value``: text files in
    ``path``, or a broker's topics. ``initial`` reads the whole log (after a
    snapshot of the tables: :class:`changeflow.streaming.feed.InitialFeed`);
    ``latest`` only what arrived after ``since``, which a source other than files
    takes as one of its options. Names are regular expressions for the whole name.
    """
    if startup not in ("initial", "latest"):
        raise ValueError(f"startup must be initial or latest, not {startup!r}")
    if startup == "latest" and fmt == "text" and since is None:
        raise ValueError("startup latest needs a start time")
    schema = envelope_type(image)
    asked = dict(options or {})
    if files_per_batch:
        asked["maxFilesPerTrigger"] = str(files_per_batch)

    def read(folder: str | None, kind: str, given: Mapping[str, str]) -> DataFrame:
        reader = spark.readStream.format(kind).options(**given)
        raw = reader.load(folder) if folder else reader.load()
        if startup == "latest" and since is not None:
            raw = raw.where(F.col("_metadata.file_modification_time") > F.lit(since))
        return parse_json(raw.select(F.col("value").cast("string").alias("value")), "value",
                          schema, on_error)

    return of_tables(read(path, fmt, asked), databases, tables)


def of_tables(events: DataFrame, databases: Sequence[str], tables: Sequence[str]) -> DataFrame:
    """Envelopes whose database and table names match a pattern each."""
    def matches(column: str, patterns: Sequence[str]):
        return F.col(column).rlike("^(?:" + "|".join(f"(?:{p})" for p in patterns) + ")$")

    return events.where(matches("source.db", databases) & matches("source.table", tables))


def queue_stream(messages: DataFrame, id_col: str, event_time: str | None = None,
                 delay: str | None = None) -> DataFrame:
    """Each message once, by id; a message without an id stops the stream.

    The checkpoint's replayable offsets stand in for acknowledgements. With
    ``event_time`` and ``delay`` ids are forgotten after the delay, and messages
    later than that are left out: :func:`late_messages` counts them. Without, ids
    are kept for ever and none is late.
    """
    stop = F.raise_error(F.lit("message without an id")).cast("boolean")
    checked = messages.where(F.when(F.col(id_col).isNull(), stop).otherwise(True))
    if event_time is None:
        return checked.dropDuplicates([id_col])
    return checked.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([id_col])


def late_messages(query: StreamingQuery) -> int:
    """How many messages a query's recent batches left out as too late."""
    return sum(state.numRowsDroppedByWatermark
               for progress in query.recentProgress for state in progress.stateOperators)
