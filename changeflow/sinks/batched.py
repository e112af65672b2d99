"""Batched writes to a foreign store, with retry."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow.fs import FileSystem
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from changeflow.session import ship_package

# Rows per batch and per packed file, retries, seconds of the first
# pause and the longest exponential pause.
BATCH_ROWS = 1000
PACKED_ROWS = 1 << 17
RETRIES = 3
PAUSE = 1.0
LONGEST_PAUSE = 256.0

REPORT = "task int, batches bigint, rows bigint, attempts bigint"


def pauses(retries: int, base: float = PAUSE, exponential: bool = False) -> list[float]:
    """Seconds to wait before each retry: 0, 1, 2, ... or doubling up to the cap."""
    if exponential:
        return [min(base * 2 ** i, LONGEST_PAUSE) for i in range(retries)]
    return [base * i for i in range(retries)]


def with_retry(call: Callable[[], object], retries: int = RETRIES, base: float = PAUSE,
               exponential: bool = False, only: tuple[type[BaseException], ...] = (Exception,),
               sleep: Callable[[float], None] = time.sleep) -> int:
    """Run ``call`` until it succeeds; returns the attempts. Other errors pass at once."""
    waits = pauses(retries, base, exponential)
    for attempt in range(retries + 1):
        try:
            call()
            return attempt + 1
        except only:
            if attempt == retries:
                raise
            sleep(waits[attempt])
    raise AssertionError("unreachable")


def regroup(frames: Iterator[pd.DataFrame], size: int, seconds: float | None = None,
            clock: Callable[[], float] = time.monotonic) -> Iterator[pd.DataFrame]:
    """The same rows in frames of ``size`` rows, the last one shorter.

    With ``seconds``, rows that have waited that long when more arrive go out in a
    shorter frame.
    """
    held: list[pd.DataFrame] = []
    rows, since = 0, clock()
    for frame in frames:
        if held and seconds is not None and clock() - since >= seconds:
            yield pd.concat(held, ignore_index=True)
            held, rows = [], 0
        while len(frame):
            since = since if held else clock()
            part, frame = frame.iloc[:size - rows], frame.iloc[size - rows:]
            held.append(part)
            rows += len(part)
            if rows == size:
                yield pd.concat(held, ignore_index=True)
                held, rows = [], 0
    if held:
        yield pd.concat(held, ignore_index=True)


def write_batched(df: DataFrame, send: Callable[[pd.DataFrame, int, int], object],
                  size: int = BATCH_ROWS, retries: int = RETRIES, base: float = PAUSE,
                  exponential: bool = False,
                  only: tuple[type[BaseException], ...] = (Exception,),
                  seconds: float | None = None) -> DataFrame:
    """Hand every task's rows to ``send(rows, task, batch)`` in batches of ``size``,
    or, with ``seconds``, sooner if rows come slowly.

    Returns one report row per non-empty task; acting on it runs the write. A
    lost task is run again by Spark, so ``send`` must be safe to repeat for the
    same (task, batch).
    """
    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task = TaskContext.get().partitionId()
        batches = rows = attempts = 0
        for batch in regroup(frames, size, seconds):
            number = batches
            attempts += with_retry(lambda: send(batch, task, number), retries, base,
                                   exponential, only)
            batches += 1
            rows += len(batch)
        if batches:
            yield pd.DataFrame({"task": [task], "batches": [batches], "rows": [rows],
                                "attempts": [attempts]})

    ship_package(df.sparkSession)
    return df.mapInPandas(write, REPORT)


REFUSED = "row {row}, error string, task int, stored bigint, sends bigint"


def tables_of(batches: Iterable[pa.RecordBatch], size: int) -> Iterator[pa.Table]:
    """The same rows in tables of ``size`` rows, the last one shorter."""
    held, rows = [], 0
    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, size - rows)
            batch = batch.slice(part.num_rows)
            held.append(part)
            rows += part.num_rows
            if rows == size:
                yield pa.Table.from_batches(held)
                held, rows = [], 0
    if held:
        yield pa.Table.from_batches(held)


def halves(batch: pa.Table, send: Callable[[pa.Table, str], object], name: str,
           refused: tuple[type[BaseException], ...]) -> Iterator[tuple[pa.Table, str]]:
    """Send a batch; where the store refuses it, its halves, down to the rows it refuses.

    Yields those, a row each, with the error. Pieces go out in the order of their
    rows. A piece's name is its batch's and, for each cut, 0 or 1 for the half: the
    same rows have the same name when a task is run again.
    """
    waiting = [(batch, name)]
    while waiting:
        piece, place = waiting.pop()
        try:
            send(piece, place)
        except refused as error:
            if piece.num_rows == 1:
                yield piece, f"{type(error).__name__}: {error}"
                continue
            half = piece.num_rows // 2
            waiting += [(piece.slice(half), f"{place}.1"), (piece.slice(0, half), f"{place}.0")]


def write_isolated(df: DataFrame, send: Callable[[pa.Table, int, str], object], bad: str,
                   refused: tuple[type[BaseException], ...] = (ValueError,),
                   size: int = BATCH_ROWS, retries: int = RETRIES, base: float = PAUSE,
                   exponential: bool = False,
                   only: tuple[type[BaseException], ...] = (OSError,),
                   on_failure: Callable[[DataFrame], object] | None = None,
                   finish: Callable[[int], object] | None = None) -> dict[str, int]:
    """Hand rows to a store in batches of ``size``; rows it refuses go to the folder ``bad``.

    ``send(table, task, name)`` stores all rows of an Arrow table or, raising one of
    ``refused``, none; such a batch is cut in half until the rows at fault are alone, so
    k bad rows among n cost about 2 k log2(n / k) sends and not n. Errors of ``only``
    are tried again as in :func:`write_batched`; others stop the job. A lost task is
    run again by Spark with the same rows and names, so ``send`` must be safe to repeat
    for a (task, name). A store that packs many pieces together is told by
    ``finish(task)`` that a task has sent its last one.

    Returns the numbers ``stored``, ``refused`` and ``sends``. ``on_failure`` then gets
    the refused rows, if any; :func:`refused_rows` reads them later.
    """
    schema = StructType.fromDDL(REFUSED.format(row="int")).fields
    schema = StructType([StructField("row", df.schema), *schema[1:]])
    arrow = to_arrow_schema(schema)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        stored = sends = 0

        def attempt(rows: pa.Table, name: str) -> None:
            nonlocal stored, sends
            refusal = []

            def call() -> None:
                try:
                    send(rows, task, name)
                except refused as error:
                    refusal.append(error)

            sends += with_retry(call, retries, base, exponential, only)
            if refusal:
                raise refusal[-1]
            stored += rows.num_rows

        reports = []
        for number, batch in enumerate(tables_of(batches, size)):
            for row, error in halves(batch, attempt, str(number), refused):
                reports.append({"task": task, "row": row.to_pylist()[0], "error": error})
                if len(reports) == BATCH_ROWS:
                    yield pa.RecordBatch.from_pylist(reports, arrow)
                    reports = []
        if sends:
            if finish is not None:
                with_retry(lambda: finish(task), retries, base, exponential, only)
            reports.append({"task": task, "stored": stored, "sends": sends})
            yield pa.RecordBatch.from_pylist(reports, arrow)

    ship_package(df.sparkSession)
    df.mapInArrow(write, schema).write.mode("overwrite").parquet(bad)
    spark = df.sparkSession
    numbers = spark.read.parquet(bad).agg(
        F.sum("stored").alias("stored"), F.count("row").alias("refused"),
        F.sum("sends").alias("sends")).first().asDict()
    numbers = {name: number or 0 for name, number in numbers.items()}
    if on_failure is not None and numbers["refused"]:
        on_failure(refused_rows(spark, bad))
    return numbers


class PackingStore:
    """A writer that packs what a task sends into files of about ``PACKED_ROWS`` rows.

    Pieces may be of any size, as halves of refused batches are; ``finish`` writes the
    last file of a task. Safe to repeat: the same pieces make the same files.
    """

    def __init__(self, path: str, file_rows: int = PACKED_ROWS):
        self.path, self.file_rows = path, file_rows
        self.held: dict[str, pa.Table] = {}
        self.rows = self.files = 0

    def send(self, rows: pa.Table, task: int, name: str) -> None:
        self.rows += 0 if name in self.held else rows.num_rows
        self.held[name] = rows
        if self.rows >= self.file_rows:
            self.finish(task)

    def finish(self, task: int) -> None:
        if self.held:
            system, folder = FileSystem.from_uri(self.path)
            system.create_dir(folder, recursive=True)
            pq.write_table(pa.concat_tables(self.held.values()),
                           f"{folder}/{task}-{self.files}.parquet", filesystem=system)
            self.held, self.rows, self.files = {}, 0, self.files + 1


def refused_rows(spark: SparkSession, bad: str) -> DataFrame:
    """The rows a store refused, with the ``_reason`` it gave."""
    return spark.read.parquet(bad).where("row IS NOT NULL") \
        .select("row.*", F.col("error").alias("_reason"))
