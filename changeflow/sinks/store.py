"""A data source for stores that take batches: flushed by size or by time, published once."""

from __future__ import annotations

import json
import threading
import time
import uuid
from abc import ABC, abstractmethod
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceStreamArrowWriter, WriterCommitMessage)

from changeflow.session import ship_package

# Rows a buffer holds, and the seconds after which it goes out anyway.
BUFFER_ROWS = 1000
INTERVAL = 1.0


class TimedBuffer:
    """Rows that go to ``send(table, number)`` when there are ``size`` of them, or when the
    oldest has waited ``seconds``, whether more arrive or not.

    A thread beside the writer looks at the clock. An error in it is kept and
    raised by the next ``add`` or by ``close``, so it fails the task. Batches go out
    one at a time and in order.
    """

    def __init__(self, send: Callable[[pa.Table, int], object], size: int = BUFFER_ROWS,
                 seconds: float | None = INTERVAL):
        self.send, self.size, self.seconds = send, size, seconds
        self.held: list[pa.RecordBatch] = []
        self.rows = self.batches = 0
        self.since = 0.0
        self.error: BaseException | None = None
        self.closed = False
        self.changed = threading.Condition()
        self.timer = None
        if seconds is not None:
            self.timer = threading.Thread(target=self._watch, daemon=True)
            self.timer.start()

    def add(self, batch: pa.RecordBatch) -> None:
        with self.changed:
            while batch.num_rows:
                self._check()
                if not self.rows:
                    self.since = time.monotonic()
                part = batch.slice(0, self.size - self.rows)
                batch = batch.slice(part.num_rows)
                self.held.append(part)
                self.rows += part.num_rows
                if self.rows == self.size:
                    self._flush()
                self.changed.notify()

    def close(self) -> None:
        """Send what is left and stop the thread."""
        with self.changed:
            self.closed = True
            self.changed.notify()
        if self.timer is not None:
            self.timer.join()
        with self.changed:
            self._check()
            if self.rows:
                self._flush()

    def _check(self) -> None:
        if self.error is not None:
            raise RuntimeError("a flush in the background failed") from self.error

    def _flush(self) -> None:
        table = pa.Table.from_batches(self.held)
        self.held, self.rows = [], 0
        self.send(table, self.batches)
        self.batches += 1

    def _watch(self) -> None:
        with self.changed:
            while not self.closed:
                if not self.rows:
                    self.changed.wait()
                    continue
                left = self.since + self.seconds - time.monotonic()
                if left > 0:
                    self.changed.wait(left)
                    continue
                try:
                    self._flush()
                except BaseException as error:  # handed to the writer, whatever it is
                    self.error = error
                    return


class Store(ABC):
    """Where batches go. ``stage`` runs in tasks, the others on the driver.

    Nothing staged is visible before ``publish``; names of tasks that were lost or
    repeated are never published.
    """

    @abstractmethod
    def stage(self, table: pa.Table, task: str, number: int) -> None:
        """Put down one batch of a task."""

    @abstractmethod
    def publish(self, tasks: dict[str, int], job: str) -> None:
        """Make the batches of these tasks, so many each, visible at once.

        Doing it again for the same job changes nothing more.
        """

    @abstractmethod
    def discard(self, tasks: list[str]) -> None:
        """Remove what these tasks have put down."""


class FolderStore(Store):
    """Batches as files of a folder on any file system, with a list for each finished job."""

    def __init__(self, path: str):
        self.path = path

    def _system(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self.path)

    def stage(self, table: pa.Table, task: str, number: int) -> None:
        system, folder = self._system()
        system.create_dir(f"{folder}/staged/{task}", recursive=True)
        pq.write_table(table, f"{folder}/staged/{task}/{number}.parquet", filesystem=system)

    def publish(self, tasks: dict[str, int], job: str) -> None:
        system, folder = self._system()
        system.create_dir(f"{folder}/jobs", recursive=True)
        with system.open_output_stream(f"{folder}/jobs/{job}.tmp") as out:
            out.write(json.dumps(tasks).encode())
        system.move(f"{folder}/jobs/{job}.tmp", f"{folder}/jobs/{job}.json")

    def discard(self, tasks: list[str]) -> None:
        system, folder = self._system()
        for task in tasks:
            if system.get_file_info(f"{folder}/staged/{task}").type != fs.FileType.NotFound:
                system.delete_dir(f"{folder}/staged/{task}")

    def published(self) -> list[str]:
        """The files of finished jobs."""
        system, folder = self._system()
        listed = fs.FileSelector(f"{folder}/jobs", allow_not_found=True)
        found = []
        for info in system.get_file_info(listed):
            if info.path.endswith(".json"):
                with system.open_input_stream(info.path) as body:
                    tasks = json.loads(body.read())
                found += [f"{self.path}/staged/{task}/{n}.parquet"
                          for task, count in tasks.items() for n in range(count)]
        return sorted(found)

    def rows(self, spark: SparkSession, schema) -> DataFrame:
        files = self.published()
        return spark.read.schema(schema).parquet(*files) if files else \
            spark.createDataFrame([], schema)


@dataclass
class Staged(WriterCommitMessage):
    task: str
    batches: int


class _Writing:
    """What the writers of a job and of a stream have in common."""

    def __init__(self, store: Store, size: int, seconds: float | None, job: str):
        self.store, self.size, self.seconds, self.job = store, size, seconds, job

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        context = TaskContext.get()
        task = f"{self.job}-{context.partitionId()}-{context.taskAttemptId()}"
        buffer = TimedBuffer(lambda table, n: self.store.stage(table, task, n), self.size, self.seconds)
        try:
            for batch in iterator:
                buffer.add(batch)
            buffer.close()
        except BaseException:
            buffer.closed = True
            self.store.discard([task])
            raise
        return Staged(task, buffer.batches)

    def _publish(self, messages: list[Staged | None], job: str) -> None:
        self.store.publish({m.task: m.batches for m in messages if m is not None and m.batches}, job)

    def _discard(self, messages: list[Staged | None]) -> None:
        self.store.discard([m.task for m in messages if m is not None])


class JobWriter(_Writing, DataSourceArrowWriter):
    def commit(self, messages: list[Staged | None]) -> None:
        self._publish(messages, self.job)

    def abort(self, messages: list[Staged | None]) -> None:
        self._discard(messages)


class StreamWriter(_Writing, DataSourceStreamArrowWriter):
    """Each micro-batch is a job of its own, named by its number."""

    def commit(self, messages: list[Staged | None], batchId: int) -> None:
        self._publish(messages, f"batch-{batchId}")

    def abort(self, messages: list[Staged | None], batchId: int) -> None:
        self._discard(messages)


def store_format(spark: SparkSession, store: Store, name: str, size: int = BUFFER_ROWS,
                 seconds: float | None = INTERVAL) -> str:
    """Register ``store`` as the format ``name`` for ``write`` and ``writeStream``; returns it.

    Tasks buffer rows and stage them ``size`` at a time, or sooner when rows come
    slowly. What is staged becomes visible when all tasks of a job, or of a
    micro-batch, are through; a failed task leaves nothing. Rows reach a task's
    writer in Arrow batches of the session's ``maxRecordsPerBatch``, so this should not be
    far above ``size`` where rows trickle.
    """
    ship_package(spark)

    class StoreSource(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def writer(self, schema, overwrite: bool) -> JobWriter:
            return JobWriter(store, size, seconds, uuid.uuid4().hex)

        def streamWriter(self, schema, overwrite: bool) -> StreamWriter:
            return StreamWriter(store, size, seconds, uuid.uuid4().hex)

    spark.dataSource.register(StoreSource)
    return name
