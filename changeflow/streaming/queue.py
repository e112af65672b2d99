"""Queues that are acknowledged: a stream source with offsets of its own."""

from __future__ import annotations

import json
from abc import ABC, abstractmethod
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from changeflow.session import ship_package

SCHEMA = "shard string, tag bigint, value string"
READ_ROWS = 100_000  # messages one task reads
OUT_ROWS = 4096


class Queue(ABC):
    """Messages in shards, each with a tag that grows with delivery.

    ``shards``, ``last`` and ``acknowledge`` run on the driver, ``read`` in tasks.
    Messages stay until they are acknowledged.
    """

    @abstractmethod
    def shards(self) -> list[str]:
        """The names of the shards."""

    @abstractmethod
    def last(self, shard: str) -> int:
        """The last tag delivered, 0 if there was none."""

    @abstractmethod
    def read(self, shard: str, after: int, upto: int) -> Iterator[tuple[int, str]]:
        """The messages (tag, body) behind one tag up to another, by tag."""

    @abstractmethod
    def acknowledge(self, shard: str, upto: int) -> None:
        """Forget the messages up to a tag; doing it again changes nothing."""


class SpoolQueue(Queue):
    """A queue kept as files of a folder, ``<shard>/<first>-<last>.jsonl``, on any file system.

    A file's lines are its messages, tagged in order. It is removed when all of it is
    acknowledged; what is acknowledged of the first file that stays is written beside.
    """

    def __init__(self, path: str):
        self.path = path

    def _system(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self.path)

    def _files(self, shard: str) -> list[tuple[int, int, str]]:
        system, folder = self._system()
        found = []
        for info in system.get_file_info(fs.FileSelector(f"{folder}/{shard}", allow_not_found=True)):
            if info.base_name.endswith(".jsonl"):
                first, last = info.base_name.removesuffix(".jsonl").split("-")
                found.append((int(first), int(last), info.path))
        return sorted(found)

    def _mark(self, shard: str) -> int:
        system, folder = self._system()
        mark = f"{folder}/{shard}/acknowledged"
        if system.get_file_info(mark).type == fs.FileType.NotFound:
            return 0
        with system.open_input_stream(mark) as body:
            return int(body.read())

    def put(self, shard: str, bodies: Iterable[str]) -> None:
        """Deliver messages, a file of them; for producers and tests."""
        system, folder = self._system()
        lines = [json.dumps(b) for b in bodies]
        if not lines:
            return
        first = self.last(shard) + 1
        system.create_dir(f"{folder}/{shard}", recursive=True)
        name = f"{folder}/{shard}/{first}-{first + len(lines) - 1}.jsonl"
        with system.open_output_stream(f"{name}.tmp") as out:
            out.write("\n".join(lines).encode())
        system.move(f"{name}.tmp", name)

    def shards(self) -> list[str]:
        system, folder = self._system()
        return sorted(i.base_name for i in system.get_file_info(
            fs.FileSelector(folder, allow_not_found=True)) if i.type == fs.FileType.Directory)

    def last(self, shard: str) -> int:
        return max([self._mark(shard), *(last for _, last, _ in self._files(shard))])

    def waiting(self, shard: str) -> int:
        """How many messages are not acknowledged."""
        done = self._mark(shard)
        return sum(last - max(first - 1, done) for first, last, _ in self._files(shard) if last > done)

    def read(self, shard: str, after: int, upto: int) -> Iterator[tuple[int, str]]:
        system, _ = self._system()
        for first, last, path in self._files(shard):
            if last > after and first <= upto:
                with system.open_input_stream(path) as body:
                    for tag, line in enumerate(body.read().decode().split("\n"), first):
                        if after < tag <= upto:
                            yield tag, json.loads(line)

    def acknowledge(self, shard: str, upto: int) -> None:
        system, folder = self._system()
        if upto > self._mark(shard):
            with system.open_output_stream(f"{folder}/{shard}/acknowledged.tmp") as out:
                out.write(str(upto).encode())
            system.move(f"{folder}/{shard}/acknowledged.tmp", f"{folder}/{shard}/acknowledged")
        for _, last, path in self._files(shard):
            if last <= upto:
                system.delete_file(path)


class Span(InputPartition):
    """Messages of a shard behind one tag up to another."""

    def __init__(self, shard: str, after: int, upto: int):
        super().__init__(None)
        self.shard, self.after, self.upto = shard, after, upto


class QueueReader(DataSourceStreamReader):
    """Offsets are the last tag of each shard.

    Spark keeps them in the checkpoint and calls ``commit`` with those of a batch only
    after that batch is through, so a message is acknowledged when nothing can ask
    for it again. A batch that did not get there reads the same messages again.
    """

    def __init__(self, queue: Queue, rows: int):
        self.queue, self.rows = queue, rows

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        return {shard: self.queue.last(shard) for shard in self.queue.shards()}

    def partitions(self, start: dict, end: dict) -> list[Span]:
        spans = []
        for shard, upto in end.items():
            for after in range(start.get(shard, 0), upto, self.rows):
                spans.append(Span(shard, after, min(after + self.rows, upto)))
        return spans

    def read(self, partition: Span) -> Iterator[pa.RecordBatch]:
        names, held = ["shard", "tag", "value"], []
        for tag, value in self.queue.read(partition.shard, partition.after, partition.upto):
            held.append((partition.shard, tag, value))
            if len(held) == OUT_ROWS:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*held)], names)
                held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*held)], names)

    def commit(self, end: dict) -> None:
        for shard, upto in end.items():
            self.queue.acknowledge(shard, upto)


def queue_messages(spark: SparkSession, queue: Queue, name: str,
                   rows: int = READ_ROWS) -> DataFrame:
    """The messages of a queue as a stream (shard, tag, value), acknowledged when done with.

    A task reads at most ``rows`` messages. ``name`` is the format the queue is registered as.
    """
    ship_package(spark)

    class QueueSource(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return SCHEMA

        def streamReader(self, schema) -> QueueReader:
            return QueueReader(queue, rows)

    spark.dataSource.register(QueueSource)
    return spark.readStream.format(name).load()
