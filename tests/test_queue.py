"""Acknowledged queues, messages that come late, and commits by the slowest source."""

import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from changeflow.session import fresh_dir
from changeflow.streaming.once import OnceSink
from changeflow.streaming.queue import QueueReader, SpoolQueue, queue_messages
from changeflow.streaming.sinks import TimePartitionSink, file_sink, read_files, run_stream


def test_a_spool_keeps_what_is_not_acknowledged(spark):
    queue = SpoolQueue(fresh_dir(spark, "spool"))
    queue.put("a", ["1", "2\n", "é"])
    queue.put("a", ["4"])
    queue.put("b", ["x"])
    assert queue.shards() == ["a", "b"] and (queue.last("a"), queue.last("c")) == (4, 0)
    assert list(queue.read("a", 1, 4)) == [(2, "2\n"), (3, "é"), (4, "4")]
    queue.acknowledge("a", 2)
    assert queue.waiting("a") == 2 and list(queue.read("a", 2, 3)) == [(3, "é")]
    queue.acknowledge("a", 4)
    queue.acknowledge("a", 3)
    assert queue.waiting("a") == 0 and queue.last("a") == 4
    assert not [f for f in os.listdir(f"{queue.path}/a") if f.endswith("jsonl")]
    queue.put("a", ["5"])
    assert list(queue.read("a", 4, 5)) == [(5, "5")]


def test_offsets_are_cut_to_spans(spark):
    queue = SpoolQueue(fresh_dir(spark, "spans"))
    queue.put("a", [str(i) for i in range(25)])
    queue.put("b", ["x"])
    reader = QueueReader(queue, 10)
    spans = reader.partitions({"a": 3}, reader.latestOffset())
    assert [(s.shard, s.after, s.upto) for s in spans] == [
        ("a", 3, 13), ("a", 13, 23), ("a", 23, 25), ("b", 0, 1)]
    got = [t for s in spans for b in reader.read(s) for t in b.column("tag").to_pylist()]
    assert got == [*range(4, 26), 1]


def test_a_crash_before_the_checkpoint_delivers_again(spark):
    """Nothing is acknowledged until the batch is through; then it is gone."""
    path = fresh_dir(spark, "redelivered")
    queue, seen, broken = SpoolQueue(f"{path}/queue"), [], [True]
    queue.put("a", [f"m{i}" for i in range(10)])
    write = file_sink(f"{path}/out")

    def sink(batch, number):
        write(batch, number)
        seen.append(number)
        if broken:
            broken.clear()
            raise RuntimeError("lost after the write")

    def run():
        rows = queue_messages(spark, queue, "crash_queue", 4)
        run_stream(rows, sink, f"{path}/checkpoint").awaitTermination()

    with pytest.raises(StreamingQueryException):
        run()
    assert queue.waiting("a") == 10
    run()
    assert seen == [0, 0]
    queue.put("a", ["m10"])
    run()
    assert queue.waiting("a") <= 1  # the first batch is acknowledged, the last may wait
    got = sorted(r["value"] for r in read_files(spark, f"{path}/out").collect())
    assert got == sorted(f"m{i}" for i in range(11))


DAY = datetime(2024, 1, 1)


def test_good_late_and_repeated_are_all_messages(spark):
    draw, path = random.Random(3), fresh_dir(spark, "once")
    good, late = file_sink(f"{path}/good"), file_sink(f"{path}/late")
    sink = OnceSink(spark, f"{path}/state", "id", good, late, "at", 2 * 3_600_000)
    known, newest, want_good, want_late, total = set(), None, [], [], 0
    made = {}
    for number in range(6):
        rows = []
        for i in range(60):
            ident = 7 if i % 3 == 0 else draw.randrange(number * 25, number * 25 + 60)
            made.setdefault(ident, DAY + timedelta(minutes=draw.randrange(number * 60, number * 60 + 200))
                            if ident % 11 else None)
            rows.append((ident, made[ident]))
        total += len(rows)
        cut = newest - timedelta(hours=2) if newest else None
        for ident, at in rows:
            if cut and at and at < cut:
                want_late.append(ident)
            elif ident not in known:
                known.add(ident)
                want_good.append(ident)
        newest = max([t for _, t in rows if t] + ([newest] if newest else []))
        batch = spark.createDataFrame(rows, "id bigint, at timestamp_ntz")
        for _ in range(2):  # each batch is run twice
            sink(batch, number)
    assert sorted(r["id"] for r in read_files(spark, f"{path}/late").collect()) == sorted(want_late)
    passed = sorted(r["id"] for r in read_files(spark, f"{path}/good").collect())
    # Ids without a time may be forgotten with their batch; no other id passes twice.
    assert [i for i in passed if i % 11] == sorted(i for i in want_good if i % 11)
    counts = sink.counts()
    assert counts["messages"] == total and counts["late"] == len(want_late)
    assert counts["repeated"] == total - len(passed) - len(want_late)
    kept = [f for f in os.listdir(f"{path}/state/ids") if f.startswith("batch=")]
    assert len(kept) < 6


def test_ids_are_needed_and_kept_for_ever_without_a_delay(spark):
    path = fresh_dir(spark, "once-ever")
    good, late = file_sink(f"{path}/good"), file_sink(f"{path}/late")
    sink = OnceSink(spark, f"{path}/state", "id", good, late)
    for number in range(3):
        sink(spark.range(number, number + 3), number)
    assert sorted(r["id"] for r in read_files(spark, f"{path}/good").collect()) == list(range(5))
    with pytest.raises(Exception, match="without an id"):
        sink(spark.createDataFrame([(None,)], "id bigint"), 3)
    with pytest.raises(ValueError):
        OnceSink(spark, path, "id", good, late, delay_ms=5)


def test_the_slowest_source_commits(spark):
    hour = 3_600_000
    sink = TimePartitionSink(spark, fresh_dir(spark, "slowest"), "ms", source_col="p",
                             sources=["a", "b"])

    def send(number, *rows):
        sink(spark.createDataFrame(rows, "p string, ms bigint"), number)
        marks = spark.read.schema("dt string, hr string, batch int").parquet(f"{sink.path}/commits")
        return sorted((r["batch"], int(r["hr"])) for r in marks.collect())

    assert send(0, ("a", 5 * hour), ("a", 10)) == []            # b has not been seen
    assert send(1, ("b", 20)) == []
    assert send(2, ("b", hour + 10_001)) == [(2, 0), (2, 1)]   # a is at hour 5, b in hour 1
    assert send(3, ("a", 9 * hour), ("b", None)) == [(2, 0), (2, 1)]
    assert send(4, ("b", 6 * hour)) == [(2, 0), (2, 1), (4, 5)]
    assert send(4, ("b", 6 * hour)) == [(2, 0), (2, 1), (4, 5)]


def test_an_idle_source_holds_nothing_up(spark):
    hour = 3_600_000
    sink = TimePartitionSink(spark, fresh_dir(spark, "idle"), "ms", source_col="p", idle_ms=2 * hour)
    sink(spark.createDataFrame([("a", 0), ("b", 0)], "p string, ms bigint"), 0)
    sink(spark.createDataFrame([("a", hour + 10_001)], "p string, ms bigint"), 1)
    assert sink.committed().count() == 0
    sink(spark.createDataFrame([("a", 3 * hour)], "p string, ms bigint"), 2)
    assert sorted(r["hr"] for r in sink.committed().select(F.col("hr").cast("int")).collect()) == [0, 1]
