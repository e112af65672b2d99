"""Rows a store refuses, and buffers that are flushed by time."""

import math
import os
import threading
import time

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from changeflow.session import fresh_dir
from changeflow.sinks.batched import (
    PackingStore, halves, refused_rows, tables_of, write_isolated)
from changeflow.sinks.store import FolderStore, TimedBuffer, store_format
from changeflow.streaming.sources import table_stream


def batch(*values):
    return pa.RecordBatch.from_pydict({"x": list(values)})


def test_tables_of():
    tables = [t.column("x").to_pylist() for t in tables_of([batch(1, 2, 3), batch(4), batch(5, 6)], 4)]
    assert tables == [[1, 2, 3, 4], [5, 6]] and list(tables_of([], 4)) == []


@pytest.mark.parametrize("bad", [set(), {0}, {999}, {3, 4, 700}, set(range(0, 1000, 100))])
def test_halves_find_the_rows_at_fault(bad):
    stored, sends = [], []

    def send(table, name):
        sends.append(name)
        values = table.column("x").to_pylist()
        if bad & set(values):
            raise ValueError(f"{len(bad & set(values))} bad")
        stored.extend(values)

    found = list(halves(pa.table({"x": range(1000)}), send, "7", (ValueError,)))
    assert [t.column("x").to_pylist() for t, _ in found] == [[v] for v in sorted(bad)]
    assert stored == [v for v in range(1000) if v not in bad]
    assert len(set(sends)) == len(sends) and all(s.startswith("7") for s in sends)
    k = len(bad)
    assert len(sends) <= 1 + 2 * k * (math.log2(1000 / max(k, 1)) + 2)


def test_refused_rows_are_set_apart(spark):
    """Nulls and large numbers keep their values; passing errors are tried again."""
    path = fresh_dir(spark, "isolated")
    os.makedirs(f"{path}/good")

    def send(table, task, name):
        mark = f"{path}/{task}-{name}.tried"
        if name == "0" and not os.path.exists(mark):
            open(mark, "w").close()
            raise OSError("down for a moment")
        if any(v is None or v % 50 == 0 for v in table.column("id").to_pylist()):
            raise ValueError("refused")
        table.to_pandas().to_parquet(f"{path}/good/{task}-{name}.parquet")

    rows = spark.range(2 ** 60, 2 ** 60 + 1000, 1, 3).select(
        F.when(F.col("id") % 333 != 0, F.col("id")).alias("id"),
        F.struct(F.lit("a").alias("s"), F.array(F.lit(1.5)).alias("v")).alias("more"))
    seen = []
    numbers = write_isolated(rows, send, f"{path}/bad", size=100, base=0.0,
                             on_failure=lambda bad: seen.append(bad.count()))
    ids = [r["id"] for r in rows.collect()]
    want = [i for i in ids if i is None or i % 50 == 0]
    bad = refused_rows(spark, f"{path}/bad").collect()
    assert sorted(map(str, want)) == sorted(str(r["id"]) for r in bad)
    assert {(r["more"]["s"], r["more"]["v"][0], r["_reason"]) for r in bad} == {
        ("a", 1.5, "ValueError: refused")}
    good = [r["id"] for r in spark.read.parquet(f"{path}/good").collect()]
    assert sorted(good) == sorted(i for i in ids if i is not None and i % 50)
    assert numbers["stored"] == len(good) and numbers["refused"] == len(bad) == seen[0]
    assert write_isolated(rows.limit(0), send, f"{path}/none") == {
        "stored": 0, "refused": 0, "sends": 0}


def test_pieces_are_packed_into_few_files(spark):
    """Refused batches leave many small pieces; the number of files does not grow with them."""
    path = fresh_dir(spark, "isolated-packed")
    store = PackingStore(f"{path}/good", 1 << 12)

    def send(table, task, name):
        if any(v % 50 == 0 for v in table.column("id").to_pylist()):
            raise ValueError("refused")
        store.send(table, task, name)

    numbers = write_isolated(spark.range(0, 20_000, 1, 2), send, f"{path}/bad", size=100,
                             finish=store.finish)
    good = [r["id"] for r in spark.read.parquet(f"{path}/good").collect()]
    assert sorted(good) == [i for i in range(20_000) if i % 50]
    assert numbers["stored"] == len(good) and numbers["refused"] == 400
    assert refused_rows(spark, f"{path}/bad").count() == 400
    assert len(os.listdir(f"{path}/good")) == 6 and numbers["sends"] > 2000


def test_a_packing_store_may_be_sent_a_piece_again(tmp_path):
    store = PackingStore(str(tmp_path), 5)
    for name, rows in (("0", 2), ("0", 2), ("1.0", 1), ("1.1", 2), ("2", 1)):
        store.send(pa.table({"x": [name] * rows}), 3, name)
    store.finish(3)
    store.finish(3)
    found = {f: pq.read_table(tmp_path / f)["x"].to_pylist() for f in os.listdir(tmp_path)}
    assert found == {"3-0.parquet": ["0", "0", "1.0", "1.1", "1.1"], "3-1.parquet": ["2"]}


def test_other_errors_stop_the_job(spark):
    def send(table, task, name):
        raise KeyError("no such table")

    with pytest.raises(Exception, match="no such table"):
        write_isolated(spark.range(3), send, fresh_dir(spark, "isolated-stop"))


def test_a_buffer_is_flushed_by_size_and_at_the_end():
    sent = []
    buffer = TimedBuffer(lambda t, n: sent.append((n, t.column("x").to_pylist())), 3, None)
    buffer.add(batch(1, 2, 3, 4, 5, 6, 7))
    buffer.close()
    assert sent == [(0, [1, 2, 3]), (1, [4, 5, 6]), (2, [7])]


def test_a_buffer_is_flushed_while_no_rows_arrive():
    sent = []
    buffer = TimedBuffer(lambda t, n: sent.append((time.monotonic(), t.num_rows)), 100, 0.2)
    start = time.monotonic()
    buffer.add(batch(1, 2))
    time.sleep(0.1)
    buffer.add(batch(3))
    time.sleep(0.5)
    assert [rows for _, rows in sent] == [3] and 0.15 < sent[0][0] - start < 0.45
    buffer.add(batch(4))
    buffer.close()
    assert [rows for _, rows in sent] == [3, 1]
    assert not buffer.timer.is_alive() and threading.active_count() < 50


def test_an_error_in_a_background_flush_fails_the_next_write():
    def send(table, number):
        raise OSError("store is down")

    for then in (lambda b: b.add(batch(2)), lambda b: b.close()):
        buffer = TimedBuffer(send, 100, 0.05)
        buffer.add(batch(1))
        time.sleep(0.3)
        with pytest.raises(RuntimeError, match="background") as caught:
            then(buffer)
        assert "store is down" in str(caught.value.__cause__)


def slow_store(path):
    """A store that notes when batches arrive and fails where it is told to."""
    class Slow(FolderStore):  # local, so that tasks get it by value
        def stage(self, table, task, number):
            if "fail" in self.path and table.num_rows < 50:
                raise OSError("store is down")
            super().stage(table, task, number)
            open(f"{self.path}/staged/{task}/{number}.rows{table.num_rows}", "w").close()

    return Slow(path)


def slowly(df):
    def trickle(batches):
        for i, b in enumerate(batches):
            yield b
            time.sleep(0.6 if i % 2 == 0 else 0.0)

    # Wide rows, which pipes between processes pass on at once.
    wide = df.withColumn("pad", F.repeat(F.lit("x"), 20_000))
    return wide.mapInArrow(trickle, wide.schema)


@pytest.fixture
def small_batches(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set(name, "10")
    yield
    spark.conf.unset(name)


def staged(path):
    return sorted(f for _, _, files in os.walk(f"{path}/staged") for f in files if ".rows" in f)


def test_a_slow_task_is_flushed_in_between(spark, small_batches):
    store = slow_store(fresh_dir(spark, "slow"))
    store_format(spark, store, "slow_store", 1000, 0.2)
    rows = slowly(spark.range(0, 60, 1, 1))
    rows.write.format("slow_store").mode("append").save()
    assert sorted(r["id"] for r in store.rows(spark, "id bigint").collect()) == list(range(60))
    assert len(staged(store.path)) >= 3  # 60 rows are far below a full buffer


def test_a_failed_flush_in_the_background_fails_the_job(spark, small_batches):
    store = slow_store(fresh_dir(spark, "slow-fail"))
    store_format(spark, store, "failing_store", 50, 0.2)
    rows = slowly(spark.range(0, 130, 1, 2))
    with pytest.raises(Exception, match="background|store is down"):
        rows.write.format("failing_store").mode("append").save()
    assert store.published() == [] and staged(store.path) == []


def test_a_lost_task_leaves_nothing(spark):
    """One of three tasks fails after it has staged rows: no row is there afterwards."""
    store = FolderStore(fresh_dir(spark, "lost"))
    store_format(spark, store, "lost_store", 10, None)

    def failing(batches):
        for b in batches:
            yield b
            if b.column(0)[0].as_py() >= 200:
                raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        spark.range(0, 300, 1, 3).mapInArrow(failing, "id bigint") \
            .write.format("lost_store").mode("append").save()
    assert store.published() == []
    spark.range(0, 300, 1, 3).write.format("lost_store").mode("append").save()
    spark.range(300, 310).write.format("lost_store").mode("append").save()
    ids = [r["id"] for r in store.rows(spark, "id bigint").collect()]
    assert sorted(ids) == list(range(310))


def test_a_stream_publishes_each_batch_once(spark):
    source, store = fresh_dir(spark, "stored-in"), FolderStore(fresh_dir(spark, "stored-out"))
    for i in range(3):
        spark.range(i * 10, i * 10 + 10).coalesce(1).write.mode("append").parquet(source)
    store_format(spark, store, "stream_store", 4, 1.0)
    rows = table_stream(spark, source, "id bigint", 1)
    rows.writeStream.format("stream_store").option("checkpointLocation", f"{store.path}-checkpoint") \
        .trigger(availableNow=True).start().awaitTermination()
    # A batch that is asked for again replaces what it published.
    store.publish({}, "batch-7")
    ids = [r["id"] for r in store.rows(spark, "id bigint").collect()]
    assert sorted(ids) == list(range(30)) and isinstance(store.rows(spark, "id bigint").toPandas(), pd.DataFrame)
