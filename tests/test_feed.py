"""The hand-off from a snapshot to the changes after it."""

import json
import os
import random

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql.types import LongType, StringType, StructField, StructType

from changeflow.session import fresh_dir
from changeflow.streaming.feed import POSITIONS, InitialFeed, row_changes
from changeflow.streaming.ledger import UpsertTable

IMAGE = "k bigint, v string"
ROW = StructType([StructField("k", LongType()), StructField("v", StringType())])


def put(spark, path, number, rows, age):
    """One file of envelopes; ``age`` seconds is how old it is."""
    body = [json.dumps({**({"before": b} if b else {}), **({"after": a} if a else {}),
                        "source": {"ts_ms": 0, "db": "d", "table": "t"}}) for b, a in rows]
    os.makedirs(path, exist_ok=True)
    name = f"{path}/f{number:03}.txt"
    with open(name, "w") as out:
        out.write("\n".join(body) + "\n")
    os.utime(name, (2_000_000_000 - age, 2_000_000_000 - age))


def follower(spark, path, every=2):
    changes = StructType([StructField("op", StringType()), StructField("position", POSITIONS),
                          *ROW.fields])
    return UpsertTable(spark, f"{path}/table", ROW, ["k"], changes, ["position"], "insert",
                       ignore_delete=False, fold_every=every, buckets=4)


def state(table):
    return {r["k"]: r["v"] for r in table.current().collect()}


@pytest.mark.parametrize("files_per_batch", [1, 3, None])
def test_changes_follow_the_snapshot_in_their_order(spark, files_per_batch):
    """Changes that are older on disk than the snapshot, and names that do not sort by age."""
    path = fresh_dir(spark, "feed")
    draw = random.Random(files_per_batch)
    now = {k: "snapshot" for k in range(30)}
    for n in range(3):
        put(spark, f"{path}/snapshot", n, [(None, {"k": k, "v": v}) for k, v in now.items()
                                           if k % 3 == n], age=n)
    for n in range(4):
        rows = []
        for i in range(40):
            k = 7 if i % 3 == 0 else draw.randrange(40)
            old = now.pop(k, None)
            if old is None or draw.random() < 0.7:
                now[k] = f"{n}-{i}"
                rows.append((old and {"k": k, "v": old}, {"k": k, "v": now[k]}))
            else:
                rows.append(({"k": k, "v": old}, None))
        put(spark, f"{path}/log", 9 - n, rows, age=100_000 - n)
    feed = InitialFeed(spark, IMAGE, f"{path}/checkpoint", f"{path}/snapshot", f"{path}/log",
                       files_per_batch=files_per_batch)
    table = follower(spark, path)
    feed.run(lambda b, n: table.process(row_changes(b), n)).awaitTermination()
    assert state(table) == now
    assert feed.handed_over() == (1 if files_per_batch in (None, 3) else 3)


def test_a_crash_in_either_phase_goes_on_where_it_stopped(spark):
    path = fresh_dir(spark, "feed-crash")
    for n in range(3):
        put(spark, f"{path}/snapshot", n, [(None, {"k": n, "v": "old"})], age=50 - n)
    for n in range(3):
        put(spark, f"{path}/log", n, [({"k": n, "v": "old"}, {"k": n, "v": "new"})], age=10 - n)
    table, numbers, broken = follower(spark, path), [], {1, 4}

    def sink(batch, number):
        numbers.append(number)
        table.process(row_changes(batch), number)
        if number in broken:
            broken.discard(number)
            raise RuntimeError("lost after the write")

    def run():
        feed = InitialFeed(spark, IMAGE, f"{path}/checkpoint", f"{path}/snapshot", f"{path}/log",
                           files_per_batch=1)
        feed.run(sink).awaitTermination()
        return feed

    for _ in range(2):
        with pytest.raises(StreamingQueryException):
            run()
    assert run().handed_over() == 3
    assert numbers == [0, 1, 1, 2, 3, 4, 4, 5]
    assert state(table) == {n: "new" for n in range(3)}
    put(spark, f"{path}/snapshot", 9, [(None, {"k": 0, "v": "too late"})], age=0)
    put(spark, f"{path}/log", 9, [({"k": 1, "v": "new"}, None)], age=0)
    run()
    assert numbers[8:] == [6] and state(table) == {0: "new", 2: "new"}


def test_a_feed_without_a_snapshot_file(spark):
    path = fresh_dir(spark, "feed-empty")
    os.makedirs(f"{path}/snapshot")
    put(spark, f"{path}/log", 0, [(None, {"k": 1, "v": "x"})], age=0)
    table = follower(spark, path)
    feed = InitialFeed(spark, IMAGE, f"{path}/checkpoint", f"{path}/snapshot", f"{path}/log")
    feed.run(lambda b, n: table.process(row_changes(b), n)).awaitTermination()
    assert feed.handed_over() == 0 and state(table) == {1: "x"}
