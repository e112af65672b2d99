"""Streaming: restarts, replays, retractions and start modes."""

import datetime
import os
import random

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from changeflow.operators.changelog import apply_changelog
from changeflow.operators.counting import pv_uv
from changeflow.plans.jobs import run_pipeline
from changeflow.plans.streams import file_count
from changeflow.session import fresh_dir
from changeflow.streaming.counting import ContinuousPvUv, CountChanges
from changeflow.streaming.ledger import Ledger, UpsertTable
from changeflow.streaming.sinks import (
    TimePartitionSink, file_sink, read_files, run_stream, run_to_files)
from changeflow.streaming.sources import (
    change_stream, late_messages, of_tables, queue_stream, table_stream)

CHANGES = "op string, ts timestamp_ntz, app string, who bigint"


def changes(spark, seed, rows=400):
    draw = random.Random(seed)
    day = datetime.datetime(2024, 1, 1)
    # app "hot" and visitor 1 hold a third of the rows each; some values are null
    made = []
    for i in range(rows):
        app = "hot" if i % 3 == 0 else draw.choice(["a", "b", None])
        who = 1 if i % 3 == 1 else draw.choice([2, 3, 4, None])
        made.append((draw.choice(["+I", "+I", "+U", "-D"]),
                     day + datetime.timedelta(hours=draw.randrange(72)), app, who))
    return spark.createDataFrame(made, CHANGES)


def expected(df):
    """Counts from the sums of all additions and retractions."""
    n = F.sum(F.when(F.col("op") == "-D", -1).otherwise(1))
    per = df.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("dt"), "app", "who").agg(n.alias("n"))
    return {(r["dt"], r["app"]): (r["pv"], r["uv"]) for r in per.groupBy("dt", "app").agg(
        F.sum("n").alias("pv"),
        F.count(F.when((F.col("n") > 0) & F.col("who").isNotNull(), 1)).alias("uv"))
        .where("pv > 0").collect()}


def as_map(df):
    return {(r["dt"], r["app"]): (r["pv"], r["uv"]) for r in df.collect()}


def test_counts_follow_retractions_replays_and_folding(spark):
    batches = [changes(spark, seed) for seed in range(5)]
    counts = ContinuousPvUv(spark, fresh_dir(spark, "counts"), batches[0].schema, "ts", ["app"],
                            "who", fan=2)
    seen = batches[0].limit(0)
    for number, batch in enumerate(batches):
        counts.process(batch, number)
        counts.process(batch, number)  # a replay after a crash
        seen = seen.unionAll(batch)
        assert as_map(counts.current()) == expected(seen)


def test_counts_without_changes_match_batch(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    counts = ContinuousPvUv(spark, fresh_dir(spark, "plain"), events.schema, "ts", ["event_type"],
                            "user_id", grain="hour", op=None)
    updates = []
    counts.on_update = lambda rows, n: updates.append((n, rows.count()))
    for number, part in enumerate(events.randomSplit([0.5, 0.5], 3)):
        counts.process(part, number)
    both = counts.current().exceptAll(pv_uv(events, "ts", ["event_type"], "user_id", "hour"))
    assert both.isEmpty() and [n for n, _ in updates] == [0, 1] and all(r for _, r in updates)


def test_count_changes(spark):
    counter = CountChanges(spark, fresh_dir(spark, "count"))
    for number in range(2):
        counter.process(spark.range(1), number)
        counter.process(spark.range(1), number)
    counter.process(spark.range(0), 2)
    rows = [(r["is_add"], r["n"]) for r in counter.changes().orderBy("batch", "is_add").collect()]
    assert rows == [(True, 1), (False, 1), (True, 2)]


def test_many_count_changes_stay_in_few_folders(spark):
    counter = CountChanges(spark, fresh_dir(spark, "count-many"), fan=3)
    for number in range(10):
        counter.process(spark.range(1), number)
    rows = [(r["batch"], r["n"]) for r in counter.changes().where("is_add").orderBy("batch").collect()]
    assert rows == [(n, n + 1) for n in range(10)]
    assert counter.changes().count() == 19
    files = [r for r in counter.files.list(9) if r["file"] is not None]
    assert len(files) <= 6


def ledger_of(spark, label, fan=2, small=1 << 16):
    fields = changes(spark, 0).schema
    return Ledger(spark, fresh_dir(spark, label), [fields["app"]], ["n"], "app", fan, small)


def sums(ledger, before=None):
    rows = ledger.totals() if before is None else ledger.totals(before)
    return {r["app"]: r["n"] for r in rows.collect()}


def test_ledger_ignores_files_without_a_list(spark):
    ledger = ledger_of(spark, "ledger")
    rows = spark.createDataFrame([("a", 1), ("b", 2), (None, 5)], "app string, n bigint")
    for number in range(3):
        for _ in range(2):  # a batch that is run again
            ledger.append(rows, number)
    rows.write.parquet(f"{ledger.path}/files/run=3")  # a batch that was lost before its list
    assert sums(ledger) == {"a": 3, "b": 6, None: 15}
    assert sums(ledger, 1) == {"a": 1, "b": 2, None: 5}
    assert sums(ledger, 0) == {}
    ledger.append(rows, 3)
    assert sums(ledger) == {"a": 4, "b": 8, None: 20}


def live(ledger):
    return [r for r in ledger.files.list(ledger.files.last()) if r["file"] is not None]


def test_runs_grow_with_the_logarithm_of_the_batches(spark):
    ledger = ledger_of(spark, "ledger-levels", fan=3)
    rows = spark.createDataFrame([("a", 1), ("b", -1), ("b", 1)], "app string, n bigint").coalesce(1)
    for number in range(13):
        ledger.append(rows, number)
        assert sums(ledger) == {"a": number + 1, "b": 0} or sums(ledger) == {"a": number + 1}
        runs = {(r["level"], r["run"]) for r in live(ledger)}
        assert len(runs) <= 2 * 3  # fewer than three a level, three levels for 13 batches
    folder = ledger.path.removeprefix("file:")
    assert len(os.listdir(f"{folder}/lists")) <= 2 * (ledger.files.keep + 1)
    assert len([f for f in os.listdir(f"{folder}/files") if "=" in f]) <= 4 * ledger.files.keep


def test_files_of_untouched_days_keep_their_names(spark):
    """Old days are written once; merges of later batches do not touch their files."""
    ledger = ledger_of(spark, "ledger-days", fan=2, small=0)
    kept = None
    for number in range(8):
        days = [f"2024-01-0{1 + number % 2}"] if number < 2 else [f"2024-02-{number:02}", "2024-03-01"]
        ledger.append(spark.createDataFrame([(d, 1) for d in days], "app string, n bigint"), number)
        old = {r["file"] for r in live(ledger) if r["high"] is not None and r["high"] < "2024-02"}
        assert len(old) == min(number + 1, 2) and (kept is None or number < 2 or old == kept)
        kept = old
    assert sums(ledger)["2024-03-01"] == 6 and sums(ledger)["2024-01-01"] == 1
    met = ledger.before(8, ["2024-01-02"]).inputFiles()
    assert len(met) == 1 and ledger.before(8, ["2023-01-01"]).count() == 0
    march = [r for r in live(ledger) if r["high"] == "2024-03-01"]
    assert len({r["run"] for r in march}) <= 4


def test_nulls_have_a_file_with_an_open_end(spark):
    ledger = ledger_of(spark, "ledger-nulls", fan=2, small=0)
    for number in range(5):
        ledger.append(spark.createDataFrame([(None, 1), ("x", 1)], "app string, n bigint"), number)
    assert sums(ledger) == {None: 5, "x": 5}
    assert ledger.before(5, [None]).where("app IS NULL").agg({"n": "sum"}).first()[0] == 5
    assert ledger.before(5, ["x"]).where("app = 'x'").agg({"n": "sum"}).first()[0] == 5


@pytest.mark.parametrize("strategy, ignore_delete", [("update", False), ("insert", True)])
def test_upsert_table_follows_batches(spark, strategy, ignore_delete):
    """Replays, folds and a hot key; the same as all changes applied at once."""
    row, draw = "k int, v string", random.Random(strategy)
    start = spark.createDataFrame([(k, "start") for k in range(0, 20, 2)], row)
    schema = spark.createDataFrame([], f"op string, at int, {row}").schema
    table = UpsertTable(spark, fresh_dir(spark, "upsert"), start.schema, ["k"], schema, ["at"],
                        strategy, ignore_delete, fold_every=2)
    table.create(start)
    table.create(start)
    seen = []
    for number in range(6):
        made = [(draw.choice(["+I", "-U", "+U", "-D"]), i, 7 if i % 3 == 0 else draw.randrange(20),
                 f"v{number}-{i}") for i in range(40)]
        batch = spark.createDataFrame(made, schema)
        for _ in range(2):
            table.process(batch, number)
        seen += [(op, number * 100 + at, k, v) for op, at, k, v in made]
        at_once = apply_changelog(start, spark.createDataFrame(seen, schema), ["k"], ["at"],
                                  strategy, ignore_delete)
        assert sorted(map(tuple, table.current().collect())) == sorted(map(tuple, at_once.collect()))
    with pytest.raises(ValueError):
        UpsertTable(spark, "x", start.schema, ["k"], start.schema, ["at"])


def write_parts(spark, path, parts, rows=100):
    for i in range(parts):
        spark.range(i * rows, (i + 1) * rows).coalesce(1).write.mode("append").parquet(path)


def test_stream_survives_a_crash_between_batches(spark):
    source, out = fresh_dir(spark, "crash-in"), fresh_dir(spark, "crash-out")
    write_parts(spark, source, 4)
    write = file_sink(out)
    crashed = []

    def flaky(batch, number):
        write(batch, number)
        if number == 2 and not crashed:
            crashed.append(number)
            raise RuntimeError("executor lost")  # written, but not yet checkpointed

    def run():
        rows = table_stream(spark, source, "id bigint", 1)
        run_stream(rows, flaky, f"{out}-checkpoint").awaitTermination()

    with pytest.raises(StreamingQueryException):
        run()
    run()
    back = read_files(spark, out)
    assert back.count() == 400 and back.select("id").distinct().count() == 400


def test_queue_needs_ids(spark):
    source = fresh_dir(spark, "no-ids")
    spark.createDataFrame([(1,), (None,)], "id bigint").write.parquet(source)
    stream = queue_stream(table_stream(spark, source, "id bigint"), "id")
    out = fresh_dir(spark, "no-ids-out")
    with pytest.raises(StreamingQueryException, match="without an id"):
        run_stream(stream, file_sink(out), f"{out}-checkpoint").awaitTermination()


def test_queue_with_a_hot_id(spark):
    source, out = fresh_dir(spark, "hot-id"), fresh_dir(spark, "hot-id-out")
    ids = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("id"))
    ids.write.parquet(source)
    stream = queue_stream(table_stream(spark, source, "id bigint", 2), "id")
    run_stream(stream, file_sink(out), f"{out}-checkpoint").awaitTermination()
    assert sorted(r["id"] for r in read_files(spark, out).collect()) == \
        sorted({0 if i % 3 == 0 else i for i in range(9000)})


IMAGE = "k bigint, v string"


def envelopes(spark, path, rows):
    spark.createDataFrame([(r,) for r in rows], "value string").coalesce(1) \
        .write.mode("append").text(path)


def envelope(key, db="d0", table="orders"):
    return (f'{{"after":{{"k":{key},"v":"x"}},'
            f'"source":{{"ts_ms":{key},"db":"{db}","table":"{table}"}}}}')


def test_change_stream_start_modes(spark):
    source, out = fresh_dir(spark, "latest"), fresh_dir(spark, "latest-out")
    envelopes(spark, source, [envelope(1), envelope(2)])
    since = datetime.datetime.now(datetime.timezone.utc) + datetime.timedelta(days=1)
    past = since - datetime.timedelta(days=2)
    for number, (start, count) in enumerate(((since, 0), (past, 2))):
        stream = change_stream(spark, IMAGE, source, startup="latest", since=start)
        target = f"{out}-{number}"
        run_stream(stream, file_sink(target), f"{target}-checkpoint").awaitTermination()
        rows = spark.read.schema("source struct<ts_ms:bigint>").parquet(target).count() if count else 0
        assert rows == count
    for arguments in ({"startup": "timestamp"}, {"startup": "latest"}):
        with pytest.raises(ValueError):
            change_stream(spark, IMAGE, source, **arguments)


def test_table_names_match_whole(spark):
    df = spark.sql("""select struct(1L as ts_ms, db, table) as source from values
        ('d0','orders'), ('d0','orders_old'), ('d1','orders'), ('xd0','orders') as t(db, table)""")
    kept = of_tables(df, ["d0"], ["orders", "none"]).collect()
    assert [(r["source"]["db"], r["source"]["table"]) for r in kept] == [("d0", "orders")]


def test_unreadable_changes(spark):
    source, out = fresh_dir(spark, "torn"), fresh_dir(spark, "torn-out")
    envelopes(spark, source, [envelope(1), "{torn"])
    stream = change_stream(spark, IMAGE, source)
    with pytest.raises(StreamingQueryException):
        run_stream(stream, file_sink(out), f"{out}-checkpoint").awaitTermination()
    tolerant = change_stream(spark, IMAGE, source, on_error="quarantine")
    run_stream(tolerant, file_sink(f"{out}2"), f"{out}2-checkpoint").awaitTermination()
    assert read_files(spark, f"{out}2").count() == 1


def test_partition_commits(spark):
    hour = 3_600_000
    told = []
    sink = TimePartitionSink(spark, fresh_dir(spark, "commits"), "ms", "Asia/Shanghai",
                             on_commit=lambda marks, n: told.append((n, marks.count())))

    def send(number, *times):
        sink(spark.createDataFrame([(t,) for t in times], "ms bigint"), number)
        return sorted((r["dt"], r["hr"]) for r in sink.committed().collect())

    first, second = ("1970-01-01", "08"), ("1970-01-01", "09")
    assert send(0, 5_000) == []                      # its own start + 10 s has not passed
    assert send(1, hour + 10_000) == [first]         # exactly at the delay: not yet
    assert send(2, hour + 10_001) == [first, second]
    assert send(2, hour + 10_001) == [first, second]  # replay
    assert send(3, 7_000) == [first, second]         # late rows are written and marked again
    assert sink.rows().count() == 4 and sink.rows(committed=True).count() == 4
    assert told == [(1, 1), (2, 1), (2, 1), (3, 1)]
    send(4, 3 * hour)
    assert sink.rows().count() == 5 and sink.rows(committed=True).count() == 4


def test_pipeline_stops_at_the_first_failure(spark):
    ran = []
    with pytest.raises(Exception, match="no_such_table"):
        run_pipeline(spark, ["SELECT 1", lambda s: ran.append(1), "SELECT * FROM no_such_table",
                             lambda s: ran.append(2)])
    assert ran == [1]
    assert run_pipeline(spark, ["CREATE OR REPLACE TEMP VIEW v AS SELECT 7 AS x",
                                "SELECT x FROM v"]).first()["x"] == 7


def test_a_fold_rewrites_touched_buckets_only(spark):
    start = spark.range(1000).select(F.col("id").alias("k"), F.lit(0).cast("bigint").alias("v"))
    schema = StructType.fromDDL("k bigint, v bigint, op string, at bigint")
    path = fresh_dir(spark, "buckets")
    table = UpsertTable(spark, path, start.schema, ["k"], schema, ["at"], "insert",
                        ignore_delete=False, fold_every=1, buckets=8)

    def files(bucket):
        return {f.removeprefix("file:") for f in table.files.files(1 << 40, [bucket]).inputFiles()}

    table.create(start)
    touched = table.files.touched(start.where("k IN (3, 5)"))
    before = {b: files(b) for b in range(8)}
    expected = {k: 0 for k in range(1000)}
    for batch, rows in enumerate([[(3, 7, "+U", 1)], [(5, 9, "+U", 2), (3, 0, "-D", 3)], [],
                                  [(5, 1, "+U", 4)]]):
        for _ in range(2):  # each batch is delivered twice
            table.process(spark.createDataFrame(rows, schema), batch)
        for k, v, op, _ in rows:
            expected.pop(k) if op == "-D" else expected.update({k: v})
        assert {r["k"]: r["v"] for r in table.current().collect()} == expected
    assert all(files(b) == before[b] and len(before[b]) == 1 for b in range(8) if b not in touched)
    assert all(files(b) != before[b] for b in touched)
    # Files that the last two bases do without are gone.
    there = [f for _, _, names in os.walk(f"{path}/base-8") for f in names if f.endswith(".parquet")]
    assert len(there) <= 8 + 2 * len(touched)


def test_buckets_split_when_they_grow(spark):
    """The table grows tenfold; it is the same for a reader that has only the path."""
    schema = StructType.fromDDL("k bigint, v bigint, op string, at bigint")
    row = StructType(schema.fields[:2])
    path = fresh_dir(spark, "splits")

    def open_table():
        return UpsertTable(spark, path, row, ["k"], schema, ["at"], "insert", fold_every=1,
                           buckets=2, bucket_rows=100)

    table, expected, counts = open_table(), {}, []
    for batch in range(6):
        rows = spark.range(batch * 90, batch * 180 + 180).select(
            F.col("id").alias("k"), F.lit(batch).cast("bigint").alias("v"), F.lit("+U").alias("op"),
            F.col("id").alias("at"))
        table.process(rows, batch)
        expected |= {k: batch for k in range(batch * 90, batch * 180 + 180)}
        counts.append(table.files.count())
        assert {r["k"]: r["v"] for r in open_table().current().collect()} == expected
    assert counts[0] == 2 and counts[-1] >= 8 and sorted(counts) == counts
    assert max(r["n"] for r in table.current().groupBy(F.pmod(F.hash("k"), F.lit(counts[-1]))).agg(
        F.count("*").alias("n")).collect()) < 300


def test_a_read_does_not_move_the_base(spark):
    """Only the changes are exchanged, as many ways as the base has buckets."""
    start = spark.range(5000).select(F.col("id").alias("k"), F.lit(0).cast("bigint").alias("v"))
    schema = StructType.fromDDL("k bigint, v bigint, op string, at bigint")
    table = UpsertTable(spark, fresh_dir(spark, "unmoved"), start.schema, ["k"], schema, ["at"],
                        "insert", ignore_delete=False, fold_every=2, buckets=8)
    table.create(start)
    table.process(spark.createDataFrame([(1, 1, "+U", 1), (9000, 2, "+I", 2), (2, 0, "-D", 3)], schema), 0)
    now = table.current()
    plan = now._jdf.queryExecution().executedPlan().toString()
    lines = plan.split("== Initial Plan ==")[-1].splitlines()
    scans = [n for n, line in enumerate(lines) if "Bucketed: true" in line]
    assert len(scans) == 1

    def depth(line):
        return len(line) - len(line.lstrip(" :+-|"))

    around, at = [], depth(lines[scans[0]])
    for line in reversed(lines[:scans[0]]):  # the operators over the scan, up to the join
        if depth(line) < at:
            at = depth(line)
            around.append(line)
            if "Join" in line:
                break
    assert "Join" in around[-1] and not any("Exchange" in line for line in around)
    assert any("Exchange hashpartitioning(k#" in line and ", 8)" in line for line in lines)
    got = {r["k"]: r["v"] for r in now.collect()}
    assert len(got) == 5000 and got[1] == 1 and got[9000] == 2 and 2 not in got


def test_a_replayed_pipeline_batch_replaces_its_rows(spark):
    path = fresh_dir(spark, "replayed")
    sink = file_sink(path)
    for _ in range(3):
        sink(spark.range(10), 0)
    sink(spark.range(10, 15), 1)
    assert sorted(r["id"] for r in read_files(spark, path).collect()) == list(range(15))


def test_late_messages_are_counted(spark):
    source, out = fresh_dir(spark, "late-source"), fresh_dir(spark, "late-out")
    schema = "id bigint, at timestamp"
    for rows in ([(1, "2024-01-10"), (1, "2024-01-10")], [(2, "2024-01-20")], [(3, "2024-01-01")],
                 [(4, "2024-01-21")]):
        spark.createDataFrame(rows, "id bigint, day string").select(
            "id", F.to_timestamp("day").alias("at")).coalesce(1).write.mode("append").parquet(source)
    once = queue_stream(table_stream(spark, source, schema, 1), "id", "at", "1 day")
    query = run_to_files(once, out, f"{out}-checkpoint")
    query.awaitTermination()
    kept = {r["id"] for r in spark.read.parquet(out).collect()}
    assert kept | {3} == {1, 2, 3, 4} and late_messages(query) == 4 - len(kept)


@pytest.mark.parametrize("rows, files", [(0, 4), (1000, 4), (6_000_000, 4), (72_000_000, 35)])
def test_a_replayed_table_has_few_files(spark, rows, files):
    """A batch costs its start and a look at the state, whatever its size."""
    assert file_count(spark.range(rows)) == files
