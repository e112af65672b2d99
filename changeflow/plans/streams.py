"""Streaming jobs: tables are replayed in several files until no input is left."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from changeflow.functions.time import DAY, epoch_ms
from changeflow.operators import changelog as L
from changeflow.operators.counting import pv_uv
from changeflow.operators.metrics import watched
from changeflow.operators.shaping import (
    as_envelopes, explode_json, extract_attributes, flatten_trace, normalize_envelope, parse_json)
from changeflow.plans import derived as D
from changeflow.plans.changes import ORDER, replay_sql
from changeflow.plans.jobs import run_pipeline
from changeflow.plans.registry import load, query
from changeflow.plans.shapes import NOW_MS
from changeflow.session import fresh_dir, ship_package, written
from changeflow.sinks.files import index_name, routed
from changeflow.sinks.index import Index
from changeflow.sources.splits import split_range
from changeflow.streaming.counting import ContinuousPvUv, CountChanges
from changeflow.streaming.feed import POSITIONS, InitialFeed, row_changes
from changeflow.streaming.ledger import UpsertTable
from changeflow.streaming.once import OnceSink
from changeflow.streaming.queue import SpoolQueue, queue_messages
from changeflow.streaming.sinks import (
    TimePartitionSink, file_sink, parsed_sink, read_files, run_stream, run_to_files, write_all)
from changeflow.streaming.sources import (
    change_stream, json_stream, queue_stream, table_stream, text_stream)

FILES, FILE_ROWS = 4, 1 << 21


def file_count(df):
    """Files for a replayed table: a few, and more as it grows."""
    return max(FILES, -(-df.count() // FILE_ROWS))


def replay(df, path, order, fmt="parquet"):
    """Write a table as files that are each a range of ``order``."""
    df.repartitionByRange(file_count(df), order).write.format(fmt).save(path)
    return path


def replay_in_order(df, path, order):
    """The same with each file written after the one before, as a log grows.

    A file has a bounded part of the rows, so one task writes it.
    """
    rows = written(df, "log")
    low, high = rows.agg(F.min(order), F.max(order)).first()
    for first, last in split_range(low, high, file_count(rows)):
        rows.where(F.col(order).between(first, last)).coalesce(1) \
            .write.mode("append").parquet(path)


def _messages(spark, sf_dir, name="messages"):
    path = fresh_dir(spark, name)
    rows = D.event_rows(spark, sf_dir)
    body = F.to_json(F.struct(*rows.columns))
    texts = rows.select("ts_ms", body.alias("value"))
    texts.repartitionByRange(file_count(rows), "ts_ms").select("value").write.text(path)
    return path


_EVENT_ROWS_SQL = "SELECT event_id, user_id, event_type, value, epoch_us(ts) // 1000 AS ts_ms FROM events"


@query("stream_json_topic", _EVENT_ROWS_SQL)
def stream_json_topic(spark, sf_dir):
    """JSON lines of a declared schema, read as a stream into a table."""
    source = _messages(spark, sf_dir)
    rows = json_stream(spark, D.EVENT_ITEM, source, options={"maxFilesPerTrigger": "1"})
    out = fresh_dir(spark, "topic-rows")
    run_to_files(rows, out, f"{out}-checkpoint").awaitTermination()
    return spark.read.parquet(out)


@query("stream_torn_messages", """SELECT CASE event_id % 5 WHEN 0 THEN 'torn' WHEN 1 THEN 'blank'
      WHEN 2 THEN 'null' ELSE 'row' END AS kind, count(*) AS n,
    CAST(sum(CASE WHEN event_id % 5 > 2 THEN event_id ELSE 0 END) AS BIGINT) AS ids FROM events GROUP BY 1""")
def stream_torn_messages(spark, sf_dir):
    """Torn, blank and null messages are set apart; with the rows they add up to the input."""
    source, out = fresh_dir(spark, "torn-messages"), fresh_dir(spark, "torn")
    rows = D.event_rows(spark, sf_dir)
    body, at = F.to_json(F.struct(*rows.columns)), F.col("event_id") % 5
    texts = rows.select("event_id", F.when(at == 0, F.expr(
        "substring(to_json(struct(*)), 1, 12)")).when(at == 1, "  ").when(at == 2, "null")
        .otherwise(body).alias("value"))
    replay(texts, source, "event_id")
    stream = table_stream(spark, source, texts.schema, 1).select("value")
    sink = parsed_sink(D.EVENT_ITEM, file_sink(f"{out}/good"), file_sink(f"{out}/bad"))
    run_stream(stream, sink, f"{out}-checkpoint").awaitTermination()
    good = read_files(spark, f"{out}/good").select(F.lit("row").alias("kind"), "event_id")
    text = F.trim("value")
    bad = read_files(spark, f"{out}/bad").select(
        F.when(text == "", "blank").when(text == "null", "null").otherwise("torn").alias("kind"),
        F.lit(0).cast("bigint").alias("event_id"))
    return good.unionByName(bad).groupBy("kind").agg(
        F.count("*").alias("n"), F.sum("event_id").alias("ids"))


@query("stream_array_messages", """SELECT strftime(ts, '%Y-%m-%d') AS dt, event_type,
    count(*) AS pv, count(DISTINCT user_id) AS uv FROM events GROUP BY 1, 2""")
def stream_array_messages(spark, sf_dir):
    """JSON array messages to rows as a stream; daily counts over what arrived."""
    source = fresh_dir(spark, "array-messages")
    packed = D.packed_events(spark, sf_dir)
    replay(packed, source, "message_id")
    arrays = table_stream(spark, source, packed.schema, 1)
    rows = explode_json(arrays, "body", D.EVENT_ITEM)
    out = fresh_dir(spark, "array-rows")
    run_stream(rows, file_sink(out), f"{out}-checkpoint").awaitTermination()
    timed = read_files(spark, out).withColumn("ts", F.timestamp_millis("ts_ms"))
    return pv_uv(timed, "ts", ["event_type"], "user_id")


@query("stream_table_source", """SELECT strftime(ts, '%Y-%m-%d') AS dt, count(*) AS n,
    max(event_id) AS last_id FROM events GROUP BY 1""")
def stream_table_source(spark, sf_dir):
    """All day partitions of a table, read as a stream."""
    source, out = fresh_dir(spark, "days"), fresh_dir(spark, "followed")
    load(spark, sf_dir, "events").select("event_id", F.date_format("ts", DAY).alias("dt")) \
        .write.partitionBy("dt").parquet(source)
    rows = table_stream(spark, source, "event_id bigint, dt string", 10)
    run_to_files(rows, out, f"{out}-checkpoint").awaitTermination()
    return spark.read.parquet(out).groupBy("dt").agg(
        F.count("*").alias("n"), F.max("event_id").alias("last_id"))


@query("stream_dedupe", "SELECT event_id, user_id, event_type FROM events")
def stream_dedupe(spark, sf_dir):
    """Messages delivered twice are kept once, by id."""
    source, out = fresh_dir(spark, "twice"), fresh_dir(spark, "once")
    events = load(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    replay(events.unionAll(events), source, "event_id")
    once = queue_stream(table_stream(spark, source, events.schema, 2), "event_id")
    run_to_files(once, out, f"{out}-checkpoint").awaitTermination()
    return spark.read.parquet(out)


@query("stream_dedupe_in_delay", "SELECT event_id, event_type FROM events")
def stream_dedupe_in_delay(spark, sf_dir):
    """The same with ids forgotten some time after their message's; files may come unordered."""
    source, out = fresh_dir(spark, "twice-timed"), fresh_dir(spark, "once-timed")
    events = load(spark, sf_dir, "events").select(
        "event_id", "event_type", F.timestamp_millis(epoch_ms(F.col("ts"))).alias("at"))
    replay(events.unionAll(events), source, "at")
    stream = table_stream(spark, source, events.schema, 1)
    once = queue_stream(stream, "event_id", "at", "40 days")
    run_stream(once, file_sink(out), f"{out}-checkpoint").awaitTermination()
    return read_files(spark, out).select("event_id", "event_type")


# ---- change streams ---------------------------------------------------------

_IMAGE = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double"


def _envelope_files(spark, sf_dir):
    path = fresh_dir(spark, "envelopes")
    envelopes = D.order_envelopes(spark, sf_dir)
    texts = envelopes.select(F.to_json(F.struct("before", "after", "source")).alias("value"))
    return replay(texts, path, "value", fmt="text")


@query("stream_changelog", f"""WITH {D.ENVELOPES_SQL}
    SELECT o_orderkey, o_totalprice FROM orders WHERE o_custkey % 2 = 0 AND o_orderkey % 4 = 3
    UNION ALL SELECT o_orderkey, o_totalprice FROM env WHERE db = 'd0' AND kind IN (0, 1)""")
def stream_changelog(spark, sf_dir):
    """Snapshot inserts and then the changes of one database; the table they leave.

    Of the snapshot only rows no change touches, or that were updated, remain.
    """
    source, out = _envelope_files(spark, sf_dir), fresh_dir(spark, "orders-changes")
    rows = load(spark, sf_dir, "orders").where("o_orderkey % 4 <> 0").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    old = as_envelopes(rows, F.concat(F.lit("d"), (F.col("o_custkey") % 2).cast("string")),
                       "orders")
    backfill = fresh_dir(spark, "orders-snapshot")
    old.select(F.to_json(F.struct("before", "after", "source")).alias("value")) \
        .write.text(backfill)
    feed = InitialFeed(spark, _IMAGE, f"{out}-checkpoint", backfill, source, ["d0"], ["ord.*"],
                       files_per_batch=2)
    write = file_sink(out)
    feed.run(lambda batch, number: write(row_changes(batch), number)).awaitTermination()
    rows = spark.read.parquet(out)
    return L.materialize(rows, ["o_orderkey"], ["batch", "position"]) \
        .select("o_orderkey", "o_totalprice")


@query("stream_initial_changes", """SELECT o_orderkey, o_custkey,
    CASE o_orderkey % 6 WHEN 0 THEN 'one' WHEN 1 THEN 'two' WHEN 3 THEN 'back' WHEN 4 THEN 'new'
      ELSE 'old' END AS o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 6 <> 2""")
def stream_initial_changes(spark, sf_dir):
    """A table kept from its snapshot on, both in several files and one file a batch.

    Keys are changed up to three times, in different files, all at one time. By key
    modulo 6: changed once, twice, deleted, deleted and put back, new, untouched.
    """
    out = fresh_dir(spark, "initial")
    orders = load(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.lit("old").alias("o_orderstatus"), "o_totalprice")
    key = F.col("o_orderkey") % 6

    def write(path, rows, before, after):
        image = F.struct(*orders.columns)
        named = {"before": before, "after": after}
        sides = [F.lit(None).cast(orders.select(image.alias("r")).schema["r"].dataType).alias(side)
                 if status is None else
                 image.withField("o_orderstatus", F.lit(status)).alias(side)
                 for side, status in named.items()]
        source = F.struct(F.lit(0).cast("bigint").alias("ts_ms"), F.lit("d0").alias("db"),
                          F.lit("orders").alias("table")).alias("source")
        rows.repartition(2, "o_orderkey").select(F.to_json(F.struct(*sides, source)).alias("value")) \
            .write.mode("append").text(path)

    snapshot, log = f"{out}/snapshot", f"{out}/log"
    for part in range(3):
        write(snapshot, orders.where((key != 4) & (F.col("o_custkey") % 3 == part)), None, "old")
    write(log, orders.where(key.isin(0, 1)), "old", "one")
    write(log, orders.where(key.isin(2, 3)), "old", None)
    write(log, orders.where(key == 1), "one", "two")
    write(log, orders.where(key == 4), None, "new")
    write(log, orders.where(key == 3), None, "back")
    feed = InitialFeed(spark, _IMAGE, f"{out}/checkpoint", snapshot, log, files_per_batch=3)
    changes = StructType([StructField("op", StringType()), StructField("position", POSITIONS),
                          *orders.schema.fields])
    table = UpsertTable(spark, f"{out}/table", orders.schema, ["o_orderkey"], changes, ["position"],
                        "insert", ignore_delete=False, fold_every=3, buckets=8)
    feed.run(lambda batch, number: table.process(row_changes(batch), number)).awaitTermination()
    return table.current()


@query("stream_route_changes", f"""WITH {D.ENVELOPES_SQL}
    SELECT 'cdc.' || db || '.orders' AS topic, count(*) AS n,
      count(CASE WHEN kind = 1 THEN 1 END) AS updates FROM env WHERE kind < 3 GROUP BY 1""")
def stream_route_changes(spark, sf_dir):
    """Change stream to normalised details to one topic per table, in one stream."""
    source, out = _envelope_files(spark, sf_dir), fresh_dir(spark, "routed-stream")
    stream = change_stream(spark, _IMAGE, source, files_per_batch=1)
    topics = routed(normalize_envelope(stream, NOW_MS), "cdc")
    run_stream(topics, file_sink(out, ["topic"], "text"), f"{out}-checkpoint").awaitTermination()
    lines = spark.read.schema("value string, topic string").format("text").load(out)
    return lines.groupBy("topic").agg(
        F.count("*").alias("n"),
        F.count(F.when(F.get_json_object("value", "$.op") == "u", 1)).alias("updates"))


@query("stream_upsert", replay_sql("ch.op IN ('+I', '+U')", "ch.op IN ('+I', '+U')",
                                   "ch.op = '-D'"))
def stream_upsert(spark, sf_dir):
    """A table that follows a streamed changelog, folded every second batch."""
    source, out = fresh_dir(spark, "customer-changes"), fresh_dir(spark, "customer-table")
    changes, customer = D.customer_changes(spark, sf_dir), load(spark, sf_dir, "customer")
    replay_in_order(changes, source, "event_id")
    table = UpsertTable(spark, out, customer.schema, ["c_custkey"], changes.schema, ORDER,
                        "insert", ignore_delete=False, fold_every=2, buckets=8)
    table.create(customer)
    stream = table_stream(spark, source, changes.schema, 1)
    run_stream(stream, table.process, f"{out}-checkpoint").awaitTermination()
    return table.current()


# ---- continuous counts ------------------------------------------------------

_VISITS_SQL = f"""WITH {D.USER_CHANGES_SQL},
    n AS (SELECT strftime(ts, '%Y-%m-%d') AS dt, event_id % 5 AS app, user_id,
            sum(CASE WHEN op IN ('-U', '-D') THEN -1 ELSE 1 END) AS n
          FROM changes GROUP BY 1, 2, 3)
    SELECT dt, app, CAST(sum(n) AS BIGINT) AS pv, count(CASE WHEN n > 0 THEN 1 END) AS uv
    FROM n GROUP BY 1, 2 HAVING sum(n) > 0"""


def _app_changes(spark, sf_dir):
    return D.user_changes(spark, sf_dir).select(
        "op", "ts", "user_id", (F.col("event_id") % 5).alias("app"))


@query("stream_pv_uv", _VISITS_SQL)
def stream_pv_uv(spark, sf_dir):
    """Daily counts per app that follow a change stream; retractions take back."""
    source, out = fresh_dir(spark, "visits"), fresh_dir(spark, "pv-uv")
    changes = _app_changes(spark, sf_dir)
    # spread over time, so that batches meet the same days again
    replay(changes, source, "user_id")
    counts = ContinuousPvUv(spark, out, changes.schema, "ts", ["app"], "user_id", fan=2)
    stream = table_stream(spark, source, changes.schema, 1)
    counts.start(stream, f"{out}-checkpoint").awaitTermination()
    return counts.current()


_TIMELESS = "CASE WHEN event_id % 7 <> 0 AND event_id < (SELECT max(event_id) * 0.6 FROM events) THEN ts END"


@query("stream_pv_uv_no_time", f"""WITH e AS (SELECT {_TIMELESS} AS ts, event_id % 5 AS app, user_id
      FROM events)
    SELECT strftime(ts, '%Y-%m-%d') AS dt, app, count(*) AS pv, count(DISTINCT user_id) AS uv
    FROM e GROUP BY 1, 2""")
def stream_pv_uv_no_time(spark, sf_dir):
    """Rows without a time are counted too, also where a whole file has none."""
    source, out = fresh_dir(spark, "timeless"), fresh_dir(spark, "timeless-pv-uv")
    events = load(spark, sf_dir, "events")
    last = events.agg(F.max("event_id")).first()[0]
    timed = (F.col("event_id") % 7 != 0) & (F.col("event_id") < last * 0.6)
    rows = events.select("event_id", F.when(timed, F.col("ts")).alias("ts"),
                         (F.col("event_id") % 5).alias("app"), "user_id")
    replay(rows, source, "event_id")
    counts = ContinuousPvUv(spark, out, rows.schema, "ts", ["app"], "user_id", op=None,
                            fan=2)
    counts.start(table_stream(spark, source, rows.schema, 1), f"{out}-checkpoint") \
        .awaitTermination()
    return counts.current()


@query("stream_count_changes", """SELECT count(*) AS last_count, true AS telescopes FROM events""")
def stream_count_changes(spark, sf_dir):
    """A count as changes: each batch takes the old value back before the new one."""
    source, out = fresh_dir(spark, "counted"), fresh_dir(spark, "count-changes")
    events = load(spark, sf_dir, "events").select("event_id")
    replay(events, source, "event_id")
    counter = CountChanges(spark, out)
    stream = table_stream(spark, source, events.schema, 1)
    counter.start(stream, f"{out}-checkpoint").awaitTermination()
    signed = counter.changes().withColumn("d", F.when(F.col("is_add"), F.col("n")).otherwise(-F.col("n")))
    return signed.agg(F.max(F.when(F.col("is_add"), F.col("n"))).alias("last_count"),
                      (F.sum("d") == F.max("n")).alias("telescopes"))


@query("stream_watched", """SELECT count(*) AS n, count(CASE WHEN event_type = 'error' THEN 1 END)
    AS errors FROM events""")
def stream_watched(spark, sf_dir):
    """Rows counted on their way through a stream, from its progress."""
    source, out = fresh_dir(spark, "watched"), fresh_dir(spark, "watched-rows")
    events = load(spark, sf_dir, "events").select("event_id", "event_type")
    replay(events, source, "event_id")
    seen = watched(table_stream(spark, source, events.schema, 1), "seen", {
        "errors": F.count(F.when(F.col("event_type") == "error", 1))})
    following = run_to_files(seen, out, f"{out}-checkpoint")
    following.awaitTermination()
    batches = [p.observedMetrics["seen"] for p in following.recentProgress
               if "seen" in p.observedMetrics]
    return spark.createDataFrame([(sum(b["n"] for b in batches), sum(b["errors"] for b in batches))],
                                 "n bigint, errors bigint")


# ---- sinks ------------------------------------------------------------------


@query("stream_time_partitions", """WITH p AS (SELECT strftime(ts, '%Y-%m-%d') AS dt,
      strftime(ts, '%H') AS hr, count(*) AS n, date_trunc('hour', min(ts)) AS start
      FROM events GROUP BY 1, 2)
    SELECT dt, hr, n, epoch_us(start) // 1000 + 10000 <
      (SELECT max(epoch_us(ts) // 1000) FROM events) AS committed FROM p""")
def stream_time_partitions(spark, sf_dir):
    """Day/hour files of a stream of JSON array messages, and which are committed."""
    source, out = fresh_dir(spark, "timed-source"), fresh_dir(spark, "timed-stream")
    packed = D.packed_events(spark, sf_dir)
    replay(packed, source, "message_id")
    rows = explode_json(table_stream(spark, source, packed.schema, 1), "body", D.EVENT_ITEM)
    sink = TimePartitionSink(spark, out, "ts_ms")
    run_stream(rows, sink, f"{out}-checkpoint").awaitTermination()
    parts = spark.read.schema("event_id bigint, dt string, hr string") \
        .parquet(f"{out}/data").groupBy("dt", "hr").agg(F.count("*").alias("n"))
    marks = sink.committed().withColumn("committed", F.lit(True))
    return parts.join(marks, ["dt", "hr"], "left").select(
        "dt", "hr", "n", F.coalesce("committed", F.lit(False)).alias("committed"))


@query("stream_slowest_source", """WITH e AS (SELECT event_id, ts, epoch_us(ts) // 1000 AS ms,
      event_id % 3 AS source, event_id % 3 = 0 AND ts >= (SELECT min(ts) + (max(ts) - min(ts)) / 2
        FROM events) AS lags FROM events),
    progress AS (SELECT (SELECT min(m) FROM (SELECT max(ms) AS m FROM e WHERE NOT lags GROUP BY source)) AS one,
      (SELECT min(m) FROM (SELECT max(ms) AS m FROM e GROUP BY source)) AS two)
    SELECT strftime(ts, '%Y-%m-%d') AS dt, strftime(ts, '%H') AS hr, count(*) AS n,
      (epoch_us(date_trunc('hour', min(ts))) // 1000 + 10000 < (SELECT one FROM progress)
         AND count(*) FILTER (NOT lags) > 0)::INT
      + (epoch_us(date_trunc('hour', min(ts))) // 1000 + 10000 < (SELECT two FROM progress)
         AND (epoch_us(date_trunc('hour', min(ts))) // 1000 + 10000 >= (SELECT one FROM progress)
              OR count(*) FILTER (lags) > 0))::INT AS commits
    FROM e GROUP BY 1, 2""")
def stream_slowest_source(spark, sf_dir):
    """Three partitions of a topic, one far behind: its hours are committed when it is through."""
    source, out = fresh_dir(spark, "slow-source"), fresh_dir(spark, "slow-hours")
    events = load(spark, sf_dir, "events")
    span = events.agg((F.min("ts") + (F.max("ts") - F.min("ts")) / 2).alias("middle"))
    rows = events.join(F.broadcast(span)).select(
        "event_id", epoch_ms(F.col("ts")).alias("ts_ms"), (F.col("event_id") % 3).alias("source"),
        ((F.col("event_id") % 3 == 0) & (F.col("ts") >= F.col("middle"))).alias("lags"))
    sink = TimePartitionSink(spark, out, "ts_ms", source_col="source", sources=["0", "1", "2"])
    for lags in (False, True):  # the second run has what the slow partition held back
        rows.where(F.col("lags") == lags).drop("lags").coalesce(1).write.mode("append").parquet(source)
        stream = table_stream(spark, source, rows.drop("lags").schema)
        run_stream(stream, sink, f"{out}-checkpoint").awaitTermination()
    parts = sink.rows().groupBy("dt", F.lpad("hr", 2, "0").alias("hr")).agg(F.count("*").alias("n"))
    marks = spark.read.schema("dt string, hr string").parquet(f"{out}/commits") \
        .groupBy("dt", "hr").agg(F.count("*").alias("commits"))
    return parts.join(marks, ["dt", "hr"], "left").select(
        "dt", "hr", "n", F.coalesce("commits", F.lit(0)).cast("int").alias("commits"))


_ONCE_CUT = """(SELECT max(epoch_us(ts) // 1000) FROM events WHERE event_id % 3 <> 0) - 864000000"""


@query("stream_acknowledged", f"""SELECT event_id, 'good' AS output, true AS acknowledged FROM events
      WHERE event_id % 3 <> 0 OR epoch_us(ts) // 1000 >= {_ONCE_CUT}
    UNION ALL SELECT event_id, 'late', true FROM events WHERE epoch_us(ts) // 1000 < {_ONCE_CUT}""")
def stream_acknowledged(spark, sf_dir):
    """A queue of three shards: two thirds of the events, then all of them again.

    Repeated messages are dropped within ten days of the newest one, older ones come out
    as late, and what a finished batch has read is gone from the queue.
    """
    out = fresh_dir(spark, "acknowledged")
    queue = SpoolQueue(f"{out}/queue")
    rows = D.event_rows(spark, sf_dir)
    body = rows.select("event_id", F.to_json(F.struct("*")).alias("value"))

    def deliver(messages):
        def put(batches):
            for batch in batches:
                shards, values = batch.column("shard").to_pylist(), batch.column("value").to_pylist()
                for shard in set(shards):  # a shard's messages are all in one task
                    queue.put(shard, [v for s, v in zip(shards, values) if s == shard])
                yield batch.slice(0, 0)

        ship_package(spark)
        dealt = messages.select((F.col("event_id") % 3).cast("string").alias("shard"), "value")
        dealt.repartition(3, "shard").mapInArrow(put, dealt.schema) \
            .write.format("noop").mode("overwrite").save()

    once = OnceSink(spark, f"{out}/state", "event_id", file_sink(f"{out}/good"),
                    file_sink(f"{out}/late"), "ts", 864_000_000)
    waiting = []
    for part in (body.where("event_id % 3 <> 0"), body):
        deliver(part)
        messages = queue_messages(spark, queue, f"queue_{uuid.uuid4().hex}", 5000)
        timed = parse_json(messages, "value", D.EVENT_ITEM).withColumn(
            "ts", F.timestamp_millis("ts_ms"))
        run_stream(timed, once, f"{out}/checkpoint").awaitTermination()
        waiting.append(sum(queue.waiting(shard) for shard in queue.shards()))
    seen = once.counts()
    # All but the last batch are acknowledged; no message is lost between the outputs.
    right = waiting[1] <= rows.count() and seen["messages"] == \
        seen["good"] + seen["late"] + seen["repeated"]
    both = [read_files(spark, f"{out}/{name}").select("event_id", F.lit(name).alias("output"))
            for name in ("good", "late")]
    return both[0].unionByName(both[1]).withColumn("acknowledged", F.lit(right))


@query("stream_fanout", """SELECT 'rows' AS sink, event_type, count(*) AS n FROM events GROUP BY 2
    UNION ALL SELECT 'alerts', event_type, count(*) FROM events WHERE event_type = 'error' GROUP BY 2""")
def stream_fanout(spark, sf_dir):
    """One stream, two outputs: all rows, and a side output of errors."""
    source, out = _messages(spark, sf_dir, "fan-messages"), fresh_dir(spark, "fan-out")
    stream = text_stream(spark, source, options={"maxFilesPerTrigger": "2"})
    rows = parse_json(stream, "value", D.EVENT_ITEM)
    every, alerts = file_sink(f"{out}/rows"), file_sink(f"{out}/alerts")
    sinks = {"rows": every,
             "alerts": lambda batch, n: alerts(batch.where("event_type = 'error'"), n)}
    run_stream(rows, lambda batch, n: write_all(batch, sinks, n), f"{out}-checkpoint") \
        .awaitTermination()

    def counted(name):
        return read_files(spark, f"{out}/{name}").groupBy("event_type").agg(
            F.count("*").alias("n")).select(F.lit(name).alias("sink"), "event_type", "n")

    return counted("rows").unionByName(counted("alerts"))


@query("stream_traces_to_index", f"""WITH {D.TRACES_SQL},
    last AS (SELECT *, projectId || '-' || strftime(ts, '%Y-%m') AS index_name FROM trace
             WHERE projectId IS NOT NULL)
    SELECT index_name, uuid AS id, event_type AS event_name, url AS visit_url FROM last""")
def stream_traces_to_index(spark, sf_dir):
    """Trace messages, each delivered twice, flattened and upserted into month indexes."""
    source, out = fresh_dir(spark, "traces"), fresh_dir(spark, "trace-log")
    traces = D.traces(spark, sf_dir)
    bodies = traces.select(F.to_json(F.struct(*traces.columns)).alias("value"))
    replay(bodies.unionAll(bodies), source, "value", fmt="text")
    messages = text_stream(spark, source, options={"maxFilesPerTrigger": "2"})
    flat = flatten_trace(parse_json(messages, "value", traces.schema))
    index = Index(spark, out, flat.schema, "id", ["visitTime"],
                  index_name(F.col("projectId"), F.col("visitTime")))
    run_stream(flat, index.write, f"{out}-checkpoint").awaitTermination()
    return index.read().select(
        "index_name", "id", F.col("eventName").alias("event_name"),
        F.col("visitUrl").alias("visit_url"))


@query("stream_attributes_fanout", """SELECT s.sink, event_id, 'E1' AS code,
    strftime(ts, '%Y-%m-%d %H:%M:%S') AS occurred, CAST(user_id AS VARCHAR) AS account,
    event_type AS attribute_value FROM events, (VALUES ('main'), ('side')) AS s(sink)""")
def stream_attributes_fanout(spark, sf_dir):
    """Event messages to configured attributes, to the main and the side output."""
    source, out = _messages(spark, sf_dir, "attribute-messages"), fresh_dir(spark, "attributes")
    messages = text_stream(spark, source, options={"maxFilesPerTrigger": "2"})
    events = parse_json(messages, "value", D.EVENT_ITEM).select(
        F.col("ts_ms").cast("string").alias("occurrenceTime"), "event_type",
        F.col("event_id").cast("string").alias("channelCode"),
        F.col("user_id").cast("string").alias("accountId"))
    event = {"code": "E1", "name": "visit", "attributesJSON": [{"attributeId": "event_type"}]}
    picked = extract_attributes(events, event)
    sinks = {name: file_sink(f"{out}/{name}", fmt="json") for name in ("main", "side")}
    run_stream(picked, lambda batch, n: write_all(batch, sinks, n), f"{out}-checkpoint") \
        .awaitTermination()
    frames = [spark.read.schema(picked.schema).json(f"{out}/{n}/*").withColumn("sink", F.lit(n))
              for n in sinks]
    return frames[0].unionByName(frames[1]).select(
        "sink", F.col("channelCode").cast("bigint").alias("event_id"),
        F.col("eventId").alias("code"), F.col("occurrenceTime").alias("occurred"),
        F.col("accountId").alias("account"),
        F.col("attributesJSON")[0]["value"].alias("attribute_value"))


@query("stream_pipeline", """SELECT o_orderkey, o_custkey, o_orderstatus FROM orders
    WHERE o_orderstatus <> 'P'""")
def stream_pipeline(spark, sf_dir):
    """A statement list: declare tables, copy the table, drop, follow it, select."""
    tag = uuid.uuid4().hex
    src, dst = f"src_{tag}", f"dst_{tag}"
    places = {name: fresh_dir(spark, name) for name in (src, dst)}
    columns = "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING"

    def follow(session):
        rows = table_stream(session, places[src], columns).where("o_orderstatus <> 'P'")
        run_stream(rows, file_sink(places[dst]), f"{places[dst]}-checkpoint").awaitTermination()

    return run_pipeline(spark, [
        "SET spark.sql.sources.default=parquet",
        f"CREATE TABLE {src} ({columns}) USING parquet LOCATION '{places[src]}'",
        f"CREATE TABLE IF NOT EXISTS {dst} ({columns}, batch BIGINT) USING parquet "
        f"PARTITIONED BY (batch) LOCATION '{places[dst]}'",
        f"INSERT INTO {src} SELECT o_orderkey, o_custkey, o_orderstatus "
        f"FROM parquet.`{sf_dir}/orders.parquet`",
        follow,
        f"DROP TABLE {src}",
        f"MSCK REPAIR TABLE {dst}",
        f"SELECT o_orderkey, o_custkey, o_orderstatus FROM {dst}",
    ])


@query("pipeline_batch_copy", "SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM customer")
def pipeline_batch_copy(spark, sf_dir):
    """A statement list that copies a source table into a new parquet table."""
    dst = f"copied_{uuid.uuid4().hex}"
    return run_pipeline(spark, [
        f"""CREATE TABLE IF NOT EXISTS {dst} (c_custkey BIGINT, c_name STRING, c_nationkey INT,
            c_acctbal DOUBLE) USING parquet LOCATION '{fresh_dir(spark, dst)}'""",
        f"""INSERT INTO {dst} SELECT c_custkey, c_name, c_nationkey, c_acctbal
            FROM parquet.`{sf_dir}/customer.parquet`""",
        f"SELECT * FROM {dst}",
    ])


@query("pipeline_expand_envelopes", f"""WITH {D.ENVELOPES_SQL}
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM env WHERE kind IN (0, 1)""")
def pipeline_expand_envelopes(spark, sf_dir):
    """A topic of envelopes into a table: the statement selects ``after.*``."""
    dst = f"expanded_{uuid.uuid4().hex}"
    source, place = _envelope_files(spark, sf_dir), fresh_dir(spark, dst)

    def follow(session):
        rows = change_stream(session, _IMAGE, source, files_per_batch=2)
        after = rows.where("after is not null").select("after.*")
        run_stream(after, file_sink(place), f"{place}-checkpoint").awaitTermination()

    return run_pipeline(spark, [
        follow,
        f"CREATE TABLE {dst} ({_IMAGE}, batch BIGINT) USING parquet "
        f"PARTITIONED BY (batch) LOCATION '{place}'",
        f"MSCK REPAIR TABLE {dst}",
        f"SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM {dst}",
    ])


@query("pipeline_append_changes", f"""WITH {D.USER_CHANGES_SQL}
    SELECT event_id, user_id, event_type, value FROM changes""")
def pipeline_append_changes(spark, sf_dir):
    """Every record of a changelog appended as a plain row to a declared table."""
    dst = f"appended_{uuid.uuid4().hex}"
    view = f"{dst}_view"
    return run_pipeline(spark, [
        lambda s: L.flatten_changelog(D.user_changes(s, sf_dir)).createOrReplaceTempView(view),
        f"""CREATE TABLE {dst} (event_id BIGINT, user_id BIGINT, event_type STRING, value DOUBLE)
            USING parquet LOCATION '{fresh_dir(spark, dst)}'""",
        f"INSERT INTO {dst} SELECT event_id, user_id, event_type, value FROM {view}",
        f"DROP VIEW {view}",
        f"SELECT * FROM {dst}",
    ])
