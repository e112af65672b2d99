"""Write jobs: each writes to a fresh folder and returns what reads back."""

from __future__ import annotations

import uuid

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow.fs import FileSystem
from pyspark.sql import functions as F

from changeflow.functions.time import DAY, with_processing_day
from changeflow.operators.conform import conform, misfits, truncate_to_ms
from changeflow.operators.shaping import normalize_envelope
from changeflow.plans import derived as D
from changeflow.plans.registry import load, query
from changeflow.plans.shapes import NOW_MS
from changeflow.session import fresh_dir, written
from changeflow.sinks import files as W
from changeflow.sinks.batched import PackingStore, refused_rows, write_batched, write_isolated
from changeflow.sinks.copytext import read_copy_text, write_copy_text
from changeflow.sinks.index import Index
from changeflow.sinks.quarantine import bad_rows, good_rows, write_with_quarantine
from changeflow.sinks.store import FolderStore, store_format
from changeflow.sources.scan import scan_shards
from changeflow.streaming.sinks import file_sink, read_files, write_all

# ---- partitions and shards --------------------------------------------------


@query("write_partitioned", """SELECT o_orderkey, o_totalprice, o_orderstatus, o_orderpriority
    FROM orders""")
def write_partitioned(spark, sf_dir):
    """Dynamic partitions; the name given with a literal still takes the row's value."""
    path = fresh_dir(spark, "partitioned")
    rows = load(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    W.write_partitioned(rows, path, "o_orderstatus,${o_orderpriority=none}")
    return spark.read.parquet(path)


@query("write_static_partition", """SELECT c_custkey, c_acctbal, c_mktsegment, 'r1' AS release
    FROM customer""")
def write_static_partition(spark, sf_dir):
    path = fresh_dir(spark, "static")
    rows = load(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    W.write_partitioned(rows, path, ["c_mktsegment"], static={"release": "r1"})
    return spark.read.parquet(path)


@query("write_overwrite", """SELECT o_orderkey,
    CASE WHEN o_orderstatus = 'F' THEN -o_totalprice ELSE o_totalprice END AS o_totalprice,
    o_orderstatus FROM orders""")
def write_overwrite(spark, sf_dir):
    """Overwriting replaces the touched partition and leaves the others."""
    path = fresh_dir(spark, "overwrite")
    rows = load(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    W.write_partitioned(rows, path, ["o_orderstatus"])
    closed = rows.where("o_orderstatus = 'F'").withColumn("o_totalprice", -F.col("o_totalprice"))
    W.write_partitioned(closed, path, ["o_orderstatus"], mode="overwrite")
    return spark.read.parquet(path)


@query("write_grouped", """SELECT c_mktsegment, c_nationkey, count(*) AS n,
    CAST(sum(c_custkey) AS BIGINT) AS key_sum FROM customer GROUP BY 1, 2""")
def write_grouped(spark, sf_dir):
    """Two appends by partition group; every row lands in its own partition once."""
    path = fresh_dir(spark, "grouped")
    rows = load(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    for part in (rows.where("c_acctbal < 1000"), rows.where("c_acctbal >= 1000")):
        W.write_partitioned(part, path, ["c_mktsegment", "c_nationkey"])
    return spark.read.parquet(path).groupBy("c_mktsegment", "c_nationkey").agg(
        F.count("*").alias("n"), F.sum("c_custkey").alias("key_sum"))


@query("write_time_partitions", """SELECT strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%H') AS hour,
    count(*) AS n, min(event_id) AS first_id FROM events GROUP BY 1, 2""")
def write_time_partitions(spark, sf_dir):
    path = fresh_dir(spark, "timed")
    W.write_time_partitioned(D.event_rows(spark, sf_dir), path, "ts_ms", day="day", hour="hour")
    schema = "event_id bigint, day string, hour string"
    return spark.read.schema(schema).parquet(path).groupBy("day", "hour").agg(
        F.count("*").alias("n"), F.min("event_id").alias("first_id"))


@query("write_processing_day", """SELECT event_id, event_type, '2024-01-31' AS load_day,
    '2024-01-31' AS local_day FROM events""")
def write_processing_day(spark, sf_dir):
    """Rows partitioned by the day they were taken in, for a fixed clock."""
    path = fresh_dir(spark, "processing-day")
    rows = load(spark, sf_dir, "events").select("event_id", "event_type")
    days = with_processing_day(rows, NOW_MS, day="load_day")
    both = with_processing_day(days, NOW_MS, "Asia/Shanghai", "local_day")
    W.write_partitioned(both, path, ["load_day", "local_day"])
    return spark.read.schema(both.schema).parquet(path)


@query("write_sharded", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem")
def write_sharded(spark, sf_dir):
    rows = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    paths = W.write_sharded(rows, fresh_dir(spark, "sharded"), "hash", 5, "l_orderkey")
    return scan_shards(spark, paths)


@query("write_sharded_changes", f"""WITH {D.USER_CHANGES_SQL}
    SELECT event_id, op, CAST(user_id % 4 AS INTEGER) AS shard FROM changes WHERE op <> '-U'""")
def write_sharded_changes(spark, sf_dir):
    """A changelog over four shards by value; rows before an update are left out."""
    path = fresh_dir(spark, "sharded-changes")
    rows = D.user_changes(spark, sf_dir).select("event_id", "op", "user_id")
    W.write_sharded(rows, path, "value", 4, "user_id", op="op")
    return spark.read.parquet(path).select("event_id", "op", "shard")


@query("write_bucketed", """SELECT o_custkey, count(*) AS orders, count(c_custkey) AS known
    FROM orders LEFT JOIN customer ON c_custkey = o_custkey GROUP BY 1""")
def write_bucketed(spark, sf_dir):
    """Two tables bucketed on the join key join without another shuffle of either."""
    names = []
    for table, key in (("orders", "o_custkey"), ("customer", "c_custkey")):
        names.append(f"bucketed_{table}_{uuid.uuid4().hex}")
        W.save_bucketed(load(spark, sf_dir, table).select(key), names[-1], [key], 8,
                        fresh_dir(spark, table))
    orders, customer = (spark.table(n) for n in names)
    return orders.join(customer, F.col("c_custkey") == F.col("o_custkey"), "left") \
        .groupBy("o_custkey").agg(F.count("*").alias("orders"),
                                  F.count("c_custkey").alias("known"))


@query("create_if_missing", """SELECT n_nationkey, n_name, n_regionkey FROM nation
    UNION ALL SELECT n_nationkey, n_name, n_regionkey FROM nation WHERE n_regionkey = 1""")
def create_if_missing(spark, sf_dir):
    """The first write creates the table, the second appends."""
    name, path = f"created_{uuid.uuid4().hex}", fresh_dir(spark, "created")
    nation = load(spark, sf_dir, "nation")
    W.save_table(nation, name, ["n_regionkey"], path)
    W.save_table(nation.where("n_regionkey = 1"), name, ["n_regionkey"], path)
    return spark.table(name)


@query("insert_overwrite_table", """SELECT n_nationkey,
    CASE WHEN n_regionkey = 2 THEN upper(n_name) || '!' ELSE n_name END AS n_name, n_regionkey
    FROM nation""")
def insert_overwrite_table(spark, sf_dir):
    name, path = f"inserted_{uuid.uuid4().hex}", fresh_dir(spark, "inserted")
    nation = load(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    W.save_table(nation.limit(0), name, ["n_regionkey"], path)
    W.insert(nation, name)
    marked = nation.where("n_regionkey = 2").withColumn(
        "n_name", F.concat(F.upper("n_name"), F.lit("!")))
    W.insert(marked, name, overwrite=True)
    return spark.table(name)


# ---- text, routes, indexes --------------------------------------------------


@query("write_copy_text", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def write_copy_text_query(spark, sf_dir):
    """Whole documents, with quotes and line ends, out as bulk text and back."""
    path = fresh_dir(spark, "copy")
    documents = load(spark, sf_dir, "documents").select(
        "doc_id", "text", "lang", "source", "n_chars")
    write_copy_text(documents, path)
    return read_copy_text(spark, path, documents.schema)


@query("copy_text_lines", """SELECT event_id || '|"' || event_type || '"|"' ||
      replace(replace(props, '\\', '\\\\'), '"', '\\"') || '"|' ||
      CASE WHEN event_id % 5 = 0 THEN '' ELSE CAST(user_id AS VARCHAR) END AS line FROM events""")
def copy_text_lines(spark, sf_dir):
    """The text itself: strings quoted and escaped, null empty, numbers bare."""
    path = fresh_dir(spark, "lines")
    rows = load(spark, sf_dir, "events").select(
        "event_id", "event_type", "props",
        F.when(F.col("event_id") % 5 != 0, F.col("user_id")).alias("user_id"))
    write_copy_text(rows, path)
    return spark.read.text(path).select(F.col("value").alias("line"))


@query("copy_text_batches", """SELECT count(*) AS rows, true AS within FROM orders""")
def copy_text_batches(spark, sf_dir):
    """No bulk-load file is larger than its batch."""
    path = fresh_dir(spark, "copy-batches")
    write_copy_text(load(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), path, 500)
    files = spark.read.text(path).groupBy(F.input_file_name().alias("file")).agg(
        F.count("*").alias("n"))
    return files.agg(F.sum("n").alias("rows"), F.bool_and(F.col("n") <= 500).alias("within"))


@query("write_routed", f"""WITH {D.ENVELOPES_SQL}
    SELECT 'cdc.' || db || '.orders' AS topic, count(*) AS n,
      count(CASE WHEN kind = 2 THEN 1 END) AS deletes FROM env WHERE kind < 3 GROUP BY 1""")
def write_routed(spark, sf_dir):
    """One topic per database and table; the body is the change's details."""
    path = fresh_dir(spark, "routed")
    W.write_routed(normalize_envelope(D.order_envelopes(spark, sf_dir), NOW_MS), path, "cdc")
    lines = spark.read.schema("value string, topic string").option("basePath", path) \
        .format("text").load(path)
    return lines.groupBy("topic").agg(
        F.count("*").alias("n"),
        F.count(F.when(F.get_json_object("value", "$.op") == "d", 1)).alias("deletes"))


@query("write_fanout", """SELECT sink, event_id, event_type FROM events,
    (VALUES ('copy'), ('main'), ('side')) AS s(sink)""")
def write_fanout(spark, sf_dir):
    """Every row to each of three outputs."""
    path = fresh_dir(spark, "fanout")
    rows = load(spark, sf_dir, "events").select("event_id", "event_type")
    names = ("copy", "main", "side")
    write_all(rows, {n: file_sink(f"{path}/{n}") for n in names})
    first, *others = (read_files(spark, f"{path}/{n}").withColumn("sink", F.lit(n)) for n in names)
    for other in others:
        first = first.unionByName(other)
    return first.select("sink", "event_id", "event_type")


@query("write_index", """WITH doc AS (
      SELECT user_id * 31 + event_id % 31 AS id, 'p' || (user_id % 3) AS project, ts, event_id, value
      FROM events),
    last AS (SELECT * FROM doc QUALIFY row_number() OVER (PARTITION BY id ORDER BY ts DESC, event_id DESC) = 1)
    SELECT project || '-' || strftime(ts, '%Y-%m') AS index_name, id, event_id, value FROM last""")
def write_index(spark, sf_dir):
    """Documents upserted by id into an index per project and month."""
    docs = _documents(load(spark, sf_dir, "events"))
    index = _index(spark, docs)
    index.write(docs, 0)
    return index.read().select("index_name", "id", "event_id", "value")


def _documents(events):
    return events.select(
        (F.col("user_id") * 31 + F.col("event_id") % 31).alias("id"),
        F.concat(F.lit("p"), (F.col("user_id") % 3).cast("string")).alias("project"),
        "ts", "event_id", "value")


def _index(spark, docs):
    name = W.index_name(F.col("project"), F.date_format("ts", DAY))
    return Index(spark, fresh_dir(spark, "index"), docs.schema, "id", ["ts", "event_id"], name)


@query("write_index_again", """WITH doc AS (
      SELECT user_id * 31 + event_id % 31 AS id, 'p' || (user_id % 3) AS project, ts, event_id, value
      FROM events),
    last AS (SELECT * FROM doc QUALIFY row_number() OVER (PARTITION BY id ORDER BY ts DESC, event_id DESC) = 1),
    now AS (SELECT id, CASE WHEN id % 4 = 0 THEN 'moved' ELSE project END AS project, ts, event_id,
              CASE WHEN id % 2 = 0 THEN value + 1 ELSE value END AS value FROM last
            UNION ALL SELECT -1 - event_id, 'new', ts, event_id, value FROM events WHERE event_id < 10)
    SELECT project || '-' || strftime(ts, '%Y-%m') AS index_name, id, event_id, value FROM now""")
def write_index_again(spark, sf_dir):
    """A second write changes documents, moves some to another index and adds some."""
    events = load(spark, sf_dir, "events")
    docs = _documents(events)
    index = _index(spark, docs)
    index.write(docs, 0)
    project = F.when(F.col("id") % 4 == 0, "moved").otherwise(F.col("project"))
    changed = index.read().where("id % 2 = 0").withColumns(
        {"value": F.col("value") + 1, "project": project}).drop("index_name")
    added = events.where("event_id < 10").select(
        (-1 - F.col("event_id")).alias("id"), F.lit("new").alias("project"), "ts", "event_id",
        "value")
    index.write(written(changed.unionByName(added), "second-write"), 1)
    return index.read().select("index_name", "id", "event_id", "value")


# ---- bad rows and batches ---------------------------------------------------


@query("write_quarantine", """SELECT event_id,
    CASE WHEN event_id % 97 = 0 THEN 'type:value' WHEN user_id <= 0 THEN 'rule:user' END AS reason,
    CASE WHEN event_id % 97 <> 0 AND user_id > 0 THEN value END AS value FROM events""")
def write_quarantine(spark, sf_dir):
    """Rows whose value is no number, or whose user is not positive, are set apart."""
    path = fresh_dir(spark, "quarantine")
    types = {"value": "DOUBLE"}
    write_with_quarantine(D.raw_values(spark, sf_dir), path, types, {"user": F.col("user_id") > 0})
    good = good_rows(spark, path, types).select(
        "event_id", F.lit(None).cast("string").alias("reason"), "value")
    bad = bad_rows(spark, path).select(
        "event_id", F.substring_index("_reason", ",", 1).alias("reason"),
        F.lit(None).cast("double").alias("value"))
    return good.unionByName(bad)


@query("write_quarantine_lossy", """WITH e AS (SELECT event_id, CASE event_id % 4
      WHEN 0 THEN CAST(event_id AS VARCHAR) WHEN 1 THEN event_id || '.9' WHEN 2 THEN event_id || '.0'
      ELSE 'x' END AS amount FROM events)
    SELECT event_id, event_id % 4 IN (1, 3) AS bad,
      CASE WHEN event_id % 4 IN (0, 2) THEN event_id END AS amount,
      (SELECT count(*) FROM e WHERE event_id % 4 IN (1, 3)) AS counted_bad FROM e""")
def write_quarantine_lossy(spark, sf_dir):
    """A value whose fraction a cast would cut is bad; good and bad rows are counted."""
    path, types = fresh_dir(spark, "lossy"), {"amount": "Decimal(18, 0)"}
    at, text = F.col("event_id") % 4, F.col("event_id").cast("string")
    rows = load(spark, sf_dir, "events").select("event_id", F.when(at == 0, text).when(
        at == 1, F.concat(text, F.lit(".9"))).when(at == 2, F.concat(text, F.lit(".0")))
        .otherwise("x").alias("amount"))
    numbers = write_with_quarantine(rows, path, types)
    good = good_rows(spark, path, types).select(
        "event_id", F.lit(False).alias("bad"), F.col("amount").cast("bigint").alias("amount"))
    bad = bad_rows(spark, path).select(
        "event_id", F.lit(True).alias("bad"), F.lit(None).cast("bigint").alias("amount"))
    return good.unionByName(bad).withColumn("counted_bad", F.lit(numbers["bad"]).cast("bigint"))


def _store(path):
    """A writer that keeps each batch as a file of its own; safe to repeat."""
    def send(batch, task, number):
        system, folder = FileSystem.from_uri(path)
        system.create_dir(folder, recursive=True)
        pq.write_table(pa.Table.from_pandas(batch, preserve_index=False),
                       f"{folder}/{task}-{number}.parquet", filesystem=system)
    return send


@query("write_batched", """SELECT l_orderkey, l_linenumber, true AS batches_full FROM lineitem""")
def write_batched_query(spark, sf_dir):
    """Rows handed to a store in batches of 1000: all once, only the last one short."""
    path = fresh_dir(spark, "batched")
    rows = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    report = write_batched(rows, _store(path), 1000)
    full = report.agg(F.bool_and(F.col("batches") == F.ceil(F.col("rows") / 1000))).first()[0]
    return spark.read.parquet(path).withColumn("batches_full", F.lit(full))


@query("write_batched_with_retry", """SELECT l_orderkey, l_linenumber, true AS tried_twice
    FROM lineitem""")
def write_batched_with_retry(spark, sf_dir):
    """The first try of every batch fails; each is sent again and its rows count once."""
    path, failed = fresh_dir(spark, "batched-again"), set()
    store = _store(path)

    def send(batch, task, number):
        store(batch, task, number)
        if (task, number) not in failed:
            failed.add((task, number))
            raise OSError("store is down")

    rows = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    report = write_batched(rows, send, 1000, base=0.0, seconds=60)
    twice = report.agg(F.bool_and(F.col("attempts") == F.col("batches") * 2)).first()[0]
    return spark.read.parquet(path).withColumn("tried_twice", F.lit(twice))


@query("write_isolated", """SELECT l_orderkey, l_linenumber,
      (l_orderkey * 7 + l_linenumber) % 499 = 0 AS refused, true AS counted FROM lineitem""")
def write_isolated_query(spark, sf_dir):
    """A store that refuses batches with certain rows: these are set apart, the others stored."""
    path = fresh_dir(spark, "isolated")
    store = PackingStore(f"{path}/good")

    def send(batch, task, name):
        marks = pc.add(pc.multiply(batch["l_orderkey"], 7), batch["l_linenumber"])
        rest = pc.subtract(marks, pc.multiply(pc.divide(marks, 499), 499))
        at_fault = pc.sum(pc.equal(rest, 0)).as_py()
        if at_fault:
            raise ValueError(f"{at_fault} rows refused")
        store.send(batch, task, name)

    rows = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    numbers = write_isolated(rows, send, f"{path}/bad", finish=store.finish)
    good, bad = spark.read.parquet(f"{path}/good"), refused_rows(spark, f"{path}/bad")
    right = numbers["stored"] == good.count() and numbers["refused"] == bad.count() \
        and numbers["sends"] < numbers["stored"]
    return good.withColumn("refused", F.lit(False)).unionByName(
        bad.drop("_reason").withColumn("refused", F.lit(True))).withColumn("counted", F.lit(right))


@query("write_store", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem")
def write_store(spark, sf_dir):
    """Rows into a store that takes batches, by a data source that publishes whole jobs."""
    store = FolderStore(fresh_dir(spark, "store"))
    name = store_format(spark, store, f"store_{uuid.uuid4().hex}", 1000, 1.0)
    rows = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    rows.write.format(name).mode("append").save()
    return store.rows(spark, rows.schema)


@query("conform_types", """SELECT CAST(o_orderkey % 120 AS TINYINT) AS small,
    CAST(TRY_CAST(o_orderkey AS TINYINT) AS VARCHAR) AS narrowed, CAST(o_custkey AS INTEGER) AS customer,
    CAST(o_totalprice AS FLOAT) AS price, o_orderkey % 3 = 1 AS flag,
    CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day, CAST(o_orderkey AS VARCHAR) AS text,
    CAST(o_orderkey AS VARCHAR) || ',' || CAST(o_custkey AS VARCHAR) AS pair,
    TRY_CAST(o_orderkey AS TINYINT) IS NULL AS misfit FROM orders""")
def conform_types(spark, sf_dir):
    """Declared foreign types; a value that does not fit becomes null."""
    key = F.col("o_orderkey")
    rows = load(spark, sf_dir, "orders").select(
        (key % 120).alias("small"), key.alias("narrowed"), F.col("o_custkey").alias("customer"),
        F.col("o_totalprice").alias("price"), (key % 3).alias("flag"),
        F.col("o_orderdate").alias("day"), key.alias("text"),
        F.array(key, F.col("o_custkey")).alias("pair"))
    types = {"small": "Int8", "narrowed": "Nullable(Int8)", "customer": "UInt16",
             "price": "Float32", "flag": "BOOL", "day": "Date", "text": "String",
             "pair": "Array(String)"}
    marked = rows.withColumn("misfit", misfits(rows, types))
    typed = conform(marked, {**types, "misfit": "BOOL"})
    texts = {c: F.col(c).cast("string") for c in ("day", "narrowed")}
    return typed.withColumns({"pair": F.array_join("pair", ","), **texts})


@query("timestamps_to_ms", """SELECT event_id, (epoch_us(ts) // 1000) * 1000 AS stored_us FROM events""")
def timestamps_to_ms(spark, sf_dir):
    """Stores with millisecond times drop the finer digits."""
    stored = truncate_to_ms(F.col("ts"))
    return load(spark, sf_dir, "events").select(
        "event_id", F.unix_micros(stored.cast("timestamp")).alias("stored_us"))


@query("conform_lossy", """SELECT o_orderkey AS id, CAST(trunc(o_totalprice) AS INTEGER) AS whole,
    o_totalprice <> trunc(o_totalprice) AS whole_lost, o_orderkey % 2 = 1 AS wide_lost,
    o_orderkey <> 0 AS float_lost, o_orderkey % 10 <> 0 AS digits_lost,
    o_totalprice <> trunc(o_totalprice) AS list_lost, o_totalprice <> trunc(o_totalprice) AS map_lost,
    o_orderkey % 2 = 1 AS day_lost, o_orderkey % 3 = 0 AS text_lost FROM orders""")
def conform_lossy(spark, sf_dir):
    """What each cast would lose, also inside arrays and maps; the key is not nullable."""
    key, price = F.col("o_orderkey"), F.col("o_totalprice")
    above = (F.lit(1 << 53) + key)
    rows = load(spark, sf_dir, "orders").select(
        key.alias("id"), price.alias("whole"), above.alias("wide"), above.alias("float"),
        F.concat(F.lit("0."), F.lpad(key.cast("string"), 21, "0")).cast("decimal(38,21)")
        .alias("digits"), F.array(price, F.lit(2.0)).alias("list"),
        F.create_map(F.lit("k"), price).alias("map"),
        (F.date_trunc("day", "o_orderdate") + F.make_dt_interval(hours=key % 2)).alias("day"),
        F.concat(key.cast("string"), F.when(key % 3 == 0, ".0001").otherwise(".0000")).alias("text"))
    types = {"whole": "Int32", "wide": "Float64", "float": "Float32", "digits": "Decimal(38, 20)",
             "list": "Array(Int32)", "map": "Map(String, Int32)", "day": "Date",
             "text": "Decimal(18, 3)"}
    marked = rows.withColumns({f"{c}_lost": misfits(rows, {c: t}) for c, t in types.items()})
    flags = {f"{c}_lost": "BOOL" for c in types}
    typed = conform(marked, {"id": "Int64", "whole": "Int32", **flags}, keys=["id"])
    assert not typed.schema["id"].nullable
    return typed
