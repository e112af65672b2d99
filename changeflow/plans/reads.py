"""Scan, split, chunk and placement jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from changeflow.operators import placement as P
from changeflow.plans.registry import load, query
from changeflow.session import fresh_dir
from changeflow.sinks.files import write_sharded
from changeflow.sources.chunks import plan_by_rank, plan_chunks
from changeflow.sources.scan import literal_rows as literals
from changeflow.sources.scan import scan, scan_ranges, scan_shards
from changeflow.sources.snapshot import label_chunks, read_snapshot, snapshot

# ---- scans ------------------------------------------------------------------


@query("column_scan", "SELECT o_orderstatus, o_orderkey, o_custkey FROM orders")
def column_scan(spark, sf_dir):
    return scan(spark, f"{sf_dir}/orders.parquet", ["o_orderstatus", "o_orderkey", "o_custkey"])


@query("projected_scan", "SELECT c_mktsegment, c_acctbal, c_custkey FROM customer")
def projected_scan(spark, sf_dir):
    """Columns in the order asked for."""
    return scan(spark, f"{sf_dir}/customer.parquet", ["c_mktsegment", "c_acctbal", "c_custkey"])


@query("empty_projection_count", "SELECT count(*) AS total FROM lineitem")
def empty_projection_count(spark, sf_dir):
    """Counting rows reads no column."""
    return scan(spark, f"{sf_dir}/lineitem.parquet", []).agg(F.count("*").alias("total"))


@query("predicate_scan", """SELECT l_orderkey, l_linenumber FROM lineitem
    WHERE l_shipdate >= TIMESTAMP '1998-01-01' AND l_shipdate < TIMESTAMP '1999-01-01'
      AND (l_quantity < 10 OR l_quantity > 45) AND length(l_returnflag) = 1""")
def predicate_scan(spark, sf_dir):
    """The length test stays above the scan, the other terms also reach the reader."""
    ship = F.col("l_shipdate")
    terms = ((ship >= F.lit("1998-01-01").cast("timestamp_ntz"))
             & (ship < F.lit("1999-01-01").cast("timestamp_ntz"))
             & ((F.col("l_quantity") < 10) | (F.col("l_quantity") > 45))
             & (F.length("l_returnflag") == 1))
    return scan(spark, f"{sf_dir}/lineitem.parquet", ["l_orderkey", "l_linenumber"], where=terms)


@query("ordered_limit", """SELECT o_orderkey, o_totalprice FROM orders
    ORDER BY o_totalprice DESC, o_orderkey LIMIT 100""")
def ordered_limit(spark, sf_dir):
    return load(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice") \
        .orderBy(F.desc("o_totalprice"), "o_orderkey").limit(100)


@query("limited_scan", "SELECT least(count(*), 100) AS n FROM orders")
def limited_scan(spark, sf_dir):
    limited = scan(spark, f"{sf_dir}/orders.parquet", ["o_orderkey"], limit=100)
    return limited.agg(F.count("*").alias("n"))


@query("ordered_scan", "SELECT c_custkey, c_name FROM customer ORDER BY c_custkey")
def ordered_scan(spark, sf_dir):
    return scan(spark, f"{sf_dir}/customer.parquet", ["c_custkey", "c_name"]).orderBy("c_custkey")


@query("literal_rows", """SELECT n_nationkey, n_name, tag, CAST(weight AS DOUBLE) AS weight FROM nation
    JOIN (VALUES (0, 'a', 1.5), (1, 'b', NULL), (2, 'c', 2.25)) AS v(k, tag, weight)
      ON v.k = n_regionkey""")
def literal_rows(spark, sf_dir):
    tags = literals(spark, [(0, "a", 1.5), (1, "b", None), (2, "c", 2.25)],
                "n_regionkey int, tag string, weight double")
    return load(spark, sf_dir, "nation").join(F.broadcast(tags), "n_regionkey") \
        .select("n_nationkey", "n_name", "tag", "weight")


# ---- ranges and shards ------------------------------------------------------


@query("range_scan", """WITH b AS (SELECT min(o_orderkey) AS lo, max(o_orderkey) AS hi FROM orders),
    s AS (SELECT lo, hi, hi - lo + 1 AS n, (hi - lo + 1) // 7 AS small, (hi - lo + 1) % 7 AS extra
          FROM b)
    SELECT o_orderkey, CAST(CASE WHEN o_orderkey - lo < extra * (small + 1)
        THEN (o_orderkey - lo) // (small + 1)
        ELSE extra + (o_orderkey - lo - extra * (small + 1)) // small END AS INTEGER) AS range_id
    FROM orders, s""")
def range_scan(spark, sf_dir):
    """The whole key span in seven ranges."""
    orders = load(spark, sf_dir, "orders").select("o_orderkey")
    lower, upper = orders.agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    return scan_ranges(orders, "o_orderkey", lower, upper, 7, "range_id")


SPREAD_KEY = "(o_orderkey % 3000 - 1500) * 6148914691236517"


@query("range_scan_wide", f"""SELECT o_orderkey, {SPREAD_KEY} AS key,
    CASE WHEN {SPREAD_KEY} < -4611686018427387904 THEN 0 WHEN {SPREAD_KEY} < 0 THEN 1
      WHEN {SPREAD_KEY} < 4611686018427387904 THEN 2 ELSE 3 END AS range_no FROM orders""")
def range_scan_wide(spark, sf_dir):
    """Keys spread over all bigints."""
    orders = load(spark, sf_dir, "orders").selectExpr("o_orderkey", f"{SPREAD_KEY} AS key")
    return scan_ranges(orders, "key", -(1 << 63), (1 << 63) - 1, 4, "range_no")


@query("range_scan_drops_outside",
       "SELECT o_orderkey, o_totalprice FROM orders WHERE o_custkey BETWEEN 100 AND 600")
def range_scan_drops_outside(spark, sf_dir):
    orders = load(spark, sf_dir, "orders")
    return scan_ranges(orders, "o_custkey", 100, 600, 5).select("o_orderkey", "o_totalprice")


def _sharded_lineitem(spark, sf_dir, columns):
    path = fresh_dir(spark, "shards")
    rows = load(spark, sf_dir, "lineitem").select(*columns)
    return write_sharded(rows, path, "value", 11, "l_orderkey")


@query("shard_scan", """SELECT l_returnflag, count(*) AS n, min(l_orderkey) AS first_key,
    max(l_orderkey) AS last_key, CAST(sum(CAST(round(l_quantity) AS BIGINT)) AS BIGINT) AS quantity
    FROM lineitem GROUP BY 1""")
def shard_scan(spark, sf_dir):
    """The bag union of eleven shards."""
    paths = _sharded_lineitem(spark, sf_dir, ["l_orderkey", "l_returnflag", "l_quantity"])
    return scan_shards(spark, paths).groupBy("l_returnflag").agg(
        F.count("*").alias("n"), F.min("l_orderkey").alias("first_key"),
        F.max("l_orderkey").alias("last_key"),
        F.sum(F.round("l_quantity").cast("bigint")).alias("quantity"))


@query("shard_range_scan", """SELECT l_orderkey, l_linenumber FROM lineitem
    WHERE l_orderkey BETWEEN 1000 AND 9000""")
def shard_range_scan(spark, sf_dir):
    paths = _sharded_lineitem(spark, sf_dir, ["l_orderkey", "l_linenumber"])
    return scan_shards(spark, paths, "l_orderkey", 1000, 9000, ["l_orderkey", "l_linenumber"])


# ---- chunks -----------------------------------------------------------------


@query("chunks_even", """WITH s AS (SELECT min(o_orderkey) AS lo, max(o_orderkey) AS hi,
      greatest(CAST(floor(ceil((max(o_orderkey) - min(o_orderkey) + 1) * 10000 / count(*)) / 10000 * 4000)
        AS BIGINT), 1) AS step, count(*) AS n FROM orders)
    SELECT CAST(CASE WHEN n <= 4000 THEN 0 ELSE least((o_orderkey - lo) // step, (hi - lo) // step)
        END AS INTEGER) AS chunk_id, count(*) AS n, min(o_orderkey) AS first_key,
      max(o_orderkey) AS last_key FROM orders, s GROUP BY 1""")
def chunks_even(spark, sf_dir):
    orders = load(spark, sf_dir, "orders").select("o_orderkey")
    return _chunk_sizes(orders, plan_chunks(spark, orders, "o_orderkey", 4000), "o_orderkey")


def _chunk_sizes(df, plan, key):
    return label_chunks(df, plan).groupBy("chunk_id").agg(
        F.count("*").alias("n"), F.min(key).alias("first_key"), F.max(key).alias("last_key"))


@query("chunks_even_sparse", """WITH o AS (SELECT o_orderkey * 10 AS key FROM orders),
    s AS (SELECT min(key) AS lo, max(key) AS hi, count(*) AS n, greatest(CAST(floor(
        ceil((max(key) - min(key) + 1) * 10000 / count(*)) / 10000 * 300) AS BIGINT), 1) AS step FROM o)
    SELECT CAST(CASE WHEN n <= 300 THEN 0 ELSE least((key - lo) // step, (hi - lo) // step)
        END AS INTEGER) AS chunk_id, count(*) AS n, min(key) AS first_key, max(key) AS last_key
    FROM o, s GROUP BY 1""")
def chunks_even_sparse(spark, sf_dir):
    """Keys ten apart: chunks go by rows, not by the span of the keys."""
    orders = load(spark, sf_dir, "orders").select((F.col("o_orderkey") * 10).alias("key"))
    return _chunk_sizes(orders, plan_chunks(spark, orders, "key", 300), "key")


def _rank_chunks_sql(table: str, key: str, size: int) -> str:
    """Chunks by rank: a key starts one when it holds a step row or follows a heavy key."""
    step = size - 1
    return f"""WITH k AS (SELECT {key} AS key, count(*) AS n FROM {table}
            WHERE {key} IS NOT NULL GROUP BY 1),
    r AS (SELECT key, n, CAST(sum(n) OVER (ORDER BY key) AS BIGINT) - n AS before,
            lag(n) OVER (ORDER BY key) AS previous, max(key) OVER () AS high FROM k),
    c AS (SELECT key, n, CAST(sum(CASE WHEN key < high AND before > 0 AND
            ((before + n - 1) // {step} > (before - 1) // {step} OR previous > {step})
            THEN 1 ELSE 0 END) OVER (ORDER BY key) AS INTEGER) AS chunk_id FROM r)
    SELECT chunk_id, CAST(sum(n) AS BIGINT) AS n, min(key) AS first_key, max(key) AS last_key
    FROM (SELECT chunk_id, n, key FROM c
          UNION ALL SELECT 0, count(*), NULL FROM {table} WHERE {key} IS NULL HAVING count(*) > 0)
    GROUP BY 1"""


@query("chunks_uneven", _rank_chunks_sql("lineitem", "l_orderkey", 4000))
def chunks_uneven(spark, sf_dir):
    """Repeated keys: the rows of one never part."""
    lines = load(spark, sf_dir, "lineitem").select("l_orderkey")
    return _chunk_sizes(lines, plan_by_rank(spark, lines, "l_orderkey", 4000), "l_orderkey")


@query("chunks_many", _rank_chunks_sql("lineitem", "l_orderkey", 20))
def chunks_many(spark, sf_dir):
    """Thousands of chunks go the same way as a few."""
    lines = load(spark, sf_dir, "lineitem").select("l_orderkey")
    return _chunk_sizes(lines, plan_by_rank(spark, lines, "l_orderkey", 20), "l_orderkey")


WIDE_KEY = "CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE o_orderkey * 1099511627776 + 1 END"


@query("chunks_wide_key", _rank_chunks_sql(
    f"(SELECT {WIDE_KEY} AS key FROM orders)", "key", 4))
def chunks_wide_key(spark, sf_dir):
    """Keys beyond what a double holds, some of them null."""
    orders = wide_keys(load(spark, sf_dir, "orders"))
    return _chunk_sizes(orders, plan_by_rank(spark, orders, "key", 4), "key")


def wide_keys(orders):
    """The wide keys as bigints; as whole decimals where one would not fit a bigint."""
    low, high = orders.where("o_orderkey % 50 <> 0").agg(
        F.min("o_orderkey"), F.max("o_orderkey")).first()
    if low is None or -(1 << 23) <= low and high < 1 << 23:
        return orders.selectExpr(f"{WIDE_KEY} AS key")
    decimals = WIDE_KEY.replace("ELSE o_orderkey", "ELSE CAST(o_orderkey AS DECIMAL(19, 0))")
    return orders.selectExpr(f"CAST({decimals} AS DECIMAL(38, 0)) AS key")


NAN_KEY = "CASE WHEN l_linenumber = 7 THEN CAST('NaN' AS DOUBLE) ELSE l_extendedprice END"


@query("chunks_nan_key", f"""SELECT chunk_id, n, first_key FROM ({_rank_chunks_sql(
    f"(SELECT {NAN_KEY} AS key FROM lineitem)", "key", 100)})""")
def chunks_nan_key(spark, sf_dir):
    """A double key; not-a-number is the largest."""
    lines = load(spark, sf_dir, "lineitem").selectExpr(f"{NAN_KEY} AS key")
    return _chunk_sizes(lines, plan_by_rank(spark, lines, "key", 100), "key").drop("last_key")


@query("chunks_text_key", _rank_chunks_sql("customer", "c_name", 400))
def chunks_text_key(spark, sf_dir):
    customers = load(spark, sf_dir, "customer").select("c_name")
    return _chunk_sizes(customers, plan_chunks(spark, customers, "c_name", 400), "c_name")


@query("chunk_snapshot", """SELECT 'orders' AS table_name, CAST(o_orderkey AS VARCHAR) AS key,
      o_orderstatus AS payload FROM orders
    UNION ALL SELECT 'customer', c_name, c_mktsegment FROM customer""")
def chunk_snapshot(spark, sf_dir):
    """Two tables captured once, chunk by chunk, in waves."""
    orders, customer = (load(spark, sf_dir, t) for t in ("orders", "customer"))
    out = fresh_dir(spark, "snapshot")
    snapshot(spark, {"orders": (orders, "o_orderkey"), "customer": (customer, "c_name")}, out,
             size=4000, waves=2)
    return read_snapshot(spark, out, "orders").select(
        F.lit("orders").alias("table_name"), F.col("o_orderkey").cast("string").alias("key"),
        F.col("o_orderstatus").alias("payload")).unionByName(
        read_snapshot(spark, out, "customer").select(
            F.lit("customer").alias("table_name"), F.col("c_name").alias("key"),
            F.col("c_mktsegment").alias("payload")))


# ---- placement --------------------------------------------------------------


@query("place_value", """SELECT o_orderkey, CAST(o_orderkey % 7 AS INTEGER) AS shard,
    CAST(abs((o_orderkey - 8000) % 7) AS INTEGER) AS shifted,
    CAST(abs(trunc(o_totalprice - trunc(o_totalprice / 7) * 7)) AS INTEGER) AS by_price FROM orders""")
def place_value(spark, sf_dir):
    orders = load(spark, sf_dir, "orders").withColumn("low", F.col("o_orderkey") - 8000)
    return orders.select("o_orderkey", P.by_value(orders, "o_orderkey", 7).alias("shard"),
                         P.by_value(orders, "low", 7).alias("shifted"),
                         P.by_value(orders, "o_totalprice", 7).alias("by_price"))


@query("place_value_decimal", """SELECT c_custkey, CAST(((CAST(trunc(c_acctbal) AS BIGINT) % 7) + 7) % 7
    AS INTEGER) AS shard FROM customer""")
def place_value_decimal(spark, sf_dir):
    """Decimals: the non-negative residue of the integer part."""
    exact = load(spark, sf_dir, "customer").select(
        "c_custkey", F.col("c_acctbal").cast("decimal(18,2)").alias("balance"))
    return exact.select("c_custkey", P.by_value(exact, "balance", 7).alias("shard"))


@query("place_hash_long", """WITH k AS (SELECT o_orderkey * 3000000019 AS key FROM orders),
    h AS (SELECT key, xor(key, key >> 32) & 4294967295 AS low FROM k)
    SELECT key, CAST(abs((CASE WHEN low >= 2147483648 THEN low - 4294967296 ELSE low END) % 7)
      AS INTEGER) AS shard FROM h""")
def place_hash_long(spark, sf_dir):
    keys = load(spark, sf_dir, "orders").select(
        (F.col("o_orderkey") * F.lit(3_000_000_019)).alias("key"))
    return keys.select("key", P.hashed_long("key", 7).alias("shard"))


@query("place_hash_consistent", """SELECT count(DISTINCT user_id) AS users,
    count(DISTINCT user_id) AS placements, true AS in_range FROM events""")
def place_hash_consistent(spark, sf_dir):
    """Each user lands on exactly one of 7 shards."""
    placed = P.with_shard(load(spark, sf_dir, "events").select("user_id"), "hash", 7, "user_id")
    pairs = placed.groupBy("user_id", "shard").agg(F.count("*").alias("n"))
    return pairs.agg(F.count_distinct("user_id").alias("users"), F.count("*").alias("placements"),
                     F.bool_and(F.col("shard").between(0, 6)).alias("in_range"))


@query("place_balanced_sizes", """SELECT count(*) AS total, true AS even_in_tasks,
    CAST(7 AS BIGINT) AS shards FROM lineitem""")
def place_balanced_sizes(spark, sf_dir):
    """Within a task the sizes of two shards differ by at most one row."""
    placed = P.with_shard(load(spark, sf_dir, "lineitem").select("l_orderkey"), "balanced", 7)
    sizes = placed.groupBy(F.spark_partition_id().alias("task"), "shard").agg(
        F.count("*").alias("n"))
    tasks = sizes.groupBy("task").agg(F.sum("n").alias("rows"), F.max("n").alias("most"),
                                      F.when(F.count("*") < 7, 0).otherwise(F.min("n")).alias("least"),
                                      F.collect_set("shard").alias("seen"))
    return tasks.agg(F.sum("rows").alias("total"),
                     F.bool_and(F.col("most") - F.col("least") <= 1).alias("even_in_tasks"),
                     F.max(F.size("seen")).cast("bigint").alias("shards"))


@query("place_random_domain", """SELECT count(*) AS total, true AS in_range FROM lineitem""")
def place_random_domain(spark, sf_dir):
    placed = P.with_shard(load(spark, sf_dir, "lineitem").select("l_orderkey"), "shuffle", 7, seed=3)
    return placed.agg(F.count("*").alias("total"),
                      F.bool_and(F.col("shard").between(0, 6)).alias("in_range"))
