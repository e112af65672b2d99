"""Count jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from changeflow.operators.counting import key_stats, pv_uv
from changeflow.operators.predicates import all_of
from changeflow.operators.profile import KeyProfile
from changeflow.operators.shaping import explode_json
from changeflow.functions.time import local_time
from changeflow.plans.derived import EVENT_ITEM, packed_events
from changeflow.plans.registry import load, query
from changeflow.session import fresh_dir


def _pv_uv_sql(pattern: str, who: str = "user_id") -> str:
    return f"""SELECT strftime(ts, '{pattern}') AS dt, event_type, count(*) AS pv,
      count(DISTINCT {who}) AS uv FROM events GROUP BY 1, 2"""


@query("pv_uv_daily", _pv_uv_sql("%Y-%m-%d"))
def pv_uv_daily(spark, sf_dir):
    return pv_uv(load(spark, sf_dir, "events"), "ts", ["event_type"], "user_id")


@query("pv_uv_hourly", _pv_uv_sql("%Y-%m-%d %H:00"))
def pv_uv_hourly(spark, sf_dir):
    return pv_uv(load(spark, sf_dir, "events"), "ts", ["event_type"], "user_id", "hour")


@query("pv_uv_degenerate", """SELECT strftime(ts, '%Y-%m-%d') AS dt, user_id AS tenant_id,
    count(*) AS pv, count(DISTINCT user_id) AS uv FROM events WHERE user_id > 0 GROUP BY 1, 2""")
def pv_uv_degenerate(spark, sf_dir):
    """Counting the group's own key: one visitor per group."""
    events = load(spark, sf_dir, "events").where("user_id > 0")
    tenants = events.select("ts", F.col("user_id").alias("tenant_id"))
    return pv_uv(tenants, "ts", ["tenant_id"], "tenant_id")


@query("count_grouped", """SELECT event_type, count(*) AS n,
    count(CASE WHEN value >= 10 THEN value END) AS n_valued FROM events GROUP BY 1""")
def count_grouped(spark, sf_dir):
    """count(*) counts nulls, count of a column does not."""
    valued = F.when(F.col("value") >= 10, F.col("value"))
    return load(spark, sf_dir, "events").groupBy("event_type").agg(
        F.count("*").alias("n"), F.count(valued).alias("n_valued"))


@query("count_distinct_grouped", """SELECT l_returnflag, count(DISTINCT l_suppkey) AS suppliers
    FROM lineitem GROUP BY 1""")
def count_distinct_grouped(spark, sf_dir):
    return load(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(
        F.count_distinct("l_suppkey").alias("suppliers"))


@query("key_stats", """SELECT min(l_orderkey) AS min_key, max(l_orderkey) AS max_key,
    count(*) AS row_count,
    ceil((max(l_orderkey) - min(l_orderkey) + 1) * 10000 / count(*)) / 10000 AS factor
    FROM lineitem""")
def key_stats_query(spark, sf_dir):
    return key_stats(load(spark, sf_dir, "lineitem"), "l_orderkey")


@query("key_profile", """SELECT min(l_orderkey) AS min_key, max(l_orderkey) AS max_key,
    count(*) AS row_count, ceil((max(l_orderkey) - min(l_orderkey) + 1) * 10000 / count(*)) / 10000 AS factor,
    true AS distinct_close, true AS median_close, true AS chunks_close FROM lineitem""")
def key_profile(spark, sf_dir):
    """A key's profile from sketches of three parts, added one after the other."""
    lines = load(spark, sf_dir, "lineitem").select("l_orderkey")
    profile = KeyProfile(spark, fresh_dir(spark, "profile"), "l_orderkey",
                         lines.schema["l_orderkey"].dataType)
    for part in range(3):
        profile.add(lines.where(F.col("l_orderkey") % 3 == part), str(part))
    exact = lines.agg(F.count_distinct("l_orderkey").alias("distinct"), F.count("*").alias("rows")).first()
    median, ends = profile.quantiles([0.5])[0], profile.chunk_ends(max(exact["rows"] // 10, 1))
    below = lines.agg(F.count(F.when(F.col("l_orderkey") <= median, 1))).first()[0] / exact["rows"]
    chunk = sum((F.col("l_orderkey") >= e).cast("int") for e in ends)
    largest = lines.groupBy(chunk.alias("chunk")).count().agg(F.max("count")).first()[0]
    stats = profile.stats()
    return stats.select("min_key", "max_key", "row_count", "factor",
                        (F.abs(F.col("distinct_count") / exact["distinct"] - 1) < 0.04).alias("distinct_close"),
                        F.lit(abs(below - 0.5) < 0.02).alias("median_close"),
                        F.lit(largest < 1.2 * exact["rows"] / 10).alias("chunks_close"))


@query("messages_to_daily_pv_uv", _pv_uv_sql("%Y-%m-%d"))
def messages_to_daily_pv_uv(spark, sf_dir):
    """The flagship job: JSON array messages to rows to daily counts."""
    rows = explode_json(packed_events(spark, sf_dir), "body", EVENT_ITEM)
    timed = rows.where(all_of([("user_id", "GREATER_EQUAL", 0)])) \
        .select("event_type", "user_id", local_time(F.col("ts_ms")).alias("ts"))
    return pv_uv(timed, "ts", ["event_type"], "user_id")
