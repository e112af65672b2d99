"""Change, envelope, trace and message streams derived from the given tables.

Each has its SQL twin for the oracles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.functions.number import whole_quotient
from changeflow.functions.text import query_string
from changeflow.functions.time import SECOND, epoch_ms
from changeflow.plans.registry import load

# The change kind each event type stands for.
OPS = {"signup": "+I", "view": "+U", "click": "-U", "error": "-D", "purchase": "+U"}

OP_SQL = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in OPS.items()) + " END"


def op_column():
    kinds = F.create_map(*[F.lit(x) for pair in OPS.items() for x in pair])
    return F.try_element_at(kinds, F.col("event_type"))


def user_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A changelog with few, often changed keys: ``user_id``."""
    return load(spark, sf_dir, "events").select(
        op_column().alias("op"), "user_id", "ts", "event_id", "event_type", "value")


USER_CHANGES_SQL = f"""changes AS (
  SELECT {OP_SQL} AS op, user_id, ts, event_id, event_type, value FROM events)"""


def customer_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A changelog of the customer table, four changes a key, some keys unknown to it."""
    event = F.col("event_id")
    return load(spark, sf_dir, "events").select(
        op_column().alias("op"), "ts", "event_id",
        whole_quotient(event, 4).alias("c_custkey"),
        F.concat(F.lit("Changed#"), event.cast("string")).alias("c_name"),
        F.pmod(event, F.lit(25)).cast("int").alias("c_nationkey"),
        F.col("value").alias("c_acctbal"),
        F.upper("event_type").alias("c_mktsegment"))


CUSTOMER_CHANGES_SQL = f"""changes AS (
  SELECT {OP_SQL} AS op, ts, event_id, event_id // 4 AS c_custkey,
         'Changed#' || event_id AS c_name, CAST(event_id % 25 AS INTEGER) AS c_nationkey,
         value AS c_acctbal, upper(event_type) AS c_mktsegment FROM events)"""


def order_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change envelopes of the orders table.

    By order key modulo 4: an insert, an update (the price was one less), a
    delete, and an empty envelope.
    """
    orders = load(spark, sf_dir, "orders")
    kind = F.pmod("o_orderkey", F.lit(4))
    names = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]
    after = F.struct(*names)
    before = F.struct(*[(F.col(c) - 1).alias(c) if c == "o_totalprice" else F.col(c)
                        for c in names])
    source = F.struct(
        epoch_ms(F.col("o_orderdate")).alias("ts_ms"),
        F.concat(F.lit("d"), F.pmod("o_custkey", F.lit(2)).cast("string")).alias("db"),
        F.lit("orders").alias("table"))
    return orders.select(
        F.when(kind == 1, before).when(kind == 2, after).alias("before"),
        F.when(kind.isin(0, 1), after).alias("after"), source.alias("source"))


ENVELOPES_SQL = """env AS (
  SELECT *, o_orderkey % 4 AS kind, epoch_us(o_orderdate) // 1000 AS ts_ms,
         'd' || (o_custkey % 2) AS db FROM orders)"""

EVENT_ITEM = "event_id bigint, user_id bigint, event_type string, value double, ts_ms bigint"


def event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", "value", epoch_ms(F.col("ts")).alias("ts_ms"))


def packed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages as producers send them: a JSON array of up to 8 neighbouring events."""
    rows = event_rows(spark, sf_dir)
    item = F.struct("event_id", "user_id", "event_type", "value", "ts_ms")
    packed = rows.groupBy(whole_quotient(F.col("event_id"), 8).alias("message_id")) \
        .agg(F.collect_list(item).alias("items"))
    return packed.select("message_id", F.to_json("items").alias("body"))


def event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON object per event."""
    return event_rows(spark, sf_dir).select(F.to_json(F.struct("*")).alias("value"))


def traces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trace events: each event visits a page."""
    events, pages = (load(spark, sf_dir, t) for t in ("events", "pages"))
    many = pages.agg(F.max("page_id") + 1).first()[0]
    event = F.col("event_id")
    visits = events.withColumn("page_id", F.pmod(event, F.lit(many)))
    on_page = visits.join(pages.select("page_id", "url"), "page_id")
    query = query_string(F.col("url"))
    marked = F.when(event % 3 == 0, F.concat(F.coalesce(query, F.lit("q=1")),
                                             F.lit("&From=ch"), (event % 7).cast("string"),
                                             F.lit("&from="))) \
        .when(event % 3 == 1, F.regexp_replace(query, "ref=", "from="))
    value = F.to_json(F.struct(
        F.when(event % 2 == 0, F.concat(F.lit("/api/"), event.cast("string"))).alias("requestUrl"),
        F.when(event % 3 == 0, F.lit("app-a")).alias("appId"),
        F.when(event % 5 == 0, F.lit("app-b")).alias("appid_"),
        F.concat(F.lit("act"), (event % 11).cast("string")).alias("activityId"),
        F.lit("promo").alias("activityType"),
        F.col("event_type").alias("eventName"),
        F.when(event % 4 != 3, (event % 1000).cast("string")).alias("costTime"),
        F.concat(F.lit("t"), (event % 13).cast("string")).alias("tenantId"),
        F.lit("/v1/x").alias("api")))
    cookie = (F.when(event % 4 == 1, F.to_json(F.struct(
                  F.concat(F.lit("o"), event.cast("string")).alias("cookie_open_id"))))
              .when(event % 4 == 2, F.to_json(F.struct(
                  F.concat(F.lit("s"), event.cast("string")).alias("JSESSIONID"),
                  F.lit("dark").alias("mulri_skin_id"))))
              .when(event % 4 == 3, F.lit("{}")))
    return on_page.select(
        event.cast("string").alias("uuid"),
        F.when(event % 10 != 0, F.concat(F.lit("p"), (event % 3).cast("string"))).alias("projectId"),
        F.col("event_type").alias("event"),
        F.when(event % 6 == 0, F.col("user_id").cast("string"))
         .when(event % 6 == 1, F.lit("")).alias("userId"),
        "url", marked.alias("queryString"),
        F.date_format("ts", SECOND).alias("createTime"),
        F.regexp_replace(value, "appid_", "appid").alias("value"), cookie.alias("cookie"),
        F.concat(F.lit("10.0.0."), (event % 200).cast("string")).alias("iPv4"),
        F.lit("web").alias("subject"), F.lit("GET").alias("method"),
        F.lit("visit").alias("eventType"), F.lit("agent").alias("userAgent"),
        F.lit(None).cast("string").alias("referer"))


TRACES_SQL = """visits AS (
  SELECT e.*, p.url, nullif(regexp_extract(p.url, '^[^?#]*\\?([^#]*)', 1), '') AS query
  FROM events e JOIN pages p ON p.page_id = e.event_id % (SELECT max(page_id) + 1 FROM pages)),
trace AS (
  SELECT *, CAST(event_id AS VARCHAR) AS uuid,
    CASE WHEN event_id % 10 <> 0 THEN 'p' || (event_id % 3) END AS projectId,
    CASE event_id % 6 WHEN 0 THEN CAST(user_id AS VARCHAR) WHEN 1 THEN '' END AS userId,
    CASE event_id % 3
      WHEN 0 THEN coalesce(query, 'q=1') || '&From=ch' || (event_id % 7) || '&from='
      WHEN 1 THEN replace(query, 'ref=', 'from=') END AS queryString,
    CASE event_id % 4 WHEN 1 THEN 'o' || event_id WHEN 2 THEN 's' || event_id
      WHEN 3 THEN '' END AS cookie_id
  FROM visits)"""


def raw_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their value as text, unreadable for every 97th."""
    return load(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type",
        F.when(F.col("event_id") % 97 == 0, "x").otherwise(F.col("value").cast("string"))
         .alias("value"))
