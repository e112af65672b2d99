"""Projection, filter, function, JSON and event jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from changeflow.functions import text as X
from changeflow.functions import time as C
from changeflow.operators import shaping as S
from changeflow.operators.changelog import additions, as_retract_pairs
from changeflow.operators.predicates import all_of, expand, project, union_streams
from changeflow.plans import derived as D
from changeflow.plans.registry import load, query

# ---- projections ------------------------------------------------------------


@query("select_reorder", "SELECT n_name, n_regionkey, n_nationkey FROM nation")
def select_reorder(spark, sf_dir):
    return project(load(spark, sf_dir, "nation"), ["n_name", "n_regionkey", "n_nationkey"])


@query("const_alias_cast", """SELECT c_custkey AS distinct_id, c_mktsegment AS tag_value,
    '2024-01-01' AS base_day, 'g1' AS g_key, CAST(c_nationkey AS VARCHAR) AS tag_code
    FROM customer""")
def const_alias_cast(spark, sf_dir):
    return load(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("distinct_id"), F.col("c_mktsegment").alias("tag_value"),
        F.lit("2024-01-01").alias("base_day"), F.lit("g1").alias("g_key"),
        F.col("c_nationkey").cast("string").alias("tag_code"))


@query("struct_expand", f"""WITH {D.ENVELOPES_SQL}
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM env WHERE kind IN (0, 1)""")
def struct_expand(spark, sf_dir):
    envelopes = D.order_envelopes(spark, sf_dir).where(F.col("after").isNotNull())
    return expand(envelopes, "after")


@query("payload_expand", f"""WITH {D.USER_CHANGES_SQL}
    SELECT user_id, value FROM changes WHERE op IN ('+I', '+U')""")
def payload_expand(spark, sf_dir):
    pairs = as_retract_pairs(D.user_changes(spark, sf_dir))
    return expand(pairs.where("is_add"), "payload", ["user_id", "value"])


@query("time_parts", """SELECT event_id, strftime(ts, '%Y-%m-%d') AS dt, strftime(ts, '%H') AS hr,
    strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d') AS local_dt,
    strftime(ts + INTERVAL 8 HOUR, '%H') AS local_hr FROM events""")
def time_parts(spark, sf_dir):
    rows = D.event_rows(spark, sf_dir)
    utc = C.with_time_parts(rows, "ts_ms")
    both = C.with_time_parts(utc, "ts_ms", "Asia/Shanghai", "local_dt", "local_hr")
    return both.select("event_id", "dt", "hr", "local_dt", "local_hr")


# ---- filters ----------------------------------------------------------------


@query("predicates_cmp", """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
    WHERE l_quantity >= 10 AND l_quantity < 40 AND l_discount > 0.02 AND l_discount <= 0.08
      AND l_returnflag <> 'N' AND l_linestatus = 'F'""")
def predicates_cmp(spark, sf_dir):
    q, d = F.col("l_quantity"), F.col("l_discount")
    return load(spark, sf_dir, "lineitem").where(
        (q >= 10) & (q < 40) & (d > 0.02) & (d <= 0.08) & (F.col("l_returnflag") != "N")
        & (F.col("l_linestatus") == "F")).select("l_orderkey", "l_linenumber", "l_quantity")


@query("predicates_bool", """SELECT l_orderkey, l_linenumber FROM lineitem
    WHERE (l_quantity < 5 OR (l_discount = 0.05 AND l_returnflag = 'R')) AND l_linestatus = 'O'""")
def predicates_bool(spark, sf_dir):
    either = (F.col("l_quantity") < 5) | ((F.col("l_discount") == 0.05)
                                          & (F.col("l_returnflag") == "R"))
    return load(spark, sf_dir, "lineitem").where(either & (F.col("l_linestatus") == "O")) \
        .select("l_orderkey", "l_linenumber")


@query("predicates_in", """SELECT event_id, event_type FROM events
    WHERE event_type IN ('click', 'view') AND user_id IN (1, 2, 3, 5, 8, 13, 21, 34, 55, 89)""")
def predicates_in(spark, sf_dir):
    """An OR of equalities on one column; the optimiser makes it an IN."""
    kind = F.col("event_type")
    return load(spark, sf_dir, "events").where(
        ((kind == "click") | (kind == "view"))
        & F.col("user_id").isin(1, 2, 3, 5, 8, 13, 21, 34, 55, 89)).select("event_id", "event_type")


@query("predicates_null", f"""WITH {D.TRACES_SQL}
    SELECT uuid, queryString AS query_string FROM trace
    WHERE projectId IS NULL AND queryString IS NOT NULL""")
def predicates_null(spark, sf_dir):
    return D.traces(spark, sf_dir).where(
        all_of([("projectId", "IS_NULL"), ("queryString", "IS_NOT_NULL")])) \
        .select("uuid", F.col("queryString").alias("query_string"))


@query("literal_left_operand", "SELECT o_orderkey FROM orders WHERE 200000.0 < o_totalprice")
def literal_left_operand(spark, sf_dir):
    """The literal on the left keeps its place in the comparison."""
    return load(spark, sf_dir, "orders").where(F.lit(200000.0) < F.col("o_totalprice")) \
        .select("o_orderkey")


@query("typed_predicates", """SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders
    WHERE o_totalprice > 100000 AND o_totalprice <= 300000 AND o_orderkey >= 100
      AND o_custkey < 1000 AND o_orderstatus IN ('F', 'O') AND o_orderpriority = '5-LOW'
      AND o_orderdate IS NOT NULL""")
def typed_predicates(spark, sf_dir):
    terms = [("o_totalprice", "GREATER", 100000.0), ("o_totalprice", "LESS_EQUAL", 300000.0),
             ("o_orderkey", "GREATER_EQUAL", 100), ("o_custkey", "LESS", 1000),
             ("o_orderstatus", "IS_IN", ["F", "O"]), ("o_orderpriority", "EQUAL", "5-LOW"),
             ("o_orderdate", "IS_NOT_NULL")]
    return load(spark, sf_dir, "orders").where(all_of(terms)) \
        .select("o_orderkey", "o_orderstatus", "o_totalprice")


@query("tenant_filter_count", """SELECT user_id AS tenant_id, count(*) AS pv FROM events
    WHERE user_id > 0 GROUP BY 1""")
def tenant_filter_count(spark, sf_dir):
    return load(spark, sf_dir, "events").where(all_of([("user_id", "GREATER", 0)])) \
        .groupBy(F.col("user_id").alias("tenant_id")).agg(F.count("*").alias("pv"))


# 2024-01-31 00:00:00 UTC
NOW_MS = 1_706_659_200_000


@query("recent_filter", f"""SELECT event_id, epoch_us(ts) // 1000 AS ts_ms FROM events
    WHERE floor(({NOW_MS} - epoch_us(ts) // 1000) / 86400000.0) <= 7""")
def recent_filter(spark, sf_dir):
    return C.recent(D.event_rows(spark, sf_dir), "ts_ms", 7, NOW_MS).select("event_id", "ts_ms")


@query("additions_only", f"""WITH {D.USER_CHANGES_SQL}
    SELECT op, event_id, user_id, event_type, value FROM changes WHERE op IN ('+I', '+U')""")
def additions_only(spark, sf_dir):
    return additions(D.user_changes(spark, sf_dir)).drop("ts")


@query("null_key_guard", f"WITH {D.TRACES_SQL} "
       "SELECT projectId AS project, count(*) AS n FROM trace WHERE projectId IS NOT NULL GROUP BY 1")
def null_key_guard(spark, sf_dir):
    return S.flatten_trace(D.traces(spark, sf_dir)).groupBy(F.col("projectId").alias("project")) \
        .agg(F.count("*").alias("n"))


@query("union_all", """SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice >= 150000
    UNION ALL SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice < 250000""")
def union_all(spark, sf_dir):
    """A bag union: rows of both branches appear twice."""
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return union_streams(orders.where("o_totalprice >= 150000"),
                         orders.where("o_totalprice < 250000"))


# ---- scalar functions -------------------------------------------------------


@query("datetime_functions", """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS second_text,
    strftime(ts, '%Y/%m/%d') AS day_text, 'p' || '-' || strftime(ts, '%Y-%m') AS month_text,
    strftime(to_timestamp(epoch_us(ts) // 1000000) AT TIME ZONE 'UTC', '%H:%M') AS clock,
    date_diff('second', TIMESTAMP '2024-01-01', ts) // 86400 AS days_in
    FROM events""")
def datetime_functions(spark, sf_dir):
    """Format, reparse, month of a text, epoch rendering and whole days."""
    rows = load(spark, sf_dir, "events").select(
        "event_id", "ts", C.epoch_ms(F.col("ts")).alias("ms"))
    text = rows.withColumn("second_text", C.format_ms(F.col("ms")))
    start = 1_704_067_200_000
    return text.select(
        "event_id", "second_text",
        C.reformat(F.col("second_text"), C.SECOND, "yyyy/MM/dd").alias("day_text"),
        F.concat(F.lit("p"), F.lit("-"), F.substring("second_text", 1, 7)).alias("month_text"),
        C.format_ms(F.col("ms"), "HH:mm").alias("clock"),
        C.whole_days(F.col("ms"), F.lit(start)).cast("bigint").alias("days_in"))


@query("time_of_day", """SELECT event_id, strftime(TIMESTAMP '1970-01-02' +
    to_milliseconds((event_id * 1000) % 86400000), '%Y-%m-%d %H:%M:%S') AS stored FROM events""")
def time_of_day(spark, sf_dir):
    """Times of day are stored on 1970-01-02."""
    ms = F.pmod(F.col("event_id") * 1000, F.lit(C.MS_PER_DAY))
    return load(spark, sf_dir, "events").select(
        "event_id", F.date_format(C.time_of_day(ms), C.SECOND).alias("stored"))


@query("casts", """SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS as_text,
    CAST(CAST(o_custkey AS VARCHAR) AS BIGINT) AS as_long,
    CAST(o_orderkey % 100 AS TINYINT) AS as_byte, CAST(o_orderkey % 30000 AS SMALLINT) AS as_short,
    CAST(TRY_CAST(o_orderpriority AS BIGINT) AS VARCHAR) AS unreadable,
    CAST(encode(o_orderstatus) AS VARCHAR) AS as_bytes_text FROM orders""")
def casts(spark, sf_dir):
    key = F.col("o_orderkey")
    return load(spark, sf_dir, "orders").select(
        "o_orderkey", key.cast("string").alias("as_text"),
        F.col("o_custkey").cast("string").cast("bigint").alias("as_long"),
        (key % 100).cast("tinyint").alias("as_byte"),
        (key % 30000).cast("smallint").alias("as_short"),
        F.col("o_orderpriority").try_cast("bigint").cast("string").alias("unreadable"),
        F.col("o_orderstatus").cast("binary").cast("string").alias("as_bytes_text"))


@query("blank_test", f"""WITH {D.TRACES_SQL}
    SELECT uuid, coalesce(userId, '') = '' AS is_blank FROM trace""")
def blank_test(spark, sf_dir):
    return D.traces(spark, sf_dir).select("uuid", X.is_blank(F.col("userId")).alias("is_blank"))


# ---- JSON -------------------------------------------------------------------

_EVENT_ROWS_SQL = "SELECT event_id, user_id, event_type, value, epoch_us(ts) // 1000 AS ts_ms FROM events"


@query("json_explode_roundtrip", _EVENT_ROWS_SQL)
def json_explode_roundtrip(spark, sf_dir):
    rows = S.explode_json(D.packed_events(spark, sf_dir), "body", D.EVENT_ITEM)
    return rows.drop("message_id")


@query("json_object_parse", _EVENT_ROWS_SQL)
def json_object_parse(spark, sf_dir):
    return S.parse_json(D.event_messages(spark, sf_dir), "value", D.EVENT_ITEM)


@query("json_quarantine", """SELECT event_id, event_type, event_id % 50 <> 0 AS readable
    FROM events""")
def json_quarantine(spark, sf_dir):
    """Every 50th message is cut off; readable and unreadable ones are told apart."""
    cut = F.expr("substring(value, 1, length(value) - 3)")
    rows = D.event_rows(spark, sf_dir)
    torn = rows.select(
        F.col("event_id").alias("id"), F.col("event_type").alias("kind"),
        F.to_json(F.struct(*rows.columns)).alias("value")) \
        .withColumn("value", F.when(F.col("id") % 50 == 0, cut).otherwise(F.col("value")))
    good = S.parse_json(torn, "value", D.EVENT_ITEM, on_error="quarantine")
    bad = S.unreadable_json(torn, "value", D.EVENT_ITEM)
    return good.select("event_id", "event_type", F.lit(True).alias("readable")).unionByName(
        bad.select(F.col("id").alias("event_id"), F.col("kind").alias("event_type"),
                   F.lit(False).alias("readable")))


@query("json_render", """SELECT event_id, CASE WHEN event_id % 2 = 0
    THEN '{"event_id":' || event_id || ',"event_type":"' || event_type || '"}'
    ELSE '{"event_id":' || event_id || '}' END AS body FROM events""")
def json_render(spark, sf_dir):
    """Null fields are left out of the text."""
    rows = load(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("event_id") % 2 == 0, F.col("event_type")).alias("event_type"))
    bodies = S.render_json(rows, ["event_id", "event_type"], "body")
    return bodies.select(F.get_json_object("body", "$.event_id").cast("bigint").alias("event_id"),
                         "body")


# ---- envelopes --------------------------------------------------------------


@query("envelope_normalize", f"""WITH {D.ENVELOPES_SQL}
    SELECT ts_ms AS ts, db AS dbname, 'orders' AS tablename, o_orderkey, o_totalprice,
      CASE kind WHEN 0 THEN 'i' WHEN 1 THEN 'u' ELSE 'd' END AS op,
      CAST({NOW_MS} AS BIGINT) AS system_time FROM env WHERE kind < 3""")
def envelope_normalize(spark, sf_dir):
    plain = S.normalize_envelope(D.order_envelopes(spark, sf_dir), NOW_MS)
    detail = "o_orderkey bigint, o_totalprice double, op string, system_time bigint"
    return S.parse_json(plain, "table_details", detail) \
        .withColumnsRenamed({"dbName": "dbname", "tableName": "tablename"})


@query("envelope_normalize_map", f"""WITH {D.ENVELOPES_SQL}
    SELECT db AS dbname, CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus,
      CASE kind WHEN 0 THEN 'i' WHEN 1 THEN 'u' ELSE 'd' END AS op FROM env WHERE kind < 3""")
def envelope_normalize_map(spark, sf_dir):
    """Images as string maps, as streams of many tables carry them."""
    def as_map(image):
        text = F.create_map(F.lit("o_orderkey"), F.col(f"{image}.o_orderkey").cast("string"),
                            F.lit("o_orderstatus"), F.col(f"{image}.o_orderstatus"))
        return F.when(F.col(image).isNotNull(), text).alias(image)

    maps = D.order_envelopes(spark, sf_dir).select(as_map("before"), as_map("after"), "source")
    plain = S.normalize_map_envelope(maps, NOW_MS)
    detail = "o_orderkey string, o_orderstatus string, op string"
    return S.parse_json(plain, "table_details", detail).select(
        F.col("dbName").alias("dbname"), "o_orderkey", "o_orderstatus", "op")


@query("envelope_images", f"""WITH {D.ENVELOPES_SQL}
    SELECT o_orderkey, CASE kind WHEN 0 THEN 'c' WHEN 2 THEN 'd' END AS op,
      CASE kind WHEN 1 THEN 'after' END AS after_mark,
      CASE kind WHEN 1 THEN 'before' END AS before_mark,
      CASE kind WHEN 0 THEN o_totalprice END AS inserted,
      CASE kind WHEN 1 THEN o_totalprice END AS updated_to,
      CASE kind WHEN 1 THEN o_totalprice - 1 END AS updated_from,
      CASE kind WHEN 2 THEN o_totalprice END AS deleted FROM env WHERE kind < 3""")
def envelope_images(spark, sf_dir):
    images = S.envelope_images(D.order_envelopes(spark, sf_dir))

    def price(column):
        return F.get_json_object(column, "$.o_totalprice").cast("double")

    key = F.get_json_object(F.coalesce("only_insert", "after_update", "before_delete"),
                            "$.o_orderkey").cast("bigint")
    return images.select(
        key.alias("o_orderkey"), "op", F.col("after").alias("after_mark"),
        F.col("before").alias("before_mark"), price("only_insert").alias("inserted"),
        price("after_update").alias("updated_to"), price("before_update").alias("updated_from"),
        price("before_delete").alias("deleted"))


@query("envelope_metadata", f"""WITH {D.ENVELOPES_SQL}
    SELECT db AS database_name, 'orders' AS table_name, ts_ms AS op_ts, count(*) AS n
    FROM env GROUP BY ALL""")
def envelope_metadata(spark, sf_dir):
    keys = ["database_name", "table_name", "op_ts"]
    return S.with_metadata(D.order_envelopes(spark, sf_dir), keys).groupBy(*keys) \
        .agg(F.count("*").alias("n"))


@query("changed_columns", f"""WITH {D.ENVELOPES_SQL}
    SELECT o_orderkey, 'o_totalprice' AS changed FROM env WHERE kind = 1""")
def changed_columns(spark, sf_dir):
    diff = S.changed_columns(D.order_envelopes(spark, sf_dir))
    return diff.select(F.col("after.o_orderkey").alias("o_orderkey"),
                       F.array_join("changed", ",").alias("changed"))


# ---- events -----------------------------------------------------------------

EVENT_DEFINITION = {"code": "E1", "name": "visit", "attributesJSON": [
    {"attributeId": "value"}, {"attributeId": "event_type"}, {"attributeId": "sceneId"}]}


@query("attribute_extract", """WITH attrs AS (
    SELECT *, unnest([1, 2, 3]) AS pos FROM events)
    SELECT event_id, 'E1' AS code, 'visit' AS name,
      strftime(ts, '%Y-%m-%d %H:%M:%S') AS occurred, CAST(user_id AS VARCHAR) AS account, pos - 1 AS pos,
      CASE pos WHEN 1 THEN 'value' WHEN 2 THEN 'event_type' ELSE 'sceneId' END AS attribute_id,
      CASE pos WHEN 1 THEN CAST(value AS VARCHAR) WHEN 2 THEN event_type
        ELSE CASE WHEN event_id % 2 = 0 THEN 's' || event_id END END AS attribute_value
    FROM attrs""")
def attribute_extract(spark, sf_dir):
    event = F.col("event_id")
    rows = D.event_rows(spark, sf_dir).select(
        "event_id", F.col("ts_ms").cast("string").alias("occurrenceTime"), "value", "event_type",
        F.when(event % 2 == 0, F.concat(F.lit("s"), event.cast("string"))).alias("sceneId"),
        event.cast("string").alias("channelCode"),
        F.col("user_id").cast("string").alias("accountId"))
    picked = S.extract_attributes(rows, EVENT_DEFINITION)
    return picked.select(
        F.col("channelCode").cast("bigint").alias("event_id"), F.col("eventId").alias("code"),
        F.col("eventName").alias("name"), F.col("occurrenceTime").alias("occurred"),
        F.col("accountId").alias("account"),
        F.posexplode("attributesJSON").alias("pos", "a")).select(
        "event_id", "code", "name", "occurred", "account", "pos",
        F.col("a.attributeId").alias("attribute_id"), F.col("a.value").alias("attribute_value"))


# last usable pair with key "from", as lists instead of one pattern
_CHANNEL_SQL = """coalesce(list_extract(list_transform(list_filter(list_transform(
      string_split(coalesce(queryString, ''), '&'), lambda s: string_split(rtrim(s, '='), '=')),
      lambda p: len(p) = 2 AND lower(p[1]) = 'from'), lambda p: p[2]), -1), '')"""

_LITE_SQL = f"""uuid AS id, projectId AS project_id, event_type AS event_name, userId AS user_id,
      url AS visit_url,
      CASE WHEN event_id % 2 = 0 THEN '/api/' || event_id ELSE url END AS request_url,
      strftime(ts, '%Y-%m-%d %H:%M:%S') AS visit_time,
      CASE WHEN event_id % 3 = 0 THEN 'app-a' WHEN event_id % 5 = 0 THEN 'app-b' END AS app_id,
      '10.0.0.' || (event_id % 200) AS visit_ip, {_CHANNEL_SQL} AS channel,
      CASE WHEN event_id % 4 <> 3 THEN CAST(event_id % 1000 AS VARCHAR) END AS cost_ms"""

_LITE_NAMES = {"projectId": "project_id", "eventName": "event_name", "userId": "user_id",
               "visitUrl": "visit_url", "url": "request_url", "visitTime": "visit_time",
               "appId": "app_id", "visitIp": "visit_ip", "visitByChannel": "channel",
               "requestCostTime": "cost_ms"}


@query("trace_lite", f"""WITH {D.TRACES_SQL}
    SELECT {_LITE_SQL} FROM trace WHERE projectId IS NOT NULL""")
def trace_lite(spark, sf_dir):
    flat = S.flatten_trace(D.traces(spark, sf_dir)).withColumnsRenamed(_LITE_NAMES)
    return flat.withColumn("cost_ms", F.col("cost_ms").cast("string"))


@query("trace_full", f"""WITH {D.TRACES_SQL}
    SELECT {_LITE_SQL}, 'web' AS subject, 'GET' AS method, 'visit' AS event_kind,
      'agent' AS agent, CAST(NULL AS VARCHAR) AS referer, '' AS scene,
      'act' || (event_id % 11) AS activity_id, 'promo' AS activity_type, '/v1/x' AS api,
      event_type AS detail, CAST(NULL AS VARCHAR) AS body, CAST(NULL AS VARCHAR) AS result,
      't' || (event_id % 13) AS tenant FROM trace WHERE projectId IS NOT NULL""")
def trace_full(spark, sf_dir):
    flat = S.flatten_trace(D.traces(spark, sf_dir), full=True).withColumnsRenamed(_LITE_NAMES)
    names = {"eventType": "event_kind", "userAgent": "agent", "refererUrl": "referer",
             "activityScene": "scene", "activityId": "activity_id",
             "activityType": "activity_type", "apiUri": "api", "eventDetail": "detail",
             "requestBody": "body", "requestResult": "result", "tenantId": "tenant"}
    return flat.withColumnsRenamed(names).drop("eventValue") \
        .withColumn("cost_ms", F.col("cost_ms").cast("string"))


@query("query_param", f"""WITH {D.TRACES_SQL} SELECT uuid, {_CHANNEL_SQL} AS channel FROM trace""")
def query_param(spark, sf_dir):
    return D.traces(spark, sf_dir).select(
        "uuid", X.query_param(F.col("queryString"), "from").alias("channel"))


@query("page_query_param", """SELECT page_id, coalesce(list_extract(list_transform(list_filter(
      list_transform(string_split(string_split(coalesce(nullif(regexp_extract(url,
        '^[^?]*\\?(.*)$', 1), ''), ''), '#')[1], '&'), lambda s: string_split(s, '=')),
      lambda p: len(p) = 2 AND lower(p[1]) = 'ref' AND p[2] <> ''), lambda p: p[2]), -1), '') AS ref
    FROM pages""")
def page_query_param(spark, sf_dir):
    return load(spark, sf_dir, "pages").select(
        "page_id", X.query_param(X.query_string(F.col("url")), "ref").alias("ref"))


@query("cookie_user", f"""WITH {D.TRACES_SQL}
    SELECT uuid, coalesce(nullif(userId, ''), cookie_id) AS visitor FROM trace""")
def cookie_user(spark, sf_dir):
    return D.traces(spark, sf_dir).select(
        "uuid", X.cookie_user(F.col("userId"), F.col("cookie")).alias("visitor"))


@query("cookie_skin", f"""WITH {D.TRACES_SQL}
    SELECT uuid, CASE event_id % 4 WHEN 2 THEN 'dark' ELSE '{X.UNKNOWN_SKIN}' END AS skin
    FROM trace""")
def cookie_skin(spark, sf_dir):
    return D.traces(spark, sf_dir).select("uuid", X.cookie_skin(F.col("cookie")).alias("skin"))
