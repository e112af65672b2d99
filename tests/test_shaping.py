"""JSON, envelopes, traces, text and time."""

import pytest
from pyspark.sql import functions as F

from changeflow.functions import text as X
from changeflow.functions import time as C
from changeflow.operators import shaping as S


def one(spark, column, **values):
    schema = ", ".join(f"{k} {'bigint' if isinstance(v, int) else 'string'}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], schema).select(column).first()[0]


@pytest.mark.parametrize("query, expected", [
    ("from=a&FROM=b&from=c=d", "b"), ("from=", ""), ("a=1", ""), ("", ""), (None, ""),
    ("from=a&&x=1", "a"), ("xfrom=1", ""), ("from=x=", "x"), ("=x&from=y", "y"), ("from", ""),
    ("a=1&From=b", "b"), ("from=a&from=", "a"),
])
def test_query_param(spark, query, expected):
    assert one(spark, X.query_param(F.col("q"), "from"), q=query) == expected


@pytest.mark.parametrize("user, cookie, expected", [
    ("u", '{"cookie_open_id":"o"}', "u"), ("", '{"cookie_open_id":"o","JSESSIONID":"s"}', "o"),
    (None, '{"JSESSIONID":"s"}', "s"), (None, '{"cookie_open_id":"","JSESSIONID":"s"}', "s"),
    (None, "{}", ""), (None, "", None), (None, None, None), ("", None, None),
])
def test_cookie_user(spark, user, cookie, expected):
    assert one(spark, X.cookie_user(F.col("u"), F.col("c")), u=user, c=cookie) == expected


@pytest.mark.parametrize("cookie, expected", [
    ('{"mulri_skin_id":"dark"}', "dark"), ("{}", "未知"), ("", "未知"), (None, "未知")])
def test_cookie_skin(spark, cookie, expected):
    assert one(spark, X.cookie_skin(F.col("c")), c=cookie) == expected


def test_times_do_not_follow_the_session_zone(spark):
    ms, zone = 1_700_000_000_123, spark.conf.get("spark.sql.session.timeZone")
    try:
        for session in ("UTC", "America/New_York", "Asia/Shanghai"):
            spark.conf.set("spark.sql.session.timeZone", session)
            assert one(spark, C.format_ms(F.col("m")), m=ms) == "2023-11-14 22:13:20"
            assert one(spark, C.format_ms(F.col("m"), C.SECOND, "Asia/Shanghai"), m=ms) == \
                "2023-11-15 06:13:20"
            assert one(spark, C.epoch_ms(C.local_time(F.col("m"), "Asia/Shanghai"),
                                         "Asia/Shanghai"), m=ms) == ms
            # July, an hour inside a clock change of New York, and a time before the epoch
            for moment in (1_720_000_000_999, 1_699_162_200_000, 1_699_165_800_000, -1):
                assert one(spark, C.epoch_ms(C.local_time(F.col("m"))), m=moment) == moment
            assert one(spark, F.date_format(C.time_of_day(F.col("m")), C.SECOND), m=3_600_000) == \
                "1970-01-02 01:00:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_processing_day(spark):
    days = C.with_processing_day(spark.range(1), 1_706_720_400_000, "Asia/Shanghai").first()
    assert days["dt"] == "2024-02-01"
    assert len(C.with_processing_day(spark.range(1)).first()["dt"]) == 10


def test_recent(spark):
    now = 100 * C.MS_PER_DAY
    rows = [(now,), (now - 7 * C.MS_PER_DAY,), (now - 8 * C.MS_PER_DAY + 1,),
            (now - 8 * C.MS_PER_DAY,), (None,)]
    kept = C.recent(spark.createDataFrame(rows, "ms bigint"), "ms", 7, now).collect()
    assert [r["ms"] for r in kept] == [r[0] for r in rows[:3]]


ITEM = "a int, b string"


def test_explode_json(spark):
    bodies = ['[{"a":1,"z":9},{"b":"x"}]', "[]", " [] ", "null", '{"a":5}']
    df = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "i int, body string")
    got = [tuple(r) for r in S.explode_json(df, "body", ITEM).orderBy("i", "a").collect()]
    assert sorted(got, key=str) == sorted([(0, 1, None), (0, None, "x"), (4, 5, None)], key=str)


def test_unreadable_messages(spark):
    df = spark.createDataFrame([("[{]",), ('[{"a":2}]',)], "body string")
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        S.explode_json(df, "body", ITEM).collect()
    assert S.explode_json(df, "body", ITEM, "quarantine").count() == 1
    assert S.unreadable_json(df, "body", ITEM, array=True).first()["body"] == "[{]"
    typed = spark.createDataFrame(
        [('[{"a":1},{"a":"no"}]',), ('[{"a":3},{"b":null}]',), ("[5]",), ('{"a":4}',), ("[]",),
         ("null",), (None,), ('[{"a":6}',)], "body string")
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        S.explode_json(typed.limit(1), "body", ITEM).collect()
    kept = S.explode_json(typed, "body", ITEM, "quarantine").collect()
    assert sorted((r["a"] is None, r["a"]) for r in kept) == [(False, 3), (False, 4), (True, None)]
    bad = {r["body"] for r in S.unreadable_json(typed, "body", ITEM, array=True).collect()}
    assert bad == {'[{"a":1},{"a":"no"}]', "[5]", '[{"a":6}', None}
    objects = spark.createDataFrame([("{",), ('{"a":2}',), ('{"a":"no"}',)], "body string")
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        S.parse_json(objects, "body", ITEM).collect()
    assert [r["a"] for r in S.parse_json(objects, "body", ITEM, "quarantine").collect()] == [2]
    assert S.unreadable_json(objects, "body", ITEM).count() == 2
    with pytest.raises(ValueError):
        S.parse_json(objects, "body", ITEM, "ignore")


def test_attributes_must_be_columns(spark):
    df = spark.createDataFrame([("0", "c", "a", None)],
                               "occurrenceTime string, channelCode string, accountId string, x string")
    event = {"code": "E", "name": "n", "attributesJSON": [{"attributeId": "x"}]}
    row = S.extract_attributes(df, event).first()
    assert row["attributesJSON"][0]["value"] is None and row["occurrenceTime"] == "1970-01-01 00:00:00"
    event["attributesJSON"].append({"attributeId": "missing"})
    with pytest.raises(ValueError, match="missing"):
        S.extract_attributes(df, event)


def test_metadata_keys(spark):
    df = spark.sql("""select struct(1 as a) as before, struct(2 as a) as after,
                      struct(5L as ts_ms, 'd' as db, 't' as table) as source""")
    row = S.with_metadata(df, ["op_ts", "database_name"]).first()
    assert (row["op_ts"], row["database_name"]) == (5, "d")
    with pytest.raises(ValueError):
        S.with_metadata(df, ["nope"])


def test_changed_columns_sees_nulls(spark):
    df = spark.sql("""select struct(1 as a, cast(null as string) as b, 'x' as c) as before,
                      struct(1 as a, 'y' as b, cast(null as string) as c) as after""")
    assert S.changed_columns(df).first()["changed"] == ["b", "c"]


def test_trace_without_cost_or_value(spark):
    fields = ["uuid", "projectId", "event", "userId", "url", "createTime", "value", "iPv4",
              "queryString"]
    df = spark.createDataFrame([("1", "p", "e", "u", "http://x", "2024-01-01 00:00:00", None, "ip",
                                 None)], ", ".join(f"{f} string" for f in fields))
    row = S.flatten_trace(df).first()
    assert row["requestCostTime"] is None and row["url"] == "http://x" and row["visitByChannel"] == ""


def test_blank_and_missing_messages_are_unreadable(spark):
    texts = ['{"a": 1}', "", "  ", None, "null", '{"a": ', "[]", '[{"a": 2}]']
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, m string")
    one = S.parse_json(df.where("i <> 6 AND i <> 7"), "m", "a int", "quarantine")
    lost = S.unreadable_json(df.where("i <> 6 AND i <> 7"), "m", "a int")
    assert {r["i"] for r in lost.collect()} >= {1, 2, 3, 5}
    assert {r["i"] for r in one.collect()} | {r["i"] for r in lost.collect()} == {0, 1, 2, 3, 4, 5}
    many = S.unreadable_json(df, "m", "a int", array=True)
    assert {r["i"] for r in many.collect()} == {1, 2, 3, 5}
    assert sorted(r["a"] for r in S.explode_json(df, "m", "a int", "quarantine").collect()) == [1, 2]
    for bad in ("", "  ", None):
        torn = spark.createDataFrame([(bad,)], "m string")
        for read in (S.parse_json, S.explode_json):
            with pytest.raises(Exception, match="blank or missing"):
                read(torn, "m", "a int").collect()


def test_damaged_values_and_cookies(spark):
    df = spark.createDataFrame(
        [("p", "u1", '{"appId": "7"}', '{"mulri_skin_id": "s"}'), ("p", "u2", '{"appId": ', '{"mul'),
         ("p", "u3", "", None), (None, "u4", "{", "{}")],
        "projectId string, uuid string, value string, cookie string")
    for name in ("event", "userId", "url", "createTime", "iPv4", "queryString"):
        df = df.withColumn(name, F.lit(None).cast("string"))
    kept = S.flatten_trace(df, on_error="quarantine")
    assert {r["id"]: r["appId"] for r in kept.collect()} == {"u1": "7", "u3": None}
    assert [r["uuid"] for r in S.unreadable_traces(df).collect()] == ["u2"]
    with pytest.raises(Exception, match="damaged JSON"):
        S.flatten_trace(df).collect()
    skins = df.select("uuid", X.cookie_skin(F.col("cookie"), "quarantine").alias("skin"),
                      X.cookie_user(F.col("userId"), F.col("cookie"), "quarantine").alias("who"))
    assert {r["uuid"]: (r["skin"], r["who"]) for r in skins.collect()} == {
        "u1": ("s", ""), "u2": (None, None), "u3": ("未知", None), "u4": ("未知", "")}
    for column in (X.cookie_skin(F.col("cookie")), X.cookie_user(F.col("userId"), F.col("cookie"))):
        with pytest.raises(Exception, match="damaged JSON"):
            df.select(column).collect()
