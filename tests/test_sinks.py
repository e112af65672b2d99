"""Sinks, placement, type conformance and retry."""

import decimal
import os
import threading
import uuid

import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow.operators import conform as K
from changeflow.operators import placement as P
from changeflow.operators.metrics import counted
from changeflow.session import fresh_dir
from changeflow.sinks import batched as B
from changeflow.sinks import files as W
from changeflow.sinks.copytext import copy_lines, read_copy_text, write_copy_text
from changeflow.sinks.quarantine import (
    bad_rows, good_rows, raise_on_failure, write_with_quarantine)
from changeflow.sources.scan import scan_shards

# ---- placement --------------------------------------------------------------


def test_value_placement(spark):
    df = spark.createDataFrame(
        [(-100, decimal.Decimal("100.2313"), decimal.Decimal("-100"), -100.9)],
        "i bigint, d decimal(18,4), n decimal(18,4), f double")
    row = df.select(*[P.by_value(df, c, 7).alias(c) for c in df.columns]).first()
    assert tuple(row) == (2, 2, 5, 2)
    empty = spark.createDataFrame([(None,)], "i bigint")
    with pytest.raises(PySparkException, match="no shard"):
        empty.select(P.by_value(empty, "i", 7)).collect()
    text = spark.createDataFrame([("a",)], "s string")
    with pytest.raises(ValueError):
        P.by_value(text, "s", 7)


def test_strategies_need_a_key(spark):
    df = spark.range(3)
    for strategy, key in (("hash", None), ("value", None), ("hash", "x"), ("best", "id")):
        with pytest.raises(ValueError):
            P.shard_column(df, strategy, 3, key)


def test_long_hash(spark):
    def expected(value, n):
        low = (value ^ ((value & (2**64 - 1)) >> 32)) & 0xFFFFFFFF
        signed = low - 2**32 if low >= 2**31 else low
        return abs(int(pd.Series([signed]).mod(n).iloc[0]) if signed >= 0 else -((-signed) % n))

    values = [0, 1, -1, 2**31, -2**31, 2**40 + 7, -2**50, 2**63 - 1, -2**63, 123456789012345]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "k bigint")
    got = {r["k"]: r["s"] for r in df.select("k", P.hashed_long("k", 7).alias("s")).collect()}
    assert got == {**{v: expected(v, 7) for v in values}, None: 0}


def test_balanced_starts_at_one(spark):
    shards = [r[0] for r in spark.range(0, 10, 1, 1).select(P.balanced(4)).collect()]
    assert shards == [1, 2, 3, 0, 1, 2, 3, 0, 1, 2]


# ---- files ------------------------------------------------------------------


def test_empty_shards_have_no_folder(spark):
    paths = W.write_sharded(spark.range(20).where("id % 5 = 3"), fresh_dir(spark, "few"), "value",
                            5, "id")
    assert [p[-1] for p in paths] == ["3"]
    assert sorted(r["id"] for r in scan_shards(spark, paths).collect()) == [3, 8, 13, 18]
    with pytest.raises(ValueError):
        scan_shards(spark, [])


def test_partition_spec():
    assert W.partition_names("a, ${b=2},c") == ["a", "b", "c"]


def test_hot_partition_is_split_not_dropped(spark):
    """A third of the rows share one partition value; all arrive."""
    path = fresh_dir(spark, "hot")
    rows = spark.range(30_000).select("id", F.when(F.col("id") % 3 == 0, 0)
                                      .otherwise(F.col("id") % 20).alias("p"))
    W.write_partitioned(rows, path, ["p"])
    back = spark.read.parquet(path)
    assert back.count() == 30_000 and back.select("id").distinct().count() == 30_000


def test_hot_partition_goes_to_several_tasks(spark):
    """With pieces of 64 kB, the hot value's folder gets several files, others one."""
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    path, before = fresh_dir(spark, "hot-files"), spark.conf.get(size)
    spark.conf.set(size, "64k")
    try:
        rows = spark.range(0, 300_000, 1, 8).select(
            "id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 20).alias("p"))
        W.write_partitioned(rows, path, ["p"])
    finally:
        spark.conf.set(size, before)
    files = spark.read.parquet(path).select("p", F.input_file_name().alias("file")) \
        .groupBy("p").agg(F.count_distinct("file").alias("files")).collect()
    hot = next(r["files"] for r in files if r["p"] == 0)
    assert hot >= 3 and spark.read.parquet(path).count() == 300_000


def test_bucketing_refuses_null_keys(spark):
    df = spark.createDataFrame([(1,), (None,)], "k int")
    with pytest.raises(PySparkException, match="null in a key column"):
        W.save_bucketed(df, "null_keys", ["k"], 2, fresh_dir(spark, "null-keys"))
    with pytest.raises(ValueError):
        W.save_bucketed(df, "no_keys", [], 2)


def test_bucketed_join_moves_no_rows(spark, sf_dir):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for table, key in (("orders", "o_custkey"), ("customer", "c_custkey")):
            df = spark.read.parquet(f"{sf_dir}/{table}.parquet").select(key)
            W.save_bucketed(df, f"b_{table}", [key], 4, fresh_dir(spark, table))
        joined = spark.table("b_orders").join(
            spark.table("b_customer"), F.col("c_custkey") == F.col("o_custkey"))
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for table in ("orders", "customer"):
            spark.sql(f"DROP TABLE IF EXISTS b_{table}")


def test_index_name(spark):
    df = spark.createDataFrame([("p", "2024-03-05 10:00:00"), (None, "2024-03-05"), ("p", None)],
                               "p string, d string")
    names = [r[0] for r in df.select(W.index_name(F.col("p"), F.col("d"))).collect()]
    assert names == ["p-2024-03", None, None]


# ---- bulk text --------------------------------------------------------------

COPY_SCHEMA = "i int, s string, d decimal(20,2), f double, b boolean"
COPY_ROWS = [
    (1, 'say "hi"\\now', decimal.Decimal("123456789012345678.91"), 1.5, True),
    (2, "", None, None, None), (3, None, decimal.Decimal("0.10"), -2.0, False),
    (4, "a|b", None, 0.1, True), (5, "line\nend\ttab", None, 1e10, None),
    (6, '\\"', None, None, None), (7, " pad ", None, None, None), (8, '""', None, None, None),
    (9, "a\r\nb\rc", None, None, None)]


def test_copy_text_round_trip(spark):
    path = fresh_dir(spark, "copy")
    df = spark.createDataFrame(COPY_ROWS, COPY_SCHEMA)
    write_copy_text(df, path, max_rows=3)
    back = [tuple(r) for r in read_copy_text(spark, path, COPY_SCHEMA).orderBy("i").collect()]
    assert back == COPY_ROWS


def test_copy_text_lines(spark):
    df = spark.createDataFrame(COPY_ROWS[:3], COPY_SCHEMA)
    lines = [r["value"] for r in copy_lines(df).collect()]
    assert lines == ['1|"say \\"hi\\"\\\\now"|123456789012345678.91|1.5|true', '2|""|||',
                     "3||0.10|-2.0|false"]
    odd = spark.createDataFrame([("a\x00b", bytearray(b"A\\\x01\xff~\x7f")), ("", bytearray(b""))],
                                "s string, x binary")
    assert [r["value"] for r in copy_lines(odd).collect()] == [
        '"ab"|A\\\\\\001\\377~\\177', '""|']


# ---- retry and batches ------------------------------------------------------


def test_pauses():
    assert B.pauses(3) == [0.0, 1.0, 2.0]
    assert B.pauses(10, 1.0, True)[-2:] == [256.0, 256.0]


def test_retry():
    def failing(times, error=IOError):
        left = [times]

        def call():
            if left[0]:
                left[0] -= 1
                raise error("down")
        return call

    waits = []
    assert B.with_retry(failing(2), sleep=waits.append) == 3 and waits == [0.0, 1.0]
    with pytest.raises(IOError):
        B.with_retry(failing(4), sleep=waits.append)
    with pytest.raises(KeyError):
        B.with_retry(failing(1, KeyError), only=(IOError,), sleep=waits.append)


def test_regroup():
    frames = [pd.DataFrame({"a": range(n)}) for n in (3, 0, 8, 1, 4)]
    sizes = [len(f) for f in B.regroup(iter(frames), 5)]
    assert sizes == [5, 5, 5, 1]
    joined = pd.concat(B.regroup(iter(frames), 5))["a"].tolist()
    assert joined == pd.concat(frames)["a"].tolist()


def test_batches_with_failures_arrive_once(spark):
    path = fresh_dir(spark, "batches").removeprefix("file:")
    os.makedirs(path)

    def send(rows, task, batch):
        target = f"{path}/{task}-{batch}"
        if batch % 2 and not os.path.exists(f"{target}.tried"):
            open(f"{target}.tried", "w").close()
            raise OSError("store is down")
        rows.to_csv(target, index=False)

    report = B.write_batched(spark.range(0, 5500, 1, 3), send, 1000, base=0.0).collect()
    written = pd.concat(pd.read_csv(f"{path}/{f}") for f in os.listdir(path)
                        if not f.endswith(".tried"))
    assert sorted(written["id"]) == list(range(5500))
    assert sum(r["rows"] for r in report) == 5500
    assert all(r["batches"] == 2 and r["attempts"] == 3 for r in report)


# ---- quarantine and types ---------------------------------------------------


def test_quarantine_policies(spark):
    df = spark.createDataFrame([(1, "5"), (2, "x"), (3, None)], "i int, v string")
    path = fresh_dir(spark, "quarantine")
    seen = []
    write_with_quarantine(df, path, {"v": "Int32"}, on_failure=lambda bad: seen.append(bad.count()))
    assert seen == [1]
    assert [(r["i"], r["v"]) for r in good_rows(spark, path, {"v": "Int32"}).orderBy("i").collect()] \
        == [(1, 5), (3, None)]
    assert bad_rows(spark, path).first()["_reason"] == "type:v"
    with pytest.raises(ValueError, match="1 bad rows"):
        write_with_quarantine(df, fresh_dir(spark, "q2"), {"v": "Int32"},
                              on_failure=raise_on_failure)


@pytest.mark.parametrize("name, expected", [
    ("Int8", T.ByteType()), ("UInt8", T.ShortType()), ("UInt16", T.IntegerType()),
    ("IntervalDay", T.IntegerType()), ("UInt32", T.LongType()), ("UInt256", T.DecimalType(38, 0)),
    ("Decimal(10, 2)", T.DecimalType(10, 2)), ("Decimal32(3)", T.DecimalType(9, 3)),
    ("Decimal256(20)", T.DecimalType(38, 20)), ("Decimal(76, 40)", T.DecimalType(38, 38)),
    ("FixedString(16)", T.StringType()), ("DateTime64(3)", T.TimestampNTZType()),
    ("Nullable(Float32)", T.FloatType()), ("Array(Array(Int64))", T.ArrayType(T.ArrayType(T.LongType()))),
    ("Map(String, Array(Decimal(5, 1)))",
     T.MapType(T.StringType(), T.ArrayType(T.DecimalType(5, 1)))),
])
def test_foreign_types(name, expected):
    assert K.foreign_type(name) == expected


@pytest.mark.parametrize("name", ["Tuple(Int8)", "Nested(a Int8)", "AggregateFunction(sum)", "", "?"])
def test_unsupported_types(name):
    with pytest.raises(ValueError):
        K.foreign_type(name)


def test_conform_nested_and_wide(spark):
    df = spark.createDataFrame([(["1", "x"], {"a": "2"}, "9" * 40, 2, "z")],
                               "a array<string>, m map<string,string>, w string, b int, t string")
    types = {"m": "Map(String, Int32)", "w": "UInt256", "b": "BOOL"}
    row = K.conform(df, types).first()
    assert row["m"] == {"a": 2} and row["w"] is None and row["b"] is False
    assert df.select(K.misfits(df, types)).first()[0] is True
    schema = K.foreign_schema({"k": "Int64", "v": "String"}, ["k"])
    assert not schema["k"].nullable and schema["v"].nullable


def test_all_store_types_round_trip(spark):
    """Ten column types through a file and back; times keep milliseconds."""
    df = spark.sql("""select 'f' as first, false as second, cast('bbbb' as binary) as third,
        cast(12 as tinyint) as fourth, cast(34 as smallint) as fifth, 56 as sixth, 78L as seventh,
        cast(3.14 as float) as eighth, cast(1.2345 as double) as ninth,
        timestamp_ntz'2020-04-15 12:34:56.123456' as tenth""")
    types = {"first": "String", "second": "BOOL", "third": "BINARY", "fourth": "Int8",
             "fifth": "Int16", "sixth": "Int32", "seventh": "Int64", "eighth": "Float32",
             "ninth": "Float64", "tenth": "UNIXTIME_MICROS"}
    path = fresh_dir(spark, "types")
    K.conform(df, types).withColumn("tenth", K.truncate_to_ms(F.col("tenth"))).write.parquet(path)
    row = spark.read.parquet(path).first()
    assert row["tenth"].microsecond == 123000 and bytes(row["third"]) == b"bbbb"
    assert (row["fourth"], row["fifth"], row["sixth"], row["seventh"], row["ninth"]) == \
        (12, 34, 56, 78, 1.2345)


def test_counted(spark):
    rows, seen = counted(spark.range(10), "passed", {"high": F.max("id")})
    rows.write.format("noop").mode("overwrite").save()
    assert seen.get == {"n": 10, "high": 9}


def test_hot_hour_goes_to_several_tasks(spark):
    rows = spark.range(200_000).select((F.col("id") % 1000).alias("ts_ms"), F.col("id"),
                                       F.uuid().alias("text"))
    path = fresh_dir(spark, "hot-hour")
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        W.write_time_partitioned(rows.repartition(8), path, "ts_ms")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    files = spark.read.parquet(path).select(F.input_file_name()).distinct().count()
    assert files > 1 and spark.read.parquet(path).count() == 200_000


def test_slow_rows_are_flushed(spark):
    ticks = iter([0.0, 0.0, 5.0, 5.0, 6.0, 20.0, 20.0])
    frames = [pd.DataFrame({"a": [i]}) for i in range(4)]
    sizes = [len(f) for f in B.regroup(iter(frames), 10, 5.0, lambda: next(ticks))]
    assert sum(sizes) == 4 and len(sizes) > 1
    assert [len(f) for f in B.regroup(iter(frames), 3)] == [3, 1]


LOSSY = [
    ("bigint", "9007199254740993L", "Float32", True), ("bigint", "9007199254740993L", "Float64", True),
    ("bigint", "9007199254740992L", "Float64", False), ("int", "16777217", "Float32", True),
    ("decimal(38,21)", "0.000000000000000000001BD", "Decimal(38, 20)", True),
    ("decimal(38,21)", "0.000000000000000000010BD", "Decimal(38, 20)", False),
    ("double", "1.5D", "Int32", True), ("double", "2.0D", "Int32", False),
    ("double", "double('NaN')", "Int32", True), ("double", "1e300D", "Float32", True),
    ("double", "0.1D", "Float32", False), ("double", "1.005D", "Decimal(9, 2)", True),
    ("array<double>", "array(1.9D, 2.0D)", "Array(Int32)", True),
    ("array<double>", "array(1.0D, null)", "Array(Int32)", False),
    ("array<array<double>>", "array(array(1.0D), array(1.9D))", "Array(Array(Int8))", True),
    ("array<double>", "null", "Array(Int32)", False),
    ("map<string,double>", "map('k', 1.9D)", "Map(String, Int32)", True),
    ("map<string,double>", "map('k', 1.0D, 'l', null)", "Map(String, Int32)", False),
    ("map<string,int>", "map('x', 1)", "Map(Int32, Int32)", True),
    ("timestamp_ntz", "timestamp_ntz'2024-01-02 03:00:00'", "Date", True),
    ("timestamp_ntz", "timestamp_ntz'2024-01-02 00:00:00'", "Date", False),
    ("string", "'2024-01-02 03:00:00'", "Date", True), ("string", "'2024-01-02'", "Date", False),
    ("string", "'0.1234567890123456789012'", "Decimal(38, 21)", True),
    ("string", "'0.1234567890123456789010'", "Decimal(38, 21)", False),
    ("string", "' 12.50 '", "Decimal(9, 1)", False), ("string", "'12.55'", "Decimal(9, 1)", True),
    ("string", "'1.25e1'", "Decimal(9, 1)", False), ("string", "'1.255e1'", "Decimal(9, 1)", True),
    ("string", "'9007199254740993'", "Float64", True), ("string", "'0.1'", "Float64", False),
    ("string", "'x'", "Int32", True), ("int", "7", "BOOL", False), ("int", "300", "Int8", True),
    ("bigint", "null", "Float32", False), ("int", "7", "String", False),
]


def test_what_a_cast_loses(spark):
    cells = ", ".join(f"cast({value} as {have}) as c{i}" for i, (have, value, _, _) in enumerate(LOSSY))
    df = spark.sql(f"select {cells}")
    flags = df.select(*[K.misfits(df, {f"c{i}": want}).alias(f"c{i}")
                        for i, (_, _, want, _) in enumerate(LOSSY)]).first()
    wrong = [(case, flags[i]) for i, case in enumerate(LOSSY) if flags[i] is not case[3]]
    assert wrong == []


def test_an_overwriting_insert_leaves_the_session_alone(spark):
    """It replaces touched partitions also where the session says otherwise, and while another
    write in the session replaces whole tables."""
    setting = "spark.sql.sources.partitionOverwriteMode"
    before, names = spark.conf.get(setting), [f"overwritten_{uuid.uuid4().hex}" for _ in range(2)]
    rows = spark.range(30).selectExpr("id", "cast(id % 3 as int) as p")
    for name in names:
        rows.write.partitionBy("p").option("path", fresh_dir(spark, name)).saveAsTable(name)
    spark.conf.set(setting, "static")
    try:
        seen = []

        def other():
            for _ in range(3):
                spark.range(3).selectExpr("id", "7 as p").write.insertInto(names[1], overwrite=True)
                seen.append(sorted(r["p"] for r in spark.table(names[1]).select("p").distinct().collect()))

        thread = threading.Thread(target=other)
        thread.start()
        for n in range(3):
            W.insert(spark.range(100, 102 + n).selectExpr("id as x", "1 as y"), names[0], overwrite=True)
        W.insert(spark.range(1).selectExpr("id", "9"), names[0], overwrite=True)
        thread.join()
        assert seen == [[7]] * 3 and spark.conf.get(setting) == "static"
        assert {r["p"]: r["n"] for r in spark.table(names[0]).groupBy("p").agg(
            F.count("*").alias("n")).collect()} == {0: 10, 1: 4, 2: 10, 9: 1}
        with pytest.raises(ValueError):
            W.insert(spark.range(1), names[0], overwrite=True)
    finally:
        spark.conf.set(setting, before)
        for name in names:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
