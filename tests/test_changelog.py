"""Folding operators against a one-by-one replay."""

import random
from itertools import product

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from changeflow.operators import changelog as L

SCHEMA = "op string, k int, at int, v string, p string"


def replay(target, changes, strategy, ignore_delete, fixed):
    state = {k: (v, p) for k, v, p in target}
    for op, k, _, v, p in sorted(changes, key=lambda c: c[2]):
        if op == "+I" or (op == "+U" and strategy == "insert"):
            state[k] = (v, p)
        elif op == "+U" and strategy == "update" and k in state:
            state[k] = (v, state[k][1] if fixed else p)
        elif op == "-D" and not ignore_delete:
            state.pop(k, None)
    return sorted((k, *rest) for k, rest in state.items())


@pytest.mark.parametrize("strategy, ignore_delete, fixed, few", list(product(
    ("update", "insert", "discard"), (True, False), (True, False), (True, False))))
def test_apply_changelog_with_a_hot_key(spark, strategy, ignore_delete, fixed, few):
    draw = random.Random(f"{strategy}{ignore_delete}{fixed}")
    target = [(k, f"t{k}", f"p{k}") for k in range(0, 40, 2)]
    # a third of all changes hit key 7
    changes = [(draw.choice(["+I", "-U", "+U", "-D"]), 7 if i % 3 == 0 else draw.randrange(50), i,
                draw.choice([f"v{i}", None]), f"q{i}") for i in range(600)]
    draw.shuffle(changes)
    result = L.apply_changelog(
        spark.createDataFrame(target, "k int, v string, p string"),
        spark.createDataFrame(changes, SCHEMA).repartition(5), ["k"], ["at"], strategy,
        ignore_delete, ["p"] if fixed else [], few)
    rows = sorted(tuple(r) for r in result.collect())
    assert rows == replay(target, changes, strategy, ignore_delete, fixed)


def test_compact_follows_stream_order(spark):
    """Delete and then insert of one key leaves the inserted row."""
    changes = spark.createDataFrame(
        [("-D", 1, 1, "a", ""), ("+I", 1, 2, "b", ""), ("+I", 2, 1, "c", ""), ("-D", 2, 2, "c", "")],
        SCHEMA)
    assert [r["v"] for r in L.materialize(changes, ["k"], ["at"]).collect()] == ["b"]


def table(spark, rows):
    return spark.createDataFrame(rows, "k int, v string, at int")


def test_write_op_conflicts(spark):
    target = table(spark, [(1, "one", 0), (2, "two", 0)])
    known, unknown = table(spark, [(1, "x", 1)]), table(spark, [(9, "x", 1)])
    for operation, rows in (("INSERT", known), ("UPDATE", unknown), ("DELETE", unknown)):
        with pytest.raises(PySparkException, match=f"{operation} conflict"):
            L.write_op(target, rows, ["k"], operation, ["at"]).collect()

    def values(frame):
        return {r["k"]: r["v"] for r in frame.collect()}

    assert values(L.write_op(target, known, ["k"], "INSERT", ["at"], ignore_duplicate=True)) == \
        {1: "one", 2: "two"}
    assert values(L.write_op(target, unknown, ["k"], "INSERT", ["at"])) == \
        {1: "one", 2: "two", 9: "x"}
    assert values(L.write_op(target, known, ["k"], "UPDATE", ["at"])) == {1: "x", 2: "two"}
    assert values(L.write_op(target, unknown, ["k"], "UPDATE", ["at"], ignore_not_found=True)) == \
        {1: "one", 2: "two"}
    assert values(L.write_op(target, known, ["k"], "DELETE", ["at"])) == {2: "two"}
    with pytest.raises(ValueError):
        L.write_op(target, known, ["k"], "MERGE", ["at"])


def test_update_to_null_is_kept(spark):
    target = table(spark, [(1, "one", 0)])
    rows = table(spark, [(1, None, 5)])
    assert L.write_op(target, rows, ["k"], "UPDATE", ["at"]).first()["v"] is None


def test_upsert_refuses_deletes(spark):
    target = spark.createDataFrame([(1, "a", "p")], "k int, v string, p string")
    changes = spark.createDataFrame([("-D", 1, 1, "b", "q")], SCHEMA)
    with pytest.raises(PySparkException, match="upsert cannot take -D"):
        L.upsert(target, changes, ["k"], ["at"], op="op").collect()
    kept = L.upsert(target, changes, ["k"], ["at"], op="op", deletes="as_upsert")
    assert kept.first()["v"] == "b"


def test_require_key(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c")], "k int, v string")
    for arguments in ({"keys": []}, {"keys": ["x"]}, {"keys": ["k"], "hash_columns": ["v"]},
                      {"keys": ["k"], "check_rows": True}):
        with pytest.raises(ValueError):
            L.require_key(df, **arguments)
    assert L.require_key(df, [], insert_only=True) is df
    assert L.require_key(df, ["v"], hash_columns=["v"], check_rows=True) is df
    bad = {(r["k"], r["n"]) for r in L.key_violations(df, ["k"]).collect()}
    assert bad == {(1, 2), (None, 1)}


def test_flags(spark):
    target = table(spark, [(1, "one", 0), (2, "two", 0)])
    changes = spark.createDataFrame(
        [(1, "x", 1, False), (3, "y", 2, True), (2, "z", 3, True)],
        "k int, v string, at int, is_add boolean")
    got = L.apply_flagged(target, changes, ["k"], ["at"]).orderBy("k").collect()
    assert [(r["k"], r["v"]) for r in got] == [(2, "z"), (3, "y")]


def test_routing(spark):
    changes = spark.createDataFrame([(op, 1, i, "a", "") for i, op in
                                     enumerate(["+I", "-U", "+U", "-D"])], SCHEMA)
    assert L.append_only(changes).count() == 1 and "op" not in L.append_only(changes).columns
    assert [r["op"] for r in L.additions(changes).collect()] == ["+I", "+U"]
    assert L.without_before(changes).where(F.col("op") == "-U").isEmpty()
    assert L.flatten_changelog(changes).count() == 4
    assert L.as_retract_pairs(changes).columns == ["is_add", "payload"]


def test_map_operations(spark):
    rows = spark.createDataFrame([(1, "a", "DELETE"), (2, "b", "INSERT"), (3, "c", "other")],
                                 "k int, v string, what string")
    ops = [r["op"] for r in L.map_operations(rows, ["k", "v"], F.col("what")).orderBy("k").collect()]
    assert ops == ["-D", "+I", None]
    assert L.map_operations(rows, ["k"], "UPDATE").first()["op"] == "+U"
    for arguments in ((["k", "missing"], "UPDATE"), (["k"], "MERGE")):
        with pytest.raises(ValueError):
            L.map_operations(rows, *arguments)


def test_maps_can_be_compacted(spark):
    """Columns without an order of their own."""
    df = spark.createDataFrame([(1, 1, {"a": "x"}), (1, 2, {"a": "y"}), (2, 1, None)],
                               "k int, at int, m map<string,string>")
    got = {r["k"]: r["m"] for r in L.compact(df, ["k"], ["at"]).collect()}
    assert got == {1: {"a": "y"}, 2: None}


def test_few_changes_leave_the_target_in_place(spark, sf_dir):
    """The target meets the changes in broadcast joins: it is not hashed to other tasks."""
    target = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("v"))
    changes = spark.createDataFrame([("+U", 5, 1, "x"), ("+I", 10**9, 2, "y"), ("-D", 7, 3, None)],
                                    "op string, k bigint, at int, v string")
    result = L.apply_changelog(target, changes, ["k"], ["at"], ignore_delete=False, few=True)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    got = {r["k"]: r["v"] for r in result.collect()}
    assert got[5] == "x" and got[10**9] == "y" and 7 not in got
    assert len(got) == target.count()
