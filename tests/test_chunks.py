"""Key chunks and snapshots."""

import glob
import random

import pytest
from pyspark.sql import functions as F

from changeflow.plans.reads import chunks_wide_key, wide_keys
from changeflow.session import fresh_dir, written
from changeflow.sources.chunks import (
    EvenChunks, chunk_rows, distribution_factor, even_ends, plan_by_rank, plan_chunks)
from changeflow.sources.snapshot import label_chunks, read_snapshot, snapshot


def step_by_step(keys, size):
    """Chunk ends found one after the other, each from the end before."""
    keys, ends = sorted(keys), []
    high, end = keys[-1], keys[0]
    while True:
        rest = [k for k in keys if k >= end]
        following = rest[:size][-1]
        if following == end:
            later = [k for k in keys if k > end]
            following = later[0] if later else high
        if following >= high:
            return ends
        ends.append(following)
        end = following


def ends_of(plan):
    return [r["key"] for r in plan.starts().orderBy("chunk").collect()]


def test_even_ends():
    assert list(even_ends(0, 14999, 15000, 4000, 4000)) == [4000, 8000, 12000]
    assert list(even_ends(0, 10, 5, 5, 5)) == []
    assert len(even_ends(0, 4990, 500, 100, 998)) == 5
    assert distribution_factor(0, 14999, 15000) == 1.0
    assert distribution_factor(1, 10, 3) == 3.3334


@pytest.mark.parametrize("size", [2, 3, 7, 50, 500])
def test_unique_keys_match_step_by_step(spark, size):
    keys = random.Random(size).sample(range(10**6), 200)
    df = spark.createDataFrame([(k,) for k in keys], "k bigint")
    plan = plan_by_rank(spark, df, "k", size)
    assert ends_of(plan) == step_by_step(keys, size) and len(plan) == len(ends_of(plan)) + 1


def test_hot_key_gets_its_own_chunk(spark):
    keys = [50] * 300 + list(range(0, 600, 1)) + [None] * 3
    df = spark.createDataFrame([(k,) for k in keys], "k bigint")
    plan = plan_by_rank(spark, df, "k", 100)
    ends = ends_of(plan)
    assert 50 in ends and 51 in ends
    numbered = label_chunks(df, plan)
    counts = {r["chunk_id"]: r["count"] for r in numbered.groupBy("chunk_id").count().collect()}
    assert sum(counts.values()) == len(keys) and len(counts) == len(plan)
    for chunk, n in counts.items():
        assert n <= 102 or chunk == ends.index(50) + 1
        assert df.where(chunk_rows(plan, chunk)).count() == n


@pytest.mark.parametrize("rows, size, expected", [([], 5, 1), ([7, 7, 7], 1, 1), (range(5), 10, 1),
                                                  (range(100), 10, 10)])
def test_plan_shapes(spark, rows, size, expected):
    df = spark.createDataFrame([(r,) for r in rows], "k bigint")
    assert len(plan_chunks(spark, df, "k", size)) == expected


def test_sparse_key_goes_by_rank(spark):
    df = spark.createDataFrame([(i * 10**7,) for i in range(100)], "k bigint")
    plan = plan_chunks(spark, df, "k", 10)
    assert ends_of(plan) == step_by_step([i * 10**7 for i in range(100)], 10)


def test_sparse_even_keys_are_cut_by_rows(spark):
    df = spark.range(500).select((F.col("id") * 10).alias("k"))
    assert len(plan_chunks(spark, df, "k", 100)) == 6  # about rows / size
    df = spark.range(20_000).select((F.col("id") * 900).alias("k"))
    assert len(plan_chunks(spark, df, "k", 8096)) == 3


def test_even_numbers_agree_with_filters(spark):
    keys = spark.range(-20, 120).select(F.col("id").alias("k"))
    df = keys.unionAll(spark.createDataFrame([(None,)], "k bigint"))
    for plan in (EvenChunks("k", range(10, 95, 10)), EvenChunks("k", range(5, 6)), EvenChunks("k")):
        numbered = df.withColumn("c", plan.number()).cache()
        for chunk in {0, 1, len(plan) // 2, len(plan) - 1}:
            inside = {r["k"] for r in df.where(chunk_rows(plan, chunk)).collect()} \
                if chunk < len(plan) else set()
            assert inside == {r["k"] for r in numbered.where(F.col("c") == chunk).collect()}


NAN = float("nan")


@pytest.mark.parametrize("chunks", [1, 256, 257, 10_000])
@pytest.mark.parametrize("kind", ["bigint", "double", "string"])
def test_labels_of_any_number_of_chunks(spark, chunks, kind):
    """Labels agree with the plan's filters, also for nulls, keys above 2^53 and NaN."""
    make = {"bigint": lambda i: (1 << 60) + i, "double": lambda i: i / 3,
            "string": lambda i: f"k{i:06d}"}[kind]
    keys = [make(i) for i in range(chunks)]
    extra = [None, None] + [NAN] * (kind == "double")
    df = spark.createDataFrame([(k, i) for i, k in enumerate([*keys, *extra])], f"k {kind}, i int")
    plan = plan_by_rank(spark, df, "k", 2)  # each key starts a chunk, but the first and the last
    last = chunks if kind == "double" else chunks - 1
    assert len(plan) == max(last, 1)
    labels = {r["i"]: r["chunk_id"] for r in label_chunks(df, plan).collect()}
    want = {i: min(i, len(plan) - 1) for i in range(chunks)}
    want |= {chunks: 0, chunks + 1: 0, **({chunks + 2: len(plan) - 1} if kind == "double" else {})}
    assert labels == want
    for chunk in {0, 1, len(plan) // 2, len(plan) - 1}:
        if chunk < len(plan):
            inside = {r["i"] for r in df.where(chunk_rows(plan, chunk)).collect()}
            assert inside == {i for i, c in want.items() if c == chunk}


def test_later_keys_get_the_chunk_before_them(spark):
    df = spark.range(0, 1000, 10).select(F.col("id").alias("k"))
    plan = plan_by_rank(spark, df, "k", 5)
    ends = ends_of(plan)
    grown = spark.range(-50, 1100).select(F.col("id").alias("k")).unionAll(
        spark.createDataFrame([(None,)], "k bigint"))
    labels = {r["k"]: r["chunk_id"] for r in plan.label(grown, later=True).collect()}
    assert labels == {None: 0, **{k: sum(k >= e for e in ends) for k in range(-50, 1100)}}


def test_odd_text_and_other_key_types(spark):
    texts = ["", "a'b", "a\\c", "b`\"", "zz", "é"]
    df = spark.createDataFrame([(t,) for t in texts], "`odd ``key` string")
    plan = plan_by_rank(spark, df, "odd `key", 3)
    assert ends_of(plan) == ["a\\c", "zz"]
    assert dict(map(tuple, label_chunks(df, plan).collect())) == {
        "": 0, "a'b": 0, "a\\c": 1, "b`\"": 1, "zz": 2, "é": 2}
    days = spark.sql("select explode(sequence(date'2024-01-01', date'2024-01-10')) as d")
    plan = plan_by_rank(spark, days, "d", 4)
    assert [e.day for e in ends_of(plan)] == [4, 7]
    assert [r["chunk_id"] for r in label_chunks(days, plan).orderBy("d").collect()] == \
        [0, 0, 0, 1, 1, 1, 2, 2, 2, 2]


@pytest.mark.parametrize("key", ["o_orderkey", "o_clerk_key"])
def test_snapshot_restart(spark, sf_dir, key):
    """Recorded waves are kept, the others written by the first run's cuts."""
    out = fresh_dir(spark, "snapshot-test")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        "o_orderkey", "o_totalprice", F.format_string("k%08d", "o_orderkey").alias("o_clerk_key"))
    plan = snapshot(spark, {"orders": (orders, key)}, out, size=200, waves=4)["orders"]
    first = {r["o_orderkey"]: r["chunk_id"] for r in read_snapshot(spark, out, "orders").collect()}
    assert len(first) == orders.count()
    # one wave is taken as lost, the table has grown, and a second one joins the list
    done = spark.read.json(f"{out}/_finished")
    lost = done.orderBy(F.desc("first")).first()["first"]
    kept = written(done.where(F.col("first") != lost), "kept")
    kept.select("table_name", "first", "last").write.mode("overwrite").json(f"{out}/_finished")
    grown = orders.unionAll(orders.withColumns({
        "o_orderkey": F.col("o_orderkey") + 10**6, "o_clerk_key": F.concat("o_clerk_key", F.lit("x"))}))
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    again = snapshot(spark, {"orders": (grown, key), "nation": (nation, "n_name")}, out,
                     size=200, waves=4)
    assert len(again["orders"]) == len(plan)
    rows = read_snapshot(spark, out, "orders").collect()
    now = {r["o_orderkey"]: r["chunk_id"] for r in rows}
    assert len(rows) == len(now)
    assert {k: c for k, c in now.items() if k in first} == first
    assert all(c >= lost for k, c in now.items() if k not in first) and len(now) > len(first)
    assert read_snapshot(spark, out, "nation").count() == 25
    # everything is recorded: a third run writes nothing
    snapshot(spark, {"orders": (orders, key)}, out, size=200, waves=4)
    assert len(read_snapshot(spark, out, "orders").collect()) == len(rows)


def test_snapshot_reads_a_table_once(spark):
    out, reads = fresh_dir(spark, "snapshot-once"), spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    df = spark.range(1000).mapInArrow(seen, "id bigint")
    snapshot(spark, {"t": (df, "id")}, out, size=50, waves=8)
    assert reads.value == 2000  # once for the plan's aggregate, once for all waves
    assert spark.read.parquet(f"{out}/t").select("wave").distinct().count() == 7


def test_a_crash_after_a_wave_goes_on_with_the_next(spark):
    """After wave 3 of 8 is recorded the job dies: a restart writes the other five only."""
    out, waves = fresh_dir(spark, "snapshot-crash"), []
    df = spark.range(1600).select("id", (F.col("id") * 2).alias("v"))

    def crash(name, first):
        waves.append(first)
        if len(waves) == 3:
            raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        snapshot(spark, {"t": (df, "id")}, out, size=100, waves=8, on_wave=crash)
    before = {f for f in glob.glob(f"{out}/t/wave=*/*.parquet")}
    assert len({f.split("wave=")[1].split("/")[0] for f in before}) == 3
    changed = df.withColumn("v", F.col("v") + 1)  # what is read was staged by the first run
    plan = snapshot(spark, {"t": (changed, "id")}, out, size=100, waves=8, on_wave=crash)["t"]
    assert len(plan) == 16 and waves == list(range(0, 16, 2))
    rows = {r["id"]: r["v"] for r in read_snapshot(spark, out, "t").collect()}
    assert rows == {i: 2 * i for i in range(1600)}
    assert before < {f for f in glob.glob(f"{out}/t/wave=*/*.parquet")}
    assert glob.glob(f"{out}/_staged/*") == []


@pytest.mark.parametrize("keys, kind", [
    ([-(1 << 23), 7, (1 << 23) - 1], "bigint"), ([1, 50 << 30, None], "bigint"), ([], "bigint"),
    ([-(1 << 23) - 1, 7], "decimal(38,0)"), ([50, 1 << 23, (1 << 63) - 1], "decimal(38,0)")])
def test_wide_keys_beyond_a_bigint(spark, keys, kind):
    rows = wide_keys(spark.createDataFrame([(k,) for k in keys], "o_orderkey bigint"))
    want = [None if k is None or k % 50 == 0 else k * (1 << 40) + 1 for k in keys]
    assert rows.dtypes == [("key", kind)]
    assert [None if r["key"] is None else int(r["key"]) for r in rows.collect()] == want


def test_wide_keys_of_a_large_table_are_chunked(spark):
    folder = fresh_dir(spark, "wide-orders")
    keys = range((1 << 23) - 40, (1 << 23) + 60)
    spark.createDataFrame([(k,) for k in keys], "o_orderkey bigint").write.parquet(
        f"{folder}/orders.parquet")
    rows = sorted(chunks_wide_key(spark, folder).collect())
    wide = [k * (1 << 40) + 1 for k in keys if k % 50]
    ends = [*step_by_step(wide, 4), wide[-1] + 1]
    parts = [[k for k in wide if low <= k < high] for low, high in zip([0, *ends], ends)]
    nulls = len(keys) - len(wide)
    assert [(r["n"], int(r["first_key"]), int(r["last_key"])) for r in rows] == [
        (len(p) + (nulls if i == 0 else 0), p[0], p[-1]) for i, p in enumerate(parts)]
