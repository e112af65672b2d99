import math
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from changeflow.llm import mixing
from changeflow.llm.mixing import POWER, mix, mixed, schedule
from changeflow.llm.queries import RUNS


def shares_of(weights):
    weights = [Fraction(w) for w in weights]
    return [w / sum(weights) for w in weights]


@pytest.mark.parametrize("weights", [[1], [1, 1], [3, 2, 1], [97, 1, 1, 1], [5, 7, 11, 13, 1, 1, 60],
                                     [1] * 30, [0.001, 5, 2.5], [1e-7, 1, 2 ** 0.5, 3 ** 0.5]])
def test_no_prefix_is_a_block_away(weights):
    exact, ran = shares_of(weights), [0] * len(weights)
    for t, (i, turn, release, deadline) in enumerate(schedule(exact, [300] + [1] * len(weights[1:])), 1):
        assert turn == ran[i] and release <= t - 1 < deadline
        ran[i] += 1
        assert all(abs(done - share * t) < 1 for done, share in zip(ran, exact))
        if t > 2000:
            break


@settings(deadline=None, max_examples=60)
@given(st.lists(st.floats(1e-6, 1e3), min_size=2, max_size=12))
def test_random_mixes_stay_below_one_block(weights):
    exact, ran = shares_of(weights), [0] * len(weights)
    for t, (i, *_) in enumerate(schedule(exact, [10 ** 9] * len(weights)), 1):
        ran[i] += 1
        assert all(abs(done - share * t) < 1 for done, share in zip(ran, exact))
        if t == 400:
            break


def simulate(sizes, weights, block_rows):
    """Slot by slot over all blocks: (source, block, epoch, release, deadline) of each slot."""
    names = sorted(sizes, key=lambda n: (n is None, n or ""))
    shares = dict(zip(names, shares_of([weights[n] for n in names])))
    blocks = {n: -(-sizes[n] // block_rows) for n in names}
    ran, out = Counter(), []
    while any(ran[n] < blocks[n] for n in names):
        ready = [(math.ceil((ran[n] + 1) / shares[n]), i, n) for i, n in enumerate(names)
                 if math.floor(ran[n] / shares[n]) <= len(out)]
        end, _, n = min(ready)
        out.append((n, ran[n] % blocks[n], ran[n] // blocks[n], math.floor(ran[n] / shares[n]), end))
        ran[n] += 1
    return out, blocks


def check(rows, sizes, weights, block_rows):
    want, blocks = simulate(sizes, weights, block_rows)
    by_slot = defaultdict(list)
    for r in rows:
        by_slot[r["slot"]].append(r)
    assert sorted(by_slot) == list(range(len(want)))
    for slot, (source, block, epoch, release, end) in enumerate(want):
        own = {(r["source"], r["block"], r["epoch"], r["release"], r["deadline"])
               for r in by_slot[slot]}
        assert own == {(source, block, epoch, release, end)}
        assert abs(len(by_slot[slot]) - sizes[source] / blocks[source]) < 1
    return by_slot


def test_against_a_simulation(spark):
    sizes = {"a": 900, "b": 333, "c": 10, None: 57, "": 1}
    data = [(f"{s}{i}", s) for s, n in sizes.items() for i in range(n)]
    docs = spark.createDataFrame(data, "doc_id string, source string").selectExpr(
        "*", "1 AS slot0", "2 AS block", "3 AS row", "4 AS runs", "5 AS place")
    weights = {"a": 1, "b": 4, "c": 2, None: 1, "": 0.25}
    got = mix(spark, docs, weights, block_rows=20).select(
        "row.doc_id", "row.source", "epoch", "block", "release", "deadline", "slot").collect()
    check(got, sizes, weights, 20)
    first = Counter((r["doc_id"], r["source"]) for r in got if r["epoch"] == 0)
    assert first == Counter(data)
    assert max(Counter((r["doc_id"], r["source"], r["epoch"]) for r in got).values()) == 1


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = RUNS["op6_mixing"](spark, sf_dir).collect()
    sizes = Counter(r["source"] for r in docs.collect())
    check(got, sizes, {s: n ** POWER for s, n in sizes.items()}, 100)
    assert {r["doc_id"] for r in got} == {r["doc_id"] for r in docs.collect()}


def test_mixed_keeps_columns_and_order(spark):
    docs = spark.range(1000).selectExpr("id AS doc_id", "IF(id % 10 < 7, 'x', 'y') AS source",
                                        "id AS order", "id AS slot")
    got = mixed(spark, docs, {"x": 1, "y": 1}, block_rows=10)
    assert got.columns == docs.columns
    rows = got.collect()
    seen = Counter()
    for i, r in enumerate(rows):
        seen[r["source"]] += 1
        assert abs(seen["x"] - (i + 1) / 2) <= 10
    assert {r["doc_id"] for r in rows} == set(range(1000))
    assert Counter(r["source"] for r in rows) == {"x": 700, "y": 690}  # ends with a block of x


def test_unnamed_sources_repeats_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a"), (1, "a"), (None, None), (2, "b")],
                                 "doc_id int, source string")
    got = mixed(spark, docs, {"a": 1, "zzz": 9}, block_rows=1)
    assert {tuple(r) for r in got.collect()} == {(1, "a"), (None, None), (2, "b")}
    assert got.where("source = 'a'").count() >= 2
    assert mixed(spark, docs.limit(0)).collect() == []
    with pytest.raises(ValueError):
        mix(spark, docs, {"a": 0})


@pytest.mark.parametrize("counts, weights, block_rows", [
    ({"a": 3_000_000, "b": 900_000, "c": 70_001, "d": 10}, None, 100),
    ({"a": 40_000, "b": 5_000, "c": 7}, {"a": 1, "b": 0.3, "c": 1e-6}, 10),
])
def test_long_mix_follows_the_unrounded_weights(counts, weights, block_rows, spark, monkeypatch):
    """Over many pieces, with a source that is due far less than one slot in 10,000."""
    monkeypatch.setattr(mixing, "PIECE", 1 << 10)
    rows = spark.createDataFrame([(n, c, -(-c // block_rows)) for n, c in counts.items()],
                                 "source string, rows bigint, blocks bigint")
    slots = mixing._slots(rows, weights).orderBy("slot").toPandas()
    assert slots["slot"].tolist() == list(range(len(slots))) and len(slots) > 3 << 10
    names = sorted(counts)
    exact = dict(zip(names, shares_of([(weights or {}).get(n, counts[n] ** POWER) for n in names])))
    assert min(exact.values()) < Fraction(1, 10_000) and min(exact.values()) * 3000 < 1
    for name in names:
        own = slots[slots["source"] == name]
        assert len(own) >= -(-counts[name] // block_rows)
        for k, slot in enumerate(own["slot"].tolist()):  # just before and just after its k-th block
            assert abs(k - exact[name] * slot) < 1 and abs(k + 1 - exact[name] * (slot + 1)) < 1
        last = len(slots)
        assert abs(len(own) - exact[name] * last) < 1


def test_a_tiny_source_is_not_raised(spark):
    docs = spark.range(30_000).selectExpr("id AS doc_id", "IF(id = 7, 'y', 'x') AS source")
    got = mix(spark, docs, {"x": 1, "y": 0.00003}, block_rows=1).select(
        "row.doc_id", "row.source", "slot").collect()
    assert sorted(r["slot"] for r in got) == list(range(len(got)))
    assert sum(r["source"] == "y" for r in got) == 1
    assert len({r["doc_id"] for r in got}) == 30_000
