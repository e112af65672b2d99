"""Split planning against hand-derived values and invariants."""

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from changeflow.sources.jdbc import range_predicates
from changeflow.sources.scan import range_number
from changeflow.sources.splits import plan_splits, share, split_range


@pytest.mark.parametrize("bounds, n, expected", [
    ((-100, 100), 3, [(-100, -34), (-33, 33), (34, 100)]),
    ((-100, 100), 2, [(-100, 0), (1, 100)]),
    ((0, 9), 4, [(0, 2), (3, 5), (6, 7), (8, 9)]),
    ((0, 14999), 7, [(0, 2142), (2143, 4285), (4286, 6428), (6429, 8571), (8572, 10714),
                     (10715, 12857), (12858, 14999)]),
    ((5, 7), 10, [(5, 5), (6, 6), (7, 7)]),
])
def test_range_goldens(bounds, n, expected):
    assert split_range(*bounds, n) == expected


@given(st.integers(-10**6, 10**6), st.integers(0, 10**5), st.integers(1, 500))
def test_ranges_cover_once(lower, span, n):
    ranges = split_range(lower, lower + span, n)
    assert ranges[0][0] == lower and ranges[-1][1] == lower + span
    assert all(a[1] + 1 == b[0] for a, b in zip(ranges, ranges[1:]))
    sizes = [b - a + 1 for a, b in ranges]
    assert max(sizes) - min(sizes) <= 1 and sizes == sorted(sizes, reverse=True)


@given(st.integers(1, 300), st.integers(1, 300))
def test_share(items, groups):
    sizes = share(items, groups)
    assert sum(sizes) == items and max(sizes) - min(sizes) <= 1 and sizes == sorted(sizes)


def test_shard_goldens():
    shards = list(range(1, 12))
    both = plan_splits(shards, 23, -100, 100)
    per_shard = [sum(1 for s in both if s.shards == (shard,)) for shard in shards]
    assert len(both) == 23 and per_shard == [2] * 10 + [3]
    few = plan_splits(shards, 3, -100, -100)
    assert [len(s.shards) for s in few] == [3, 4, 4]
    assert all((s.lower, s.upper) == (-100, -100) for s in few)
    assert [len(s.shards) for s in plan_splits(shards, 3)] == [3, 4, 4]
    assert [len(s.shards) for s in plan_splits(range(8), 4)] == [2, 2, 2, 2]
    assert len(plan_splits(shards)) == 11 and len(plan_splits(["only"], 5)) == 1


@given(st.integers(1, 30), st.integers(1, 80), st.booleans())
def test_shard_plan_covers_each_shard(shards, n, bounded):
    bounds = (0, 999) if bounded else (None, None)
    splits = plan_splits(range(shards), n, *bounds)
    for shard in range(shards):
        mine = sorted((s.lower, s.upper) for s in splits if shard in s.shards) if bounded else \
            [s for s in splits if shard in s.shards]
        if bounded:
            assert mine[0][0] == 0 and mine[-1][1] == 999
            assert all(a[1] + 1 == b[0] for a, b in zip(mine, mine[1:]))
        else:
            assert len(mine) == 1


def test_bad_bounds():
    for arguments in ((5, 4, 1), (0, 9, 0)):
        with pytest.raises(ValueError):
            split_range(*arguments)
    with pytest.raises(ValueError):
        plan_splits(range(3), 0)


def test_jdbc_conditions():
    assert range_predicates("id", 0, 9, 4) == [
        "id BETWEEN 0 AND 2", "id BETWEEN 3 AND 5", "id BETWEEN 6 AND 7", "id BETWEEN 8 AND 9"]


@pytest.mark.parametrize("lower, upper, n", [(-100, 100, 3), (0, 9, 4), (3, 3, 5), (0, 6, 7)])
def test_range_number_matches_plan(spark, lower, upper, n):
    keys = spark.range(lower, upper + 1).select(
        "id", range_number(F.col("id"), lower, upper, n).alias("r"))
    plan = split_range(lower, upper, n)
    for row in keys.collect():
        assert plan[row["r"]][0] <= row["id"] <= plan[row["r"]][1]


LOW, HIGH = -(1 << 63), (1 << 63) - 1


@given(st.integers(LOW, HIGH), st.integers(LOW, HIGH), st.integers(1, 40))
def test_ranges_of_any_bigint_span(one, other, n):
    lower, upper = min(one, other), max(one, other)
    ranges = split_range(lower, upper, n)
    assert ranges[0][0] == lower and ranges[-1][1] == upper
    assert all(a[1] + 1 == b[0] for a, b in zip(ranges, ranges[1:]))
    assert len(plan_splits(["a", "b"], n, lower, upper)) >= min(n, 2)


@pytest.mark.parametrize("lower, upper, n", [(LOW, HIGH, 4), (LOW, HIGH, 7), (-5, HIGH, 3),
                                             (LOW, 0, 1000), (LOW + 1, HIGH - 1, 2)])
def test_range_number_of_wide_spans(spark, lower, upper, n):
    plan = split_range(lower, upper, n)
    keys = sorted({k for a, b in plan[:5] + plan[-5:] for k in (a, b, (a + b) // 2)})
    df = spark.createDataFrame([(k,) for k in keys], "id bigint")
    for row in df.select("id", range_number(F.col("id"), lower, upper, n).alias("r")).collect():
        assert plan[row["r"]][0] <= row["id"] <= plan[row["r"]][1]
