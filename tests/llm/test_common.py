import random

import numpy as np
import pyarrow as pa
import pytest

from changeflow.llm.common import components, forest, group_starts, majority_bits, one_name, \
    pairs_in, whole_groups


def test_majority_bits():
    make = np.random.default_rng(1)
    hashes = make.integers(0, 2**64, 5000, dtype="u8")
    sizes = np.array([0, 3, 1000, 0, 1, 3996, 0])
    at = 0
    for found, size in zip(majority_bits(hashes, sizes).tolist(), sizes):
        own = hashes[at:at + size].tolist()
        at += size
        assert found == sum(1 << b for b in range(64)
                            if 2 * sum(h >> b & 1 for h in own) > size)


@pytest.mark.parametrize("most", [1, 7, 1000])
def test_pairs_in(most):
    seen = [(int(a), int(b)) for i, j in pairs_in(np.array([0, 3, 4, 10]), 12, most)
            for a, b in zip(i, j)]
    assert sorted(seen) == [(i, j) for a, b in ((0, 3), (3, 4), (4, 10), (10, 12))
                            for i in range(a, b) for j in range(i + 1, b)]
    assert list(pairs_in(np.zeros(0, "i8"), 0, most)) == []


@pytest.mark.parametrize("rows", [1, 5, 1000])
def test_whole_groups(rows):
    seed = random.Random(rows)
    keys = sorted(seed.choices(range(30), k=400))
    batches, at = [], 0
    while at < len(keys):
        size = seed.randrange(0, 40)
        batches.append(pa.RecordBatch.from_pydict({"k": pa.array(keys[at:at + size], pa.int64())}))
        at += size
    seen = []
    for table, starts in whole_groups(batches, ["k"], rows):
        own = table.column("k").to_pylist()
        assert starts.tolist() == group_starts(table, ["k"]).tolist()
        assert not set(own) & set(seen)
        seen += own
    assert seen == keys


def _reach(links):
    root = {}

    def top(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        root[max(top(a), top(b))] = min(top(a), top(b))
    return {x: top(x) for x in root}


def test_forest():
    seed = random.Random(4)
    for _ in range(200):
        links = [(seed.randrange(30), seed.randrange(30)) for _ in range(seed.randrange(40))]
        a, b = forest(*(np.array(side, "i8") for side in zip(*links))) if links else ([], [])
        want = {x: r for x, r in _reach(links).items() if x != r}
        assert dict(zip(map(int, a), map(int, b))) == want


@pytest.mark.parametrize("shape", ["path", "star", "random", "empty"])
def test_components(spark, shape):
    seed = random.Random(6)
    links = {"path": [(i, i + 1) for i in range(300)], "star": [(0, i) for i in range(1, 300)],
             "random": [(seed.randrange(-200, 200), seed.randrange(-200, 200)) for _ in range(170)],
             "empty": []}[shape]
    found = components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    nodes = _reach([link for link in links if link[0] != link[1]])
    assert {r["node"]: r["root"] for r in found} == nodes
    assert len(found) == len(nodes)


def test_one_name(spark):
    assert one_name(spark.createDataFrame([], "Key int, _key int"), "key") == "__key"
