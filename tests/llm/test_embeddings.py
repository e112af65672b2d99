import math

import numpy as np
import pytest

from changeflow.llm import embeddings
from changeflow.llm.embeddings import codes, estimates, lowest_estimate, near_vectors, rotation, \
    tables_for, unit
from changeflow.llm.queries import RUNS

SCHEMA = "vec_id bigint, embedding array<double>"


def brute(rows, at_least=0.95):
    ok = [v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v)
          and any(v) for _, v in rows]
    links, root = [0] * len(rows), list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    units = [unit(np.array([v], "f8"))[0] if good else None for (_, v), good in zip(rows, ok)]
    for i in range(len(rows)):
        for j in range(i):
            if ok[i] and ok[j] and len(units[i]) == len(units[j]) \
                    and float(units[i] @ units[j]) >= at_least:
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    heads = {}
    for i, (ident, _) in enumerate(rows):
        if ident is not None:
            heads[find(i)] = min(ident, heads.get(find(i), ident))
    return sorted(str((ident, links[i], heads.get(find(i)), heads.get(find(i)) == ident))
                  for i, (ident, _) in enumerate(rows))


def shown(df):
    return sorted(str(tuple(r)) for r in df.collect())


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.1"])
def test_whole_table(spark, folder):
    rows = [(r["vec_id"], r["embedding"]) for r in
            spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    assert shown(RUNS["op1_embeddings"](spark, folder)) == brute(rows)


def planted(seed, size, groups, most):
    make, rows = np.random.default_rng(seed), []
    for _ in range(groups):
        centre = make.standard_normal(size)
        for _ in range(int(make.integers(1, most))):
            near = centre + make.standard_normal(size) * make.choice([0.0, 0.15, 0.3, 0.4])
            rows.append((len(rows), (near * 10 ** make.uniform(-3, 3)).tolist()))
    return rows


@pytest.mark.parametrize("size, block", [(64, 1024), (64, 8), (3, 1024), (1, 1024), (2, 8), (300, 64)])
def test_planted(spark, monkeypatch, size, block):
    monkeypatch.setattr(embeddings, "BLOCK", block)
    rows = planted(size, size, 40, 30)
    assert shown(near_vectors(spark, spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]),
            (7, [1.0, 0.0]), (8, [2.0, 0.0]), (8, [2.0, 0.0]), (9, [-1.0, 0.0]), (10, [1.0, 0.0, 0.0]),
            (None, [1.0, 0.1]), (None, [0.0, 5.0]), (11, [1e200, 1e200]), (12, [3e-200, 3e-200]),
            (13, [0.0, 0.0])]
    table = spark.createDataFrame(rows, SCHEMA).selectExpr(
        "*", "1 AS ident", "2 AS vector", "3 AS n_links", "4 AS cid")
    got = near_vectors(spark, table)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert shown(got) == sorted(
        s.replace("(None, 0, None, False)", "(None, 0, None, True)") for s in brute(rows))
    assert near_vectors(spark, table.limit(0)).collect() == []


def test_estimates_are_unbiased_and_bounded():
    make = np.random.default_rng(7)
    size = 64
    a = unit(make.standard_normal((4000, size)))
    b = unit(0.95 * a + math.sqrt(1 - 0.95 ** 2) * unit(
        (e := make.standard_normal((4000, size))) - np.einsum("ij,ij->i", e, a)[:, None] * a))
    assert np.allclose(np.einsum("ij,ij->i", a, b), 0.95)
    packed, factor = codes(a, size)
    signs = np.where(np.unpackbits(packed, axis=1, count=size), 1.0, -1.0)
    found = estimates(signs, factor, b @ rotation(size, 0))
    assert abs(found.mean() - 0.95) < 0.003
    assert (found >= lowest_estimate(factor, size, 0.95)).all()


def test_more_vectors_take_longer_keys():
    assert [tables_for(n)[0] for n in (0, 500, 50_000, 10 ** 9)] == [8, 13, 20, 34]
    assert tables_for(10 ** 6, at_least=1.0)[1] == 1
