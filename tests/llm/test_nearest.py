import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from changeflow.llm import nearest as module
from changeflow.llm.nearest import Forest, fit_tree, nearest
from changeflow.llm.queries import RUNS

SCHEMA = "vec_id bigint, embedding array<double>"


def fits(vector):
    return bool(vector) and all(x is not None and math.isfinite(x) for x in vector) and any(vector)


def brute(rows, k=5, every=50):
    """{query: [(id, score)]} of all candidates, nearest first."""
    rows = sorted({(i, tuple(v)) for i, v in rows if i is not None and fits(v)})
    out = {}
    for i, v in rows:
        if i % every == 0:
            a = np.array(v)
            found = []
            for j, w in rows:
                if j != i and len(w) == len(v):
                    b = np.array(w)
                    found.append((-float(a @ b) / float(np.linalg.norm(a) * np.linalg.norm(b)), j))
            out[i] = [(j, -s) for s, j in sorted(found)[:k]]
    return out


def answers(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def recall(ours, theirs):
    hits = [len({j for j, _ in ours.get(q, [])} & {j for j, _ in want}) for q, want in theirs.items()]
    return sum(hits) / sum(map(len, theirs.values()))


def check_scores(ours, rows):
    known = dict(rows)
    for q, found in ours.items():
        a = np.array(known[q], "f8")
        scores = [s for _, s in found]
        assert scores == sorted(scores, reverse=True)
        for j, score in found:
            b = np.array(known[j], "f8")
            assert score == pytest.approx(a @ b / np.linalg.norm(a) / np.linalg.norm(b), abs=1e-12)


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01",
                                    "/root/testdata/sf0.1"])
def test_whole_table_recall(spark, folder):
    rows = [(r["vec_id"], r["embedding"]) for r in
            spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    ours, theirs = answers(RUNS["op12_nearest"](spark, folder)), brute(rows)
    assert {q: len(v) for q, v in ours.items()} == {q: len(v) for q, v in theirs.items()}
    assert recall(ours, theirs) >= 0.9
    check_scores(ours, rows)


def test_structured_vectors_need_few_candidates(spark, monkeypatch):
    """Vectors near a few lines: the budget stays far below the table, recall high."""
    seen = []
    search = module._search
    monkeypatch.setattr(module, "_search", lambda *a: seen.append(a[2].value[32].budget) or search(*a))
    make = np.random.default_rng(5)
    centres = make.standard_normal((200, 32))
    rows = [(i, (centres[i % 200] + 0.2 * make.standard_normal(32)).tolist()) for i in range(8000)]
    ours = answers(nearest(spark, spark.createDataFrame(rows, SCHEMA)))
    assert recall(ours, brute(rows)) >= 0.9
    assert seen[0] < 4000


def test_copies_and_ties(spark):
    """A vector held by a third of the rows: ties go to the smaller ids, in full."""
    make = np.random.default_rng(6)
    same = [1.0, 2.0, 3.0, 4.0]
    rows = [(i, same if i % 3 == 0 else make.standard_normal(4).tolist()) for i in range(900)]
    ours, theirs = answers(nearest(spark, spark.createDataFrame(rows, SCHEMA))), brute(rows)
    for q in theirs:
        if q % 3 == 0:
            assert [j for j, _ in ours[q]] == [0, 3, 6, 9, 12, 15][:6 if q > 15 else 6][
                (1 if q == 0 else 0):][:5]
    assert recall(ours, theirs) >= 0.95


def test_few_candidates_are_all_found(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.1]), (2, [-1.0, 0.0]), (3, [0.0, 1.0]), (50, [2.0, 0.0])]
    ours = answers(nearest(spark, spark.createDataFrame(rows, SCHEMA)))
    assert [j for j, _ in ours[0]] == [50, 1, 3, 2]
    assert [j for j, _ in ours[50]] == [0, 1, 3, 2]


def test_odd_rows(spark):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, None), (2, []), (3, [0.0, 0.0]),
            (4, [None, 1.0]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]),
            (7, [0.5, 0.5]), (None, [1.0, 0.0]), (50, [1.0, 1.0, 1.0]), (100, None),
            (9, [1e300, 1e300]), (10, [1e-300, 0.0])]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({
        n: F.lit(1) for n in ("ident", "cid", "vector", "h1", "asked", "_salt", "size")})
    ours = answers(nearest(spark, df))
    assert [j for j, _ in ours[0]] == [10, 7, 9]
    assert sorted(ours) == [0]
    assert nearest(spark, df.limit(0)).collect() == []


def test_large_leaves_are_dealt_to_blocks(spark, monkeypatch):
    monkeypatch.setattr(module, "SAMPLE_ROWS", 64)
    monkeypatch.setattr(module, "PROBES", 32)
    monkeypatch.setattr(module, "LEAF", 16)
    make = np.random.default_rng(8)
    rows = [(i, make.standard_normal(8).tolist()) for i in range(1500)]
    df = spark.createDataFrame(rows, SCHEMA)
    ours, theirs = answers(nearest(spark, df, recall=1.0)), brute(rows)
    assert recall(ours, theirs) >= 0.9
    check_scores(ours, rows)


def test_a_search_without_budget_visits_every_leaf_once():
    data = np.random.default_rng(9).standard_normal((500, 6))
    data /= np.linalg.norm(data, axis=1)[:, None]
    trees = [fit_tree(data, 20, np.random.default_rng(t)) for t in range(3)]
    rows = [dict(zip(*map(list, np.unique(t.leaves(data), return_counts=True)))) for t in trees]
    visits = list(Forest(trees, rows=rows).search(data[7]))
    assert len(visits) == len({v[:2] for v in visits}) == sum(map(len, rows))
    assert all(sum(r.values()) == 500 and max(r.values()) <= 20 for r in rows)
    assert {t: leaf for t, leaf, _ in reversed(visits)} == {
        t: int(tree.leaves(data[7:8])[0]) for t, tree in enumerate(trees)}


def test_all_vectors_alike_end_in_one_leaf():
    tree = fit_tree(np.ones((100, 3)) / math.sqrt(3), 10, np.random.default_rng(1))
    assert tree.leaves(np.ones((2, 3))).tolist() == [0, 0]
