import re
from collections import defaultdict
from itertools import permutations

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from changeflow.llm import filter_audit
from changeflow.llm.filter_audit import CHECKS, audit, interactions, union, without

DOCS = "doc_id bigint, text string, source string"
LABELS = "doc_id bigint, quality int, toxic int"
sorted_ids = st.lists(st.integers(0, 60), unique=True).map(lambda x: np.array(sorted(x), "i8"))


@settings(deadline=None, max_examples=200)
@given(sorted_ids, sorted_ids, sorted_ids)
def test_lists(a, b, c):
    assert without(a, b).tolist() == sorted(set(a.tolist()) - set(b.tolist()))
    assert union([a, b, c]).tolist() == sorted({*a.tolist(), *b.tolist(), *c.tolist()})


@settings(deadline=None, max_examples=50)
@given(st.lists(sorted_ids, min_size=3, max_size=3), sorted_ids)
def test_interactions(lists, marked):
    sets = [set(x.tolist()) for x in lists]
    for i, before, gone, removed, lost in interactions(lists, [marked]):
        taken = set().union(*[s for j, s in enumerate(sets) if before >> j & 1])
        assert (gone, removed) == (len(taken | sets[i]), len(sets[i] - taken))
        assert lost == len((sets[i] - taken) & set(marked.tolist()))


def fails(text, ident, firsts):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {c for c, bad in (
        ("A", len(words) < 50), ("B", 100 * len(set(words)) < 65 * len(words)),
        ("C", 100 * len(re.findall("[A-Z]", text)) > 5 * len(text)),
        ("D", re.search(r"[#$%&*|]", text)),
        ("E", ident is not None and ident > firsts[text])) if bad}


def brute(docs, labels):
    firsts = {}
    for i, t, _ in docs:
        if i is not None:
            firsts[t or ""] = min(i, firsts.get(t or "", i))
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    parts = defaultdict(list)
    for i, t, s in docs:
        parts[s or ""].append((i, fails(t or "", i, firsts)))
    out, shapley = [], defaultdict(int)
    for part, rows in parts.items():
        for order in map("".join, permutations("ABCDE")):
            left = rows
            for step, own in enumerate(order, 1):
                gone = [i for i, f in left if own in f]
                left = [(i, f) for i, f in left if own not in f]
                shapley[part, own] += len(gone)
                out.append((part, order, step, len(left), len(gone),
                            sum(own in f for _, f in rows) - len(gone),
                            sum(f == {own} for _, f in rows), sum(i in good for i in gone),
                            sum(i in toxic for i in gone)))
    return sorted((*row, shapley[row[0], row[1][row[2] - 1]]) for row in out)


NAMES = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost",
         "toxic_lost", "shapley"]


def check(spark, docs, labels):
    ours = audit(spark, spark.createDataFrame(docs, DOCS).withColumns(
        {n: F.lit(1) for n in ("ident", "part", "fails", "digest", "_salt", "first")}),
        spark.createDataFrame(labels, LABELS))
    assert sorted(tuple(r[n] for n in NAMES) for r in ours.collect()) == brute(docs, labels)


def words(n, of, extra=""):
    return " ".join(f"w{i % of}" for i in range(n)) + extra


ODD = [(1, words(60, 60), "a"), (2, words(60, 60), "b"), (3, words(60, 20), "a"), (4, None, None),
       (5, "", "a"), (5, "", "a"), (None, "", "a"), (6, words(60, 60, " #"), None),
       (7, words(60, 60).upper(), "b"), (8, "ÄÖÜ " * 60, "b"), (9, words(49, 49), "c"),
       (2, words(60, 60, " x"), "b"), (10, words(100_000, 70_000), "c"), (11, " ".join("abc"), ""),
       (12, words(60, 60), "d")]
SAID = [(1, 1, 0), (2, 1, 1), (2, 0, 0), (3, None, 1), (5, 1, None), (None, 1, 1), (99, 1, 1)]


def test_odd_rows(spark):
    check(spark, ODD, SAID)
    check(spark, ODD[:1], [])
    check(spark, [(9, words(70, 70), "clean")], [])


def test_empty_table(spark):
    assert audit(spark, spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)).count() == 0


def test_many_ranges_of_one_part(spark, monkeypatch):
    """A third of the rows are copies, and lists are cut to many ranges."""
    monkeypatch.setattr(filter_audit, "RANGE_ROWS", 7)
    make = np.random.default_rng(3)
    docs = [(int(make.integers(0, 5000)), ODD[int(make.integers(0, len(ODD)))][1]
             if i % 3 else "copy", f"s{i % 4 if i % 2 else 0}") for i in range(600)]
    check(spark, docs, [(i, int(i % 2), int(i % 5 == 0)) for i in range(0, 5000, 3)])


def test_other_checks(spark):
    docs = spark.createDataFrame([(1, "b", "s"), (2, "bb", "s"), (3, "b", "s")], DOCS)
    rows = audit(spark, docs, spark.createDataFrame([], LABELS),
                 checks={"L": lambda t: len(t) > 1}).collect()
    assert sorted((r["filter_order"], r["step"], r["removed"], r["kept"]) for r in rows) == [
        ("EL", 1, 1, 2), ("EL", 2, 1, 1), ("LE", 1, 1, 2), ("LE", 2, 1, 1)]


def test_checks_are_those_of_the_contract():
    assert list(CHECKS) == ["A", "B", "C", "D"]
    assert CHECKS["A"](b"a " * 49) and not CHECKS["A"](b"a " * 50)
    assert CHECKS["B"](b"a " * 50) and not CHECKS["B"](b"")
    assert CHECKS["C"]("Aé".encode() * 3) and not CHECKS["C"](("A" + "é" * 19).encode())
    assert CHECKS["D"](b"a|b") and not CHECKS["D"](b"a@b^")
