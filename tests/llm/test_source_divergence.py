import re
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from changeflow.llm import common, source_divergence
from changeflow.llm.source_divergence import Block, divergence, terms

SCHEMA = "doc_id bigint, text string, lang string, source string"
NAMES = ["lang", "source", "part", "item", "value", "rank"]


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def brute(docs, top=200):
    counts, texts, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source in docs:
        lang, source = lang or "", source or ""
        found = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower(text or ""))
        counts[lang, source].update(found)
        texts[lang].update(set(found))
        groups[lang].add(source)
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in texts[lang].items() if n >= 3]
        whole = Counter()
        for s in sources:
            whole.update({t: counts[lang, s][t] for t in kept})

        def shares(c):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10 ** 9 * (c[t] + 1) // (n + len(kept)) for t in kept}

        p, q = {s: shares(counts[lang, s]) for s in sources}, shares(whole)
        for s in sources:
            pair = [(-sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o)
                    for o in sources - {s}]
            term = [(-((p[s][t] - q[t]) ** 2 // q[t]), t) for t in kept
                    if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found in (("pair", sorted(pair)),
                                ("term", sorted(term, key=lambda x: (x[0], x[1].encode()))[:top])):
                out += [(lang, s, part, item, -v, r) for r, (v, item) in enumerate(found, 1)]
    return sorted(out)


def check(spark, docs, **more):
    df = spark.createDataFrame(docs, SCHEMA).withColumns(
        {n: F.lit(1) for n in ("term", "n", "held", "at", "size", "item", "value", "rank")})
    ours = divergence(spark, df, **more)
    assert sorted(tuple(r[n] for n in NAMES) for r in ours.collect()) == brute(docs, **more)


def test_terms():
    text = "Abc-déF 12x y É\x7fz\x00q\n日本 don't"
    assert [t.decode() for t in terms(text.encode())] == re.findall(
        r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower(text))


ODD = [(1, "The cat, the Cat", "en", "a"), (2, "the dog É", "en", "b"), (3, "the cat É", "en", "b"),
       (4, "THE fox É", "en", "c"), (5, None, "en", "d"), (6, "", "en", None), (7, "x", None, "a"),
       (8, "x x", None, "b"), (9, "x", None, None), (10, "alone", "fr", "a"), (11, "lone", "fr", "b"),
       (12, "one", "de", "a"), (13, "cat dog", "en", "a"), (13, "cat dog", "en", "a"),
       (None, "dog", "en", ""), (14, "cat " * 200_000 + "y" * 200_000, "en", "c"),
       (15, "\x01\x7f 12", "en", "e")]


def test_odd_rows(spark):
    check(spark, ODD)
    check(spark, ODD[9:12])


def test_empty_table(spark):
    assert divergence(spark, spark.createDataFrame([], SCHEMA)).count() == 0


def test_many_runs_and_a_cut_of_ranks(spark, monkeypatch):
    monkeypatch.setattr(source_divergence, "BLOCK_WORDS", 200)
    monkeypatch.setattr(source_divergence, "ROWS_OUT", 16)
    monkeypatch.setattr(common, "PAIRS_AT_ONCE", 64)
    make = np.random.default_rng(4)
    docs = [(i, " ".join(f"w{chr(97 + int(x) % 26)}{chr(97 + int(x) // 26 % 26)}"
                         for x in make.zipf(1.3, 30) % 500),
             "en" if i % 3 else "de", f"s{int(make.integers(0, 6))}" if i % 2 else "hot")
            for i in range(400)]
    check(spark, docs, top=10)


def test_a_run_is_sorted_and_whole():
    block = Block()
    block.add([("en", "b"), ("en", "a")], [b"b a a", b"a \xc3\xa9"])
    block.add([("de", "a"), ("en", "b"), ("en", "b"), ("fr\x00", "c\x00")], [b"a", b"a", b"1", b"a"])
    assert [tuple(r.values()) for batch in block.run() for r in batch.to_pylist()] == [
        ("de", "a", "a", 1, 1), ("en", "a", "a", 1, 1), ("en", "a", "b", 3, 2),
        ("en", "b", "b", 1, 1), ("en", "é", "a", 1, 1), ("fr\x00", "a", "c\x00", 1, 1)]
    assert list(Block().run()) == []
