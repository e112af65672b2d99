import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from changeflow.llm.quality_rules import CLASSES, COMMON, class_counts, common_counts, divergence, \
    judge_quality, let, repeated_words, words_of

GAP = "[ \t\n\x0b\x0c\r]+"


def brute(text):
    words = [w for w in re.split(GAP, text or "") if w]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.sub(GAP, "", x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""),
            len(lines) - len(set(lines)), len(covered),
            len(words) < 50 or 100 * len(covered) > 50 * len(words))


def random_texts():
    seed = random.Random(8)
    words = ["a", "b", "the", "The", "THE", "für", "Für", "x|y", "#", "é", "1", "\U0001f600"]
    for _ in range(150):
        size = seed.choice([0, 1, 2, 3, 6, 60, 300])
        few = seed.sample(words, seed.randint(1, len(words))) + [f"w{i}" for i in range(
            seed.choice([0, 5, 500]))]
        yield "".join(seed.choice(few) + seed.choice([" ", "  ", "\n", "\t", "\r\n", "\x0b"])
                      for _ in range(size)).removesuffix(seed.choice([" ", "\n", "-"]))


def test_base_counts(spark):
    rows = [(i, t, "en") for i, t in enumerate([None, "", " \n", "x", *random_texts(),
                                                "y " * 40_000, "a b c d " * 20_000])]
    table = spark.createDataFrame(rows, "doc_id int, text string, lang string")
    got = {r["doc_id"]: (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"],
                         r["n_repeat_words"], r["base_failed"])
           for r in judge_quality(spark, table).collect()}
    assert got == {i: brute(t) for i, t, _ in rows}


@pytest.mark.parametrize("looked_up", [0, 1000])
def test_both_ways_to_find_windows(spark, monkeypatch, looked_up):
    import changeflow.llm.quality_rules as rules
    monkeypatch.setattr(rules, "LOOKED_UP", looked_up)
    texts = list(random_texts())
    table = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    got = dict(table.select("i", let(words_of(F.col("text")), repeated_words)).collect())
    assert got == {i: brute(t)[4] for i, t in enumerate(texts)}


def test_histograms(spark):
    texts = list(random_texts())
    table = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    got = table.select("i", class_counts(F.col("text")).alias("c"),
                       let(words_of(F.col("text")), common_counts).alias("w")).collect()
    for i, classes, common in got:
        counts = [len("".join(re.findall(p, texts[i]))) for p in CLASSES]
        assert classes == counts + [len(texts[i]) - sum(counts)]
        words = re.split(GAP, texts[i])
        assert common == [words.count(w) + words.count(w.capitalize()) for w in COMMON]


def test_divergence(spark):
    table = spark.createDataFrame([([1.0, 1.0, 0.0], [2.0, 2.0, 0.0]), ([1.0, 0.0], [0.0, 5.0]),
                                   ([1.0, 3.0], [1.0, 1.0])], "a array<double>, b array<double>")
    same, apart, some = [r[0] for r in table.select(
        divergence(F.col("a"), F.col("b"))).collect()]
    assert (same, apart) == (0, 1) and some == pytest.approx(0.2208, abs=1e-4)


def test_odd_rows(spark):
    prose = [" ".join(f"{w}{'thornbeak'[i % 9]}{k}e" for k, w in enumerate(
        "the river and old mill by this town with a sea of reeds".split() * 6)) for i in range(40)]
    rows = [(i, t, "en", "x") for i, t in enumerate(prose)]
    rows += [(100, prose[0].upper(), "en", None), (None, prose[1], None, "y"), (101, prose[2], "zz", ""),
             (102, "a b", "qq", "z"), (0, prose[0], "en", "x")]
    table = spark.createDataFrame(rows, "doc_id int, text string, lang string, kept string") \
        .selectExpr("*", "1 AS base", "2 AS classes", "3 AS language", "4 AS row")
    got = judge_quality(spark, table)
    assert [c for c in got.columns if c.lower() == "kept"] == ["kept"]
    kept = sorted((str(r["doc_id"]), r["kept"]) for r in got.collect())
    assert kept == sorted((str(r[0]), r[0] not in (100, 102)) for r in rows)
    assert judge_quality(spark, table.limit(0)).collect() == []
