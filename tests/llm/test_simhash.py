import random

import pytest
import xxhash

from changeflow.llm.simhash import key_width, near_duplicates, one_of_each, position_keys

GAPS = " \t\n\x0b\x0c\r"


def brute_fingerprint(text, shingle=4):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in lowered + " ":
        if c in GAPS:
            words += [word] if word else []
            word = ""
        else:
            word += c
    shingles = [" ".join(words[i:i + shingle]) for i in range(len(words) - shingle + 1)] \
        or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows, bits=4):
    fps = [brute_fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))
    for _ in rows:
        before = list(root)
        for i in range(len(rows)):
            for j in range(len(rows)):
                if bin(fps[i] ^ fps[j]).count("1") <= bits:
                    root[i] = min(root[i], root[j])
        if root == before:
            break
    heads = {}
    for r, (ident, _) in zip(root, rows):
        heads[r] = min([x for x in (heads.get(r), ident) if x is not None], default=None)
    return sorted(str((ident, f"{fp:016x}", heads[r]))
                  for (ident, _), fp, r in zip(rows, fps, root))


@pytest.mark.parametrize("min_shared", range(1, 9))
def test_position_keys_cover(min_shared):
    from itertools import combinations
    for width in range(1, min_shared + 1):
        keys = [set(k) for k in position_keys(min_shared, width)]
        assert all(any(k <= set(c) for k in keys) for c in combinations(range(8), min_shared))


def test_key_width_grows():
    assert [key_width(n, 4) for n in (0, 10**6, 10**9, 10**12)] == [2, 2, 3, 4]


def test_near_duplicates(spark):
    seed = random.Random(1)
    vocabulary = [f"w{i}" for i in range(500)] + ["Été", "ÄB", " x", "a\x1cb"]
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "One"), (6, "a b\tc"), (7, "A  b c\r"),
            (None, "null id"), (None, "null  ID"), (8, "null id"), (9, "x " * 30_000)]
    for i in range(10, 60):
        words = seed.choices(vocabulary, k=seed.choice([5, 40, 600]))
        rows.append((i, " ".join(words)))
        if i % 2:
            words[seed.randrange(len(words))] = "changed"
            rows.append((i + 100, "\n".join(words)))
    rows += rows[:3]
    table = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr(
        "*", "1 AS fp", "2 AS ident", "3 AS component_id", "4 AS first")
    got = near_duplicates(spark, table)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted(str(tuple(r)) for r in got.collect()) == brute(rows)
    assert near_duplicates(spark, table.limit(0)).collect() == []


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert sorted(str(tuple(r)) for r in near_duplicates(spark, docs).collect()) == brute(rows)


def test_wide_groups_are_split(spark, monkeypatch):
    import changeflow.llm.simhash as simhash
    monkeypatch.setattr(simhash, "BLOCK", 7)
    rows = [(i, f"alpha beta gamma delta {'x' * (i % 40)}") for i in range(200)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string")
    for bits in (4, 7):
        got = near_duplicates(spark, table, max_bits=bits)
        assert sorted(str(tuple(r)) for r in got.collect()) == brute(rows, bits)


def test_one_of_each(spark):
    rows = [(5, "a b c d e", "x"), (3, "A b c d e", None), (3, "A b c d e", None), (9, None, "y"),
            (None, "", "z"), (7, "quite another text here", "q")]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, ident string")
    got = one_of_each(spark, table)
    assert got.columns == table.columns
    assert sorted(r["doc_id"] for r in got.collect()) == [3, 7, 9]
    assert one_of_each(spark, table.limit(0)).collect() == []
