import os
import random
import re
import time
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from changeflow.llm import line_dedup
from changeflow.llm.line_dedup import Words, normal, normal_lines, simhashes, within, \
    without_repeats
from changeflow.llm.queries import RUNS
from changeflow.session import SPENT, shared_dir, written


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(last + (x != y), row[j] + 1, row[j - 1] + 1)
    return row[-1]


def word_hash(word):
    return mix(sum(b * pow(line_dedup.BASE, i, 2**64) for i, b in enumerate(word)) % 2**64)


def mix(mixed):
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        mixed = (mixed ^ mixed >> shift) * factor % 2**64
    return mixed ^ mixed >> 31


def simhash(form):
    if len(form.split(b" ")) < line_dedup.LONG:
        runs = [form[i:i + 3] for i in range(max(len(form) - 2, 1))]
        hashes = [mix(int.from_bytes(r, "little") * line_dedup.BASE % 2**64) for r in runs]
    else:
        hashes = [word_hash(w) for w in set(form.split(b" "))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def like_pairs(forms, similar=0.8):
    """All pairs of an edit similarity of at least ``similar``.

    Pairs that cannot be as similar are passed over without being compared: by
    length, and since an edit changes at most three letter triples.
    """
    counts = np.zeros((len(forms), 4096), "u1")
    for n, form in enumerate(forms):
        for i in range(len(form) - 2):
            at = zlib.crc32(form[i:i + 3].encode()) % 4096
            counts[n, at] = min(counts[n, at] + 1, 255)
    sizes = np.array([len(f) for f in forms])
    for x in range(len(forms)):
        most = ((1 - similar) * np.maximum(sizes, sizes[x]) + 1e-9).astype(int)
        near = np.flatnonzero((np.abs(sizes - sizes[x]) <= most) & (np.arange(len(forms)) > x))
        shared = np.minimum(counts[near], counts[x]).sum(axis=1)
        for y in near[shared >= np.maximum(sizes[near], sizes[x]) - 2 - 3 * most[near]].tolist():
            if within(forms[x], forms[y], similar):
                yield x, y


def brute(rows, similar=0.8):
    """(ident, new text, lines gone) of each row (ident, text), by edit similarity alone."""
    def who(row):
        return (row[0] is None, row[0] or 0, hash_of(row[1]))

    def hash_of(text):
        return hashes[text]

    places = {}
    for row in rows:
        for n, line in enumerate((row[1] or "").split("\n")):
            if normal(line):
                places.setdefault(normal(line), []).append((*who(row), n))
    forms = list(places)
    root = list(range(len(forms)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for x, y in like_pairs([f.decode() for f in forms], similar):
        root[max(top(x), top(y))] = min(top(x), top(y))
    kept = {}
    for x, form in enumerate(forms):
        kept[top(x)] = min([*places[form], *([kept[top(x)]] if top(x) in kept else [])])
    out = []
    for row in rows:
        if row[1] is None:
            out.append((row[0], None, 0))
            continue
        lines = row[1].split("\n")
        left = [line for n, line in enumerate(lines) if not normal(line)
                or kept[top(forms.index(normal(line)))] == (*who(row), n)]
        out.append((row[0], "\n".join(left), len(lines) - len(left)))
    return sorted(map(str, out))


hashes = {}


def learn_hashes(spark, rows):
    table = spark.createDataFrame([(t,) for _, t in rows], "text string")
    hashes.update({r[0]: r[1] for r in
                   table.selectExpr("text", "xxhash64(text, text IS NULL)").collect()})


def shown(df):
    return sorted(str(tuple(r)) for r in df.collect())


def test_simhashes():
    forms = [b"a", b"the cat sat", b"", b"\xc3\xa9t\xc3\xa9 x", b"x" * 5000, b"---",
             b"a b c d e f g h i j", b" ".join(b"w%d" % (i % 50) for i in range(400))] * 3
    forms = [f for f in forms if f]
    assert simhashes(forms).tolist() == [simhash(f) for f in forms]
    assert simhashes([]).tolist() == []
    assert [normal(x) for x in ("", "  ", "A-b  c!", "--- ", "Été, X")] == [
        b"", b"", b"a b c", b"---", "été x".encode()]


def test_within_is_levenshtein():
    seed = random.Random(2)
    for _ in range(4000):
        a = "".join(seed.choices("abcd é", k=seed.randrange(1, 40)))
        b = list(a)
        for _ in range(seed.randrange(9)):
            at = seed.randrange(len(b) + 1)
            b[at:at + seed.randrange(2)] = seed.choice(["", "x", "ab"])
        b = "".join(b)
        if b:
            assert within(a, b) == (5 * distance(a, b) <= max(len(a), len(b))), (a, b)
    long = "x" * 50_000
    assert within(long + "a", "b" + long) and not within(long, "y" * 50_000)


def test_the_bound_by_words_is_a_bound():
    seed = random.Random(6)
    for _ in range(1500):
        a = seed.choices(["a", "bc", "def", "ghij", "k" * 9], k=seed.randrange(12))
        b = [w for w in a if seed.random() < 0.9]
        for _ in range(seed.randrange(4)):
            b.insert(seed.randrange(len(b) + 1), seed.choice(["a", "x", "longer"]))
        assert line_dedup._at_most(a, b) >= distance(" ".join(a), " ".join(b))
    words = [f"w{i}" for i in range(200)]
    other = [*words[:50], "new", *words[51:120], *words[121:], "end"]
    assert line_dedup._at_most(words, other) <= 20 and line_dedup._at_most(words, words) == 0


def test_distances_of_many_short_lines_at_once():
    seed = random.Random(8)
    pairs = [("", ""), ("", "a"), ("a", ""), ("x" * 64, "y" * 64), ("x" * 64, "x" * 63)]
    for _ in range(1500):
        a = "".join(seed.choices("abc é\U0001f600", k=seed.randrange(65)))
        b = list(a)
        for _ in range(seed.randrange(12)):
            at = seed.randrange(len(b) + 1)
            b[at:at + seed.randrange(2)] = seed.choice(["", "x", "ab"])
        pairs.append((a, "".join(b)[:64]))
    left, left_sizes = line_dedup._rows([a for a, _ in pairs])
    right, right_sizes = line_dedup._rows([b for _, b in pairs])
    got = line_dedup.distances(left, left_sizes, right, right_sizes)
    assert got.tolist() == [distance(a, b) for a, b in pairs]


def changed(line, share, seed, vocabulary):
    """The line with about a share of its words replaced, dropped or added."""
    words = [w for w in line.split() if seed.random() > share / 3]
    words = [w if seed.random() > share / 3 else seed.choice(vocabulary) for w in words]
    return " ".join(x for w in words for x in ([w] if seed.random() > share / 3 else
                                               [w, seed.choice(vocabulary)]))


CLASSES = [(1, 4), (5, 9), (10, 19), (20, 39), (40, 79), (80, 10_000)]


def is_found(a, b):
    """Whether two normal forms share a key and their SimHashes let them pass."""
    words = Words([a.encode(), b.encode()])
    form, key = words.keys()
    bits = words.simhashes()
    long = (words.sizes >= line_dedup.LONG).tolist()
    most = line_dedup.MAX_BITS if long[0] else line_dedup.SHORT_BITS
    near = long[0] != long[1] or int(bits[0] ^ bits[1]).bit_count() <= most
    return near and bool(set(key[form == 0].tolist()) & set(key[form == 1].tolist()))


@pytest.mark.parametrize("share", [None, 0.05, 0.1, 0.2])
def test_recall_by_length_against_edit_similarity_alone(share):
    """Lines with one word replaced (None) or a share of their words edited; all that are still
    0.8 similar have to be found, in nine of ten cases for every length."""
    texts = pq.read_table("/root/testdata/sf0.01/documents.parquet").column("text").to_pylist()
    lines = sorted({f.decode() for t in texts for f in normal_lines(t or "") if f})
    seed = random.Random(share)
    vocabulary = sorted({w for line in lines for w in line.split()})
    for low, high in CLASSES:
        own = [line for line in lines if low <= len(line.split()) <= high]
        found = total = 0
        for line in seed.choices(own, k=1200 if low < 10 else 300):
            words = line.split()
            if share is None:
                words[seed.randrange(len(words))] = seed.choice(vocabulary)
            other = " ".join(words) if share is None else changed(line, share, seed, vocabulary)
            if other and other != line and within(line, other):
                total += 1
                found += is_found(line, other)
        assert total == 0 or found >= 0.9 * total, (low, found, total)


@pytest.mark.parametrize("folder, least", [("/root/testdata/sf0.001", 40)])
def test_recall_over_all_pairs_of_a_table(folder, least):
    texts = pq.read_table(f"{folder}/documents.parquet").column("text").to_pylist()
    lines = sorted({f.decode() for t in texts for f in normal_lines(t or "") if f})
    pairs = list(like_pairs(lines))
    found = [is_found(lines[x], lines[y]) for x, y in pairs]
    assert len(pairs) >= 44 and sum(found) >= max(0.9 * len(pairs), least)


def test_keys_of_short_lines_are_all_words_but_one():
    words = Words([b"a b c d e", b"a b x d e", b"a b d e", b"z a b c d e", b"v w x y z"])
    form, key = words.keys()
    own = [set(key[form == n].tolist()) for n in range(5)]
    assert len(own[0]) > 6 and own[0] & own[1] and own[0] & own[2] and own[0] & own[3]
    assert not own[0] & own[4] and (np.diff(form) >= 0).all()
    single = Words([b"a", b"kommentare", b"kommentar", b"---"])
    form, key = single.keys()
    assert set(key[form == 1].tolist()) & set(key[form == 2].tolist())
    assert set(form.tolist()) == {0, 1, 2, 3}


@pytest.mark.parametrize("block", [1024, 3])
def test_random_lines(spark, monkeypatch, block):
    monkeypatch.setattr(line_dedup, "LARGE", block // 2)
    monkeypatch.setattr(line_dedup, "BLOCK", block)
    monkeypatch.setattr(line_dedup, "VERIFIED", block)
    seed = random.Random(9)
    words = [f"{a}{b}{c}" for a in "bcdfg" for b in "aeiou" for c in ["n", "rt", "lm"]]
    pool = [" ".join(seed.choices(words, k=seed.choice([1, 2, 5, 40]))) for _ in range(25)]
    rows = []
    for i in range(70):
        lines = []
        for _ in range(seed.randrange(6)):
            line = seed.choice(pool).split(" ")
            for _ in range(seed.choice([0, 0, 1, 2])):
                line[seed.randrange(len(line))] = seed.choice(words)
            lines.append(" ".join(line).capitalize() + seed.choice(["", ".", "  "]))
        rows.append((seed.choice([i, i, None]), "\n".join(lines)))
    learn_hashes(spark, rows)
    table = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = without_repeats(spark, table, dropped="gone")
    assert shown(got) == brute(rows)


def test_whole_table(spark, sf_dir):
    rows = [(r["doc_id"], r["text"]) for r in
            spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    learn_hashes(spark, rows)
    assert shown(RUNS["op5_line_dedup"](spark, sf_dir)) == brute(rows)


def test_odd_rows(spark):
    rows = [(2, "Same line\n\n  \nother words"), (1, "same  LINE!\nx"), (None, "other words\n---"),
            (5, None), (6, ""), (7, "---\n==="), (2, "Same line\n\n  \nother words"), (8, "x"),
            (9, "many words here\n" * 3000)]
    learn_hashes(spark, rows)
    table = spark.createDataFrame([(*r, len(r[1] or ""), "e") for r in rows],
                                  "doc_id bigint, text string, n_chars int, lines string") \
        .selectExpr("*", "1 AS new", "2 AS row", "3 AS who", "4 AS cid")
    got = without_repeats(spark, table, length="n_chars")
    assert got.dtypes == table.dtypes
    assert sorted(str((r["doc_id"], r["text"])) for r in got.collect()) == sorted(
        str((i, t)) for i, t, _ in map(eval, brute(rows)))
    assert {(r["doc_id"], r["text"], r["n_chars"]) for r in got.where("doc_id < 3").collect()} == {
        (1, "same  LINE!\nx", 13), (2, "\n  \nother words", 15)}
    assert without_repeats(spark, table.limit(0)).collect() == []


@pytest.mark.parametrize("plain, other", [
    ('he said "go" and went', "He said \u201cgo\u201d and went"), ("l'eau d'ici", "l\u2019eau d\u2019ici"),
    ('er sagt "nein" - nie', "er sagt \u201enein\u201c \u2013 nie"), ("<< oui >> dit", "\u00ab oui \u00bb dit"),
    ("so - or so...", "so \u2014 or so\u2026"), ("10 000 km", "10\u00a0000\u202fkm"), ("a, b", "a\uff0c\u3000b\u3002"),
])
def test_unicode_signs_and_blanks_part_words(spark, plain, other):
    assert normal(plain) == normal(other) != b""
    rows = [(1, plain), (2, other)]
    got = without_repeats(spark, spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert {tuple(r) for r in got.collect()} == {(1, plain), (2, "")}


def test_unicode_words_stay():
    seed = random.Random(4)
    for _ in range(20_000):
        line = "".join(chr(seed.choice([seed.randrange(32, 127), seed.randrange(160, 0x3100)]))
                       for _ in range(6))
        words = re.findall(r"[^\W_]+", line.lower())
        assert normal(line) == (" ".join(words) or line.strip()).encode()


def test_large_lists_shrink_round_by_round(spark, monkeypatch):
    """A third of the lines are one template, alike in a chain; others share words only."""
    monkeypatch.setattr(line_dedup, "VERIFIED", 16)
    monkeypatch.setattr(line_dedup, "BLOCK", 32)
    rows = [(i, f"posted by the admin of this site on day {i:03} at noon") for i in range(200)]
    rows += [(1000 + i, f"x{i * 7919} y{i * 104729} common words here {i * 31}") for i in range(100)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string")
    left = {r["doc_id"] for r in without_repeats(spark, table).where("text <> ''").collect()}
    assert left == {0, *range(1000, 1100)}


def test_lists_of_unlike_lines_are_compared_block_by_block(spark, monkeypatch):
    """Many lines share a key without being alike; the few pairs among them are found."""
    monkeypatch.setattr(line_dedup, "VERIFIED", 8)
    monkeypatch.setattr(line_dedup, "BLOCK", 16)
    seed = random.Random(12)
    rows = []
    for i in range(60):
        tail = "".join(seed.choices("bcdfghjklmnp", k=14))
        rows.append((2 * i, f"one two three {tail}"))
        if i % 6 == 0:
            rows.append((2 * i + 1, f"one two three {tail}q"))
    table = spark.createDataFrame(rows, "doc_id bigint, text string")
    gone = {r["doc_id"] for r in without_repeats(spark, table).where("text = ''").collect()}
    assert gone == {r[0] for r in rows if r[0] % 2}


def test_large_lists_keep_the_links_of_lines_that_do_not_go_on(spark, monkeypatch):
    """Of three lines the middle one is like both others, which are not alike themselves."""
    monkeypatch.setattr(line_dedup, "VERIFIED", 16)
    rows = []
    for n in range(20):
        x = [chr(0x4E00 + n * 40 + k) for k in range(14)]
        for form in (x[:10], x[10:12] + x[2:10], x[10:14] + x[4:10]):
            rows.append((len(rows), 0, False, "".join(form)))
    formed = spark.createDataFrame(rows, "cid long, bits long, long boolean, form string")
    close = formed.selectExpr("1 AS key", "cid")
    found = line_dedup.components(line_dedup._alike(close, formed, 17, 0.8)).collect()
    assert {r["node"]: r["root"] for r in found} == {n: n - n % 3 for n in range(60)}


def test_the_bound_by_letters_is_a_bound():
    draw = random.Random(3)
    forms = ["".join(draw.choice("abcdé \U0001f600\ud800") for _ in range(draw.randrange(0, 30)))
             for _ in range(60)]
    sizes = np.array([len(f) for f in forms])
    counts = line_dedup._letter_counts(forms, sizes)
    i, j = (a.ravel() for a in np.indices((60, 60)))
    exact = np.array([distance(forms[a], forms[b]) for a, b in zip(i, j)])
    assert line_dedup._may_be_alike(counts, i, j, exact).all()
    assert not line_dedup._may_be_alike(counts, i, j, np.maximum(exact // 3, 0)).all()
    many = ["a" * 70_000, "a" * 40_000 + "b" * 30_000]
    counts = line_dedup._letter_counts(many, np.array([70_000, 70_000]))
    assert line_dedup._may_be_alike(counts, np.array([0]), np.array([1]), np.array([30_000])).all()


def test_two_lines_are_compared_in_one_of_their_lists_only():
    """Lines 1 and 2 meet in lists 7 and 8 of one block and in the larger list 9; 1 and 3 meet
    in the larger lists 9 and 10. All are close."""
    lists, larges = {1: [7, 8], 2: [7, 8], 3: []}, {1: [9, 10], 2: [9], 3: [9, 10]}
    rows = [(key, cid) for key in (7, 8, 9, 10) for cid in (1, 2, 3) if key in lists[cid] + larges[cid]]
    table = pa.table({
        "key": pa.array([k for k, _ in rows], pa.int32()), "cid": [c for _, c in rows],
        "root": [c for _, c in rows], "bits": [0] * len(rows), "size": [20] * len(rows),
        **{name: pa.array([0] * len(rows), pa.int32()) for name in ("mine", "lo", "hi")},
        "lists": pa.array([lists[c] for _, c in rows], pa.list_(pa.int32())),
        "larges": pa.array([larges[c] for _, c in rows], pa.list_(pa.int32()))})
    starts = np.array([0, 2, 4, 7])

    def compared(last):
        return sorted((rows[i][0], rows[i][1], rows[j][1])
                      for both in line_dedup._own(table, starts, 17, 0.8, last)
                      for i, j in zip(*(side.tolist() for side in both)))

    assert compared(False) == [(7, 1, 2), (9, 1, 3), (9, 2, 3), (10, 1, 3)]
    assert compared(True) == [(9, 1, 3), (9, 2, 3)]


def test_sizes_are_letters():
    forms = ["a", "été x", "\U0001f600 b", "---", "a b c d e f g h i j", "x" * 3000]
    sizes = line_dedup._sizes(Words([f.encode() for f in forms]))
    assert sizes.tolist() == [1, 5, 3, 3, -19, 3000]


def test_many_distances_at_once_are_levenshtein():
    seed = random.Random(11)
    for letters in ("ab", "abcdefgh ", "".join(map(chr, range(0x4E00, 0x5A00))), "a\ud800\U0001f600"):
        pairs = []
        for _ in range(400):
            size = seed.choice([0, 1, 20, 63, 64, 65, 100, 128, 129, 150])
            one = "".join(seed.choices(letters, k=size))
            other = list(one)
            for _ in range(seed.choice([0, 1, size // 10, size // 5, size // 4, size])):
                at = seed.randrange(len(other) + 1)
                other[at:at + seed.randrange(2)] = seed.choices(letters, k=seed.randrange(2))
            pairs.append((one, "".join(other))[::seed.choice([1, -1])])
        want = [5 * distance(a, b) <= max(len(a), len(b)) for a, b in pairs]
        assert line_dedup.within_many(pairs).tolist() == want
        assert 50 < sum(want) < 400
    long = "x" * (2 * line_dedup.WIDE)
    assert line_dedup.within_many([(long + "a", "b" + long), (long, long[::2])]).tolist() == [True, False]
    assert line_dedup.within_many([]).tolist() == []


def test_a_large_group_is_joined_by_few_comparisons():
    asked = []

    def joined(total, alike):
        asked.clear()
        i, j = np.triu_indices(total, 1)
        return line_dedup._joined(np.arange(total), i, j, lambda i, j: (
            asked.extend(zip(i.tolist(), j.tolist())), alike(i, j))[1]).tolist()

    assert joined(400, lambda i, j: i >= 0) == [0] * 400
    assert len(asked) == 399
    assert joined(60, lambda i, j: i % 2 == j % 2) == [0, 1] * 30
    assert len(asked) == len(set(asked)) < 60 * 59 // 2
    assert joined(60, lambda i, j: j == i + 1) == [0] * 60
    assert joined(60, lambda i, j: j < 0) == list(range(60)) and len(asked) == 60 * 59 // 2
    assert joined(0, None) == []


def test_only_blocks_of_fitting_sizes_meet(spark):
    """Of a list of 400 lines of 10 to 409 letters, blocks of 20 meet if some of their lines fit."""
    sizes = random.Random(5).sample(range(10, 410), 400)
    rows = [(7, n, size * (1 if size % 2 else -1)) for n, size in enumerate(sizes)] + [(8, 400, 9)]
    listed = spark.createDataFrame(rows, "key int, cid bigint, size int")
    dealt = line_dedup._by_size(listed, 20, 0.8).collect()
    of = {(r["key"], r["cid"], r["mine"], r["lo"], r["hi"]) for r in dealt}
    assert len(of) == len(dealt) and all(mine in (lo, hi) and lo <= hi for *_, mine, lo, hi in of)
    places = {cid: set() for _, cid, *_ in of}
    mine = {}
    for key, cid, own, lo, hi in of:
        places[cid].add((key, lo, hi))
        mine[cid] = own
    for x in range(400):
        for y in range(x):
            if abs(sizes[x] - sizes[y]) <= int(0.2 * max(sizes[x], sizes[y]) + 1e-9):
                met = (7, *sorted((mine[x], mine[y])))
                assert met in places[x] and met in places[y]
    assert places[400] == {(8, 0, 0)} and max(map(len, places.values())) <= 10
    assert len(dealt) < 3000  # 8,000 if every block met every other one


def test_only_the_result_stays_in_the_shared_folder(spark):
    def tables():
        folder = shared_dir(spark).removeprefix("file:") + "/changeflow"
        return set(os.listdir(folder)) if os.path.isdir(folder) else set()

    before = tables()
    rows = [(n, f"line one two three four number {n % 50}\nand another line {n}") for n in range(200)]
    gone = line_dedup.repeated_lines(spark, spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert [name.split("-")[0] for name in tables() - before] == ["gone"]
    assert gone.count() >= 150


def test_shuffle_files_go_when_a_step_is_written(spark):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def kept():
        files = manager.getAllFiles()
        return {name for name in (files.apply(n).getName() for n in range(files.size()))
                if name.startswith("shuffle_")}

    before = kept()
    numbers = spark.range(10_000)
    sums = numbers.groupBy((numbers.id % 100).alias("k")).count()
    assert written(sums.join(sums.withColumnRenamed("count", "n"), "k"), "sums").count() == 100
    assert spark.conf.get(SPENT) == "false"
    # What ``count`` shuffled is one row a task; files are deleted in the background.
    for _ in range(50):
        if len({name.split("_")[1] for name in kept() - before}) <= 1:
            break
        time.sleep(0.1)
    assert len({name.split("_")[1] for name in kept() - before}) <= 1
