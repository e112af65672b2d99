import hashlib
import json
import random
import struct
from itertools import product

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from changeflow.llm import bpe
from changeflow.llm.bpe import Bpe, load, token_digests, tokenize

PATH = public_tokenizers.path("byte_bpe_50k.json")
LETTERS = [*"aab  '\n\t\r\x0b\x0c\x1c\x1d\x1f\x00eus vtrdl.,!?-_12", "\x85", "\xa0", "é", "ü",
           *map(chr, (0x1680, 0x180E, 0x2003, 0x200B, 0x200D, 0x2028, 0x202F, 0x3000, 0xFEFF, 0x301,
                      0x6F22, 0x663, 0xB2, 0x2177, 0x1F600, 0x1D4D0)),
           "<|endoftext|>", "<|endoftext", "'ll", "'ve", "'S", "aaaaaaaa", "   ", " the", " of"]


@pytest.fixture(scope="module")
def theirs():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@pytest.fixture(scope="module")
def ours():
    return load(open(PATH, encoding="utf-8").read())


def test_random_texts(ours, theirs):
    seed = random.Random(3)
    for _ in range(20_000):
        text = "".join(seed.choices(LETTERS, k=seed.randrange(30)))
        want = theirs.encode(text, add_special_tokens=False).ids
        assert ours.encode(text).tolist() == want, text
        assert ours.decode(want) == theirs.decode(want, skip_special_tokens=False), text


def test_random_ids(ours, theirs):
    seed = random.Random(4)
    for _ in range(2000):
        ids = [seed.randrange(50_257) for _ in range(seed.randrange(10))]
        assert ours.decode(ids) == theirs.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("text", ["a" * 60_000, " " * 60_000, "the" * 20_000, "-" * 60_000])
def test_long_pieces(ours, theirs, text):
    assert ours.encode(text).tolist() == theirs.encode(text, add_special_tokens=False).ids


def test_small_merges():
    # Equal pairs merge from the left; a later merge of the whole can be cut off by an earlier one.
    vocabulary = {c: i for i, c in enumerate("abc")} | {"aa": 3, "ab": 4, "aab": 5, "bc": 6, "abc": 7}
    merges = ["a a", "a b", "a ab", "b c", "ab c"]
    level = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True,
             "use_regex": True}
    spec = {"added_tokens": [], "normalizer": None, "decoder": level, "pre_tokenizer": level,
            "model": {"type": "BPE", "vocab": vocabulary, "merges": merges}}
    ours, theirs = Bpe(json.dumps(spec)), Tokenizer.from_str(json.dumps(spec))
    for n in range(1, 9):
        for text in map("".join, product("abc", repeat=n)):
            assert ours.encode(text).tolist() == theirs.encode(text).ids, text


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        load(open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8").read())


def test_tables(spark, sf_dir, theirs):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = {r["doc_id"]: r for r in token_digests(spark, docs, PATH).collect()}
    rows = docs.collect()
    assert len(got) == len(rows)
    for row in rows:
        ids = theirs.encode(row["text"], add_special_tokens=False).ids
        text = theirs.decode(ids, skip_special_tokens=False)
        assert tuple(got[row["doc_id"]]) == (
            row["doc_id"], len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(),
            hashlib.sha256(text.encode()).hexdigest())


def test_odd_rows(spark):
    rows = [(1, None, "a", 5), (None, "", "b", 6), (3, "Hi <|endoftext|>!", None, 7),
            (3, "Hi <|endoftext|>!", None, 7)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, IDS string, read int")
    got = tokenize(spark, table, PATH)
    assert got.columns == ["doc_id", "text", "read", "ids", "decoded"]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, [
        (1, None, 5, [], ""), (None, "", 6, [], ""),
        *[(3, "Hi <|endoftext|>!", 7, [17250, 220, 50256, 0], "Hi <|endoftext|>!")] * 2]))
    empty = hashlib.sha256(b"").hexdigest()
    assert [tuple(r) for r in token_digests(spark, table.limit(1), PATH).collect()] == [
        (1, 0, empty, empty)]
    assert tokenize(spark, table.limit(0), PATH).collect() == []
    assert tokenize(spark, table, PATH, text="IDS").where("doc_id = 1").first()["decoded"] == "a"


def test_many_ids_are_decoded_like_each_alone(ours):
    seed = random.Random(6)
    found = [np.array([seed.randrange(50_257) for _ in range(seed.randrange(8))], "<u4")
             for _ in range(300)]
    smile = ours.encode("\U0001f600")
    assert len(smile) > 1
    whole = [ours.encode("caf\u00e9 " * n) for n in range(5)]
    for some in (found, whole, [smile[:1], smile[1:]], [smile, smile[:0]], [smile[:0]], []):
        assert ours.decode_many(some).to_pylist() == [ours.decode(ids.tolist()) for ids in some]


def test_common_chunks_outlive_rare_ones(ours, monkeypatch):
    """Each piece of a word that comes again and again is found once, whatever comes between."""
    monkeypatch.setattr(bpe, "CACHED", 10)
    monkeypatch.setattr(ours, "known", bpe._Chunks(ours))
    made = []
    monkeypatch.setattr(ours, "piece", lambda raw, of=ours.piece: (made.append(raw), of(raw))[1])
    text = " ".join(f"common rare{n}" for n in "abcdefghijklmnopqrstuvwxyz")
    ours.encode(text)
    assert made.count(" common") == 1 and made.count(" rarez") == 1
    assert len(ours.known) <= 10 and len(ours.known.older) <= 10
