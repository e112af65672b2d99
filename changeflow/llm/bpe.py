"""BPE encoding by one last token for each prefix, and decoding."""

from __future__ import annotations

import hashlib
import json
import re
import struct
from collections.abc import Iterable, Iterator
from pathlib import Path

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.llm.common import one_name, ready, slices, texts

# How byte-level BPE cuts a text before it merges, the characters
# that are white space to it, and the bytes that stand for themselves in a vocabulary.
CUT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPACE = "\t-\r \x85\xa0" + "".join(map(chr, (
    0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
PRINTED = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]

CACHED = 1 << 17  # recent chunks and pieces a worker remembers, and as many older ones, 200 bytes each
FOREVER = 1 << 62


class Bpe:
    """A byte-level BPE of the ``tokenizers`` file format."""

    def __init__(self, source: str) -> None:
        spec = json.loads(source)
        self._check(spec)
        letters = _letters()
        vocabulary = {name: i for name, i in spec["model"]["vocab"].items()}
        self.bytes_of: dict[int, bytes] = {
            i: bytes(letters[c] for c in name) for name, i in vocabulary.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for name, i in self.special.items():
            self.bytes_of[i] = b"".join(
                bytes([letters[c]]) if c in letters else c.encode() for c in name)
        self.born = dict.fromkeys(self.bytes_of, -1)
        self.halves: dict[int, tuple[int, int]] = {}
        self.rank: dict[tuple[int, int], int] = {}
        for rank, merge in enumerate(spec["model"]["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            pair, token = (vocabulary[left], vocabulary[right]), vocabulary[left + right]
            self.rank[pair] = rank
            if token not in self.halves:
                self.halves[token], self.born[token] = pair, rank
        self.fits: list[dict[int, bool]] = []  # for each token those looked at before it
        self.fits_known = 0
        self.suffixes = ahocorasick.Automaton()
        for token in self._whole(set(vocabulary.values()) - set(self.special.values())):
            raw = self.bytes_of[token]
            self.fits.append({})
            self.suffixes.add_word(raw.decode("latin-1"), (token, len(raw), self.fits[-1]))
        self.suffixes.make_automaton()
        self.table = [self.bytes_of.get(i, b"") for i in range(max(self.bytes_of) + 1)]
        self.pieces = pa.array(self.table, pa.binary())
        names = sorted(map(re.escape, self.special), key=len, reverse=True)
        self.specials = re.compile(f"({'|'.join(names)})") if names else None
        self.chunks = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
        self.cut = regex.compile(CUT.replace(r"[^\s", f"[^{SPACE}").replace(
            r"\s", f"[{SPACE}]").replace(r"\S", f"[^{SPACE}]"))
        self.known = _Chunks(self)

    @staticmethod
    def _check(spec: dict) -> None:
        cut, model = spec.get("pre_tokenizer") or {}, spec["model"]
        plain = cut.get("type") == "ByteLevel" and not cut.get("add_prefix_space") \
            and cut.get("use_regex", True) and not spec.get("normalizer") \
            and not model.get("ignore_merges") and not model.get("dropout") \
            and not any(t.get(k) for t in spec["added_tokens"]
                        for k in ("single_word", "lstrip", "rstrip"))
        if not plain or (spec.get("decoder") or {}).get("type") != "ByteLevel":
            raise ValueError("not a plain byte-level BPE")

    def _whole(self, tokens: set[int]) -> list[int]:
        """The tokens that encoding their own bytes gives back."""
        whole: set[int] = set()
        for token in sorted(tokens, key=lambda t: self.born[t]):
            if token not in self.halves:
                if len(self.bytes_of[token]) == 1:
                    whole.add(token)
                continue
            left, right = self.halves[token]
            if left in whole and right in whole and self._apart(left, right, self.born[token]):
                whole.add(token)
        return sorted(whole)

    def _apart(self, left: int, right: int, until: int = FOREVER) -> bool:
        """Whether no merge joins the two tokens across their border before ``until``.

        Time runs in merge ranks. Going back from the finished tokens, the border
        lies between ever smaller pieces: each piece lives from its own merge to
        that of the piece it went into. The pieces at the border join if their
        pair's turn comes while both live. Equal pairs merge from left to right,
        so the left piece's own merge goes first, and the right one's comes late.
        """
        left_ends = right_ends = until
        while True:
            turn = self.rank.get((left, right))
            if turn is not None and turn < left_ends \
                    and (turn <= right_ends if right_ends < until else turn < until):
                return False
            if self.born[left] < 0 and self.born[right] < 0:
                return True
            if self.born[left] > self.born[right]:
                left_ends, left = self.born[left], self.halves[left][1]
            else:
                right_ends, right = self.born[right], self.halves[right][0]

    def piece(self, raw: str) -> list[int]:
        """The ids of one piece (bytes as latin-1 text).

        Every prefix has exactly one valid encoding. Its last token is the suffix
        match that fits the last token of the prefix before it; following these
        tokens back from the end gives the encoding.
        """
        last = [-1] * (len(raw) + 1)
        back = [0] * (len(raw) + 1)
        for end, (token, size, fit) in self.suffixes.iter(raw):
            end += 1
            if last[end] >= 0:
                continue
            start = end - size
            if start:
                before = last[start]
                if before < 0:
                    continue
                ok = fit.get(before)
                if ok is None:
                    ok = fit[before] = self._apart(before, token)
                    self.fits_known += 1
                if not ok:
                    continue
            last[end], back[end] = token, start
        if self.fits_known > 2 * CACHED:
            self.fits_known = 0
            for fit in self.fits:
                fit.clear()
        ids, end = [], len(raw)
        while end:
            ids.append(last[end])
            end = back[end]
        return ids[::-1]

    def encode(self, text: str) -> np.ndarray:
        """The ids of a text; special tokens' names in it are those tokens."""
        get = self.known.__getitem__
        if self.specials is None:
            return np.frombuffer(b"".join(map(get, self.chunks.findall(text))), "<u4")
        parts = []
        for part in self.specials.split(text):
            if part in self.special:
                parts.append(self.special[part].to_bytes(4, "little"))
            else:
                parts.extend(map(get, self.chunks.findall(part)))
        return np.frombuffer(b"".join(parts), "<u4")

    def decode(self, ids: Iterable[int]) -> str:
        """The text of ids; bytes that are no UTF-8 become U+FFFD."""
        return b"".join(map(self.table.__getitem__, ids)).decode("utf-8", "replace")

    def decode_many(self, found: list[np.ndarray]) -> pa.Array:
        """The text of each array of ids, as ``decode`` has it."""
        ends = np.cumsum([0, *map(len, found)])
        if not ends[-1]:
            return pa.array([""] * len(found), pa.string())
        joined = self.pieces.take(pa.array(np.concatenate(found)))
        _, starts, data = joined.buffers()
        starts = np.frombuffer(starts, "<i4")[ends]
        out = pa.StringArray.from_buffers(len(found), pa.py_buffer(starts), data)
        try:
            out.validate(full=True)
        except pa.ArrowInvalid:  # not all of it is UTF-8
            out = pa.array([self.decode(ids.tolist()) for ids in found], pa.string())
        return out


class _Chunks(dict):
    """The ids, as bytes, of recent chunks (a word with the blank before it) and pieces.

    When there are too many, they become the ``older`` ones, of which those that come again
    are kept; so a text of rare words does not push out the common ones.
    """

    def __init__(self, bpe: Bpe) -> None:
        self.bpe = bpe
        self.older: dict[str, bytes] = {}

    def __missing__(self, chunk: str) -> bytes:
        found = self.older.get(chunk)
        if found is None:
            found = self._made(chunk)
        if len(chunk) <= 64:
            if len(self) >= CACHED:
                self.older = self.copy()
                self.clear()
            self[chunk] = found
        return found

    def _made(self, chunk: str) -> bytes:
        if chunk.isascii() and (chunk[1:] if chunk[0] == " " else chunk).isalpha():
            ids = self.bpe.piece(chunk)  # one word, whose letters are its bytes
        else:
            pieces = self.bpe.cut.findall(chunk)
            if len(pieces) > 1:
                return b"".join([self[piece] for piece in pieces])
            ids = self.bpe.piece(chunk.encode().decode("latin-1"))
        return struct.pack(f"<{len(ids)}I", *ids)


def _letters() -> dict[str, int]:
    """The byte for each letter of a byte-level vocabulary."""
    others = [b for b in range(256) if b not in PRINTED]
    return {chr(b): b for b in PRINTED} | {chr(256 + n): b for n, b in enumerate(others)}


_loaded: dict[str, Bpe] = {}


def load(source: str) -> Bpe:
    """The encoder for a tokenizer file's text, built once in a process."""
    mark = hashlib.sha256(source.encode()).hexdigest()
    if mark not in _loaded:
        _loaded[mark] = Bpe(source)
    return _loaded[mark]


def tokenize(spark: SparkSession, docs: DataFrame, tokenizer: str, text: str = "text",
             ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``docs`` with the token ids (array<int>) and the text decoded from them.

    ``tokenizer`` is the path of a tokenizer file on the driver; its text, of the
    vocabulary's size, is broadcast. Null text counts as empty and gives no ids; a
    text of any length is encoded whole, in time linear in its length. Columns
    named like the new ones are replaced. Repeated rows are encoded alike; an
    empty table gives no rows.
    """
    return _mapped(spark, docs, tokenizer, text, [(ids, pa.list_(pa.int32()), "array<int>"),
                                                  (decoded, pa.string(), "string")], _full)


def token_digests(spark: SparkSession, docs: DataFrame, tokenizer: str, text: str = "text",
                  keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` with n_tokens and the SHA-256 of the ids (little-endian unsigned
    32-bit) and of the text decoded from them, computed where the ids are."""
    return _mapped(spark, docs.select(*keep, text), tokenizer, text, [
        ("n_tokens", pa.int64(), "bigint"), ("ids_sha256", pa.string(), "string"),
        ("decoded_sha256", pa.string(), "string")], _digests).select(
            *keep, "n_tokens", "ids_sha256", "decoded_sha256")


def _full(bpe: Bpe, values: list) -> list[pa.Array]:
    found = [bpe.encode(v or "") for v in values]
    offsets = np.concatenate([[0], np.cumsum([len(f) for f in found])]).astype("i4")
    flat = np.concatenate(found).astype("i4") if found else np.zeros(0, "i4")
    return [pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
            bpe.decode_many(found)]


def _digests(bpe: Bpe, values: list) -> list[pa.Array]:
    found = [bpe.encode(value or "") for value in values]
    ids = [hashlib.sha256(f.tobytes()).hexdigest() for f in found]
    decoded = [hashlib.sha256(text.encode()).hexdigest() for text in bpe.decode_many(found).to_pylist()]
    return [pa.array(list(map(len, found)), pa.int64()), pa.array(ids, pa.string()),
            pa.array(decoded, pa.string())]


def _mapped(spark: SparkSession, docs: DataFrame, tokenizer: str, text: str, made: list,
            work) -> DataFrame:
    ready(spark)
    source = spark.sparkContext.broadcast(Path(tokenizer).read_text(encoding="utf-8"))
    new = {name.lower() for name, _, _ in made}
    kept = [c for c in docs.columns if c.lower() not in new]
    reads = one_name(docs, "read")
    schema = docs.select(*kept).withColumns(
        {name: F.lit(None).cast(kind) for name, _, kind in made}).schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(source.value)
        for batch in batches:
            for rows in slices(batch):
                out = rows.drop_columns([reads])
                for (name, kind, _), values in zip(made, work(bpe, texts(rows, reads))):
                    out = out.append_column(pa.field(name, kind), values)
                yield out

    return docs.select(*kept, F.col(text).alias(reads)).mapInArrow(run, schema)
