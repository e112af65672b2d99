"""Secret scans: keywords first, anchored patterns at their places, then built-in checksums."""

from __future__ import annotations

import base64
import binascii
import json
import re
import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.llm.common import one_name, ready, texts

# The kinds of secrets, what they look like and their keywords.
DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
ASSIGN = rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = rb"AKIA[A-Z0-9]+"
HEX = rb"[0-9a-f]+"
GITHUB = rb"gh[pousr]_[0-9A-Za-z]{36}(?![0-9A-Za-z])"
NPM = rb"npm_[0-9A-Za-z]{36}(?![0-9A-Za-z])"
JWT = rb"eyJ[0-9A-Za-z_-]+\.eyJ[0-9A-Za-z_-]+\.[0-9A-Za-z_-]*"
BODY = rb"(?:(?!-----BEGIN )[\s0-9A-Za-z+/=,:-])"
PEM = rb"-----BEGIN [A-Z0-9 ]*PRIVATE KEY-----" + BODY + rb"*?-----END [A-Z0-9 ]*PRIVATE KEY-----"
# What the last two have looked through where they fail.
JWT_RUN = rb"eyJ(?:[0-9A-Za-z_-]+(?:\.eyJ[0-9A-Za-z_-]*)?)?"
PEM_RUN = rb"-----BEGIN [A-Z0-9 ]*PRIVATE KEY-----" + BODY + rb"*"
LONGEST_RUN = 24  # hex digits that make a secret


def checksum_fits(found: re.Match) -> bool:
    """Whether the last six letters are the CRC-32 of the thirty before, in base 62."""
    body = found.group()[-36:]
    value, letters = zlib.crc32(body[:30]), ""
    for _ in range(6):
        value, digit = divmod(value, 62)
        letters = DIGITS[digit] + letters
    return body[30:] == letters.encode()


def names_algorithm(found: re.Match) -> bool:
    """Whether the token's header is JSON that names its algorithm."""
    header = found.group().split(b".")[0]
    try:
        head = json.loads(base64.urlsafe_b64decode(header + b"=" * (-len(header) % 4)))
    except (ValueError, binascii.Error):
        return False
    return isinstance(head, dict) and isinstance(head.get("alg"), str)


def is_armoured(found: re.Match) -> bool:
    """Whether a key's two labels agree and what is between them, behind headers, is base 64."""
    _, first, body, last, _ = re.split(rb"-----(?:BEGIN|END) ([A-Z0-9 ]*)-----", found.group())
    lines = b"".join(line.strip() for line in body.splitlines() if b":" not in line)
    try:
        return first == last and len(base64.b64decode(lines, validate=True)) > 0
    except binascii.Error:
        return False


@dataclass(frozen=True)
class Kind:
    """A pattern that is tried where one of its keywords (lower case) begins.

    Where it fails after having looked through all of ``run``, no keyword that begins
    inside that run can do better: a later start only sees less of it.
    """

    name: str
    pattern: re.Pattern
    keywords: tuple[str, ...]
    valid: Callable[[re.Match], bool]
    run: re.Pattern | None = None


KINDS = (
    Kind("assign", re.compile(ASSIGN, re.IGNORECASE),
         ("password", "passwd", "secret", "token", "api_key", "apikey"),
         lambda m: len(m.group(2)) >= 6),
    Kind("access", re.compile(ACCESS), ("akia",), lambda m: len(m.group()) >= 20),
    Kind("hex", re.compile(HEX), (), lambda m: len(m.group()) >= LONGEST_RUN),
    Kind("github", re.compile(GITHUB), ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), checksum_fits),
    Kind("npm", re.compile(NPM), ("npm_",), checksum_fits),
    Kind("jwt", re.compile(JWT), ("eyj",), names_algorithm, re.compile(JWT_RUN)),
    Kind("private_key", re.compile(PEM), ("-----begin ",), is_armoured, re.compile(PEM_RUN)),
)
BASE = ("assign", "access", "hex")


class Scanner:
    """Finds the spans of all kinds in a text."""

    def __init__(self) -> None:
        self.keywords = ahocorasick.Automaton()
        for k, kind in enumerate(KINDS):
            for word in kind.keywords:
                self.keywords.add_word(word, (k, len(word)))
        self.keywords.make_automaton()
        # Runs of hex digits have no keyword; their length is what tells them from words.
        self.runs = re.compile(rb"[0-9a-f]{%d,}" % LONGEST_RUN)

    def spans(self, text: str) -> list[tuple[int, int, int]]:
        """(start, end, kind number) in code points, by start, then kind.

        Matches of a kind are the leftmost ones that do not overlap; those that
        fail the kind's test still cover what they matched. What a failed match has
        looked through is not looked at again, so time grows with the text.
        """
        raw = text.encode("utf-8", "replace")
        found, covered = [], [0] * len(KINDS)
        for end, (k, size) in self.keywords.iter(raw.lower().decode("latin-1")):
            start = end + 1 - size
            if start < covered[k]:
                continue
            match = KINDS[k].pattern.match(raw, start)
            if match is None and KINDS[k].run is not None:
                run = KINDS[k].run.match(raw, start)
                covered[k] = run.end() if run else start
            elif match:
                covered[k] = match.end()
                if KINDS[k].valid(match):
                    found.append((start, match.end(), k))
        found += [(m.start(), m.end(), 2) for m in self.runs.finditer(raw)]
        found.sort(key=lambda span: (span[0], span[2]))
        return found if len(raw) == len(text) else list(_points(raw, found))


def _points(raw: bytes, spans: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, int]]:
    """Byte spans as code point spans; each byte is decoded about once."""
    at = point = 0
    for start, end, k in spans:
        point += len(raw[at:start].decode())
        at = start
        yield point, point + len(raw[start:end].decode()), k


_scanner: list[Scanner] = []


def scan(spark: SparkSession, docs: DataFrame, text: str = "text", into: str = "secrets",
         keep_text: bool = True) -> DataFrame:
    """``docs`` with the secrets of each whole text, an array of (kind, start, end).

    Positions are code points, the end exclusive; spans are ordered by start, then
    as ``KINDS`` are listed. A null or empty text has none; repeated rows are scanned
    alike. Texts are scanned whole, in time that grows with their length. A column
    named like the new one is replaced; an empty table gives no rows. Base kinds are kept whatever checksums say; tokens of the
    other kinds only if what is built into them fits: a CRC-32, a header that names its
    algorithm, or labels that agree around base 64.
    """
    ready(spark)
    reads = one_name(docs, "read")
    kept = [c for c in docs.columns if c.lower() != into.lower() and (keep_text or c != text)]
    span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not _scanner:
            _scanner.append(Scanner())
        for batch in batches:
            found = [[{"kind": KINDS[k].name, "start": a, "end": b}
                      for a, b, k in _scanner[0].spans(t or "")] for t in texts(batch, reads)]
            yield batch.drop_columns([reads]).append_column(
                pa.field(into, pa.list_(span)), pa.array(found, pa.list_(span)))

    schema = docs.select(*kept).withColumn(into, F.lit(None).cast(
        "array<struct<kind:string,start:int,end:int>>")).schema
    return docs.select(*kept, F.col(text).alias(reads)).mapInArrow(run, schema)


def written_spans(spans: Column) -> Column:
    """``kind:start:end`` of all spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def span_digests(secrets: DataFrame, spans: str = "secrets") -> DataFrame:
    """Counts of the base kinds, the SHA-256 of their spans, and all spans as text."""
    def of(*names: str) -> Column:
        return F.filter(F.col(spans), lambda s: s["kind"].isin(*names))

    counts = {f"n_{name}": F.size(of(name)).cast("bigint") for name in BASE}
    return secrets.withColumns(counts | {
        "base_sha256": F.sha2(written_spans(of(*BASE)).cast("binary"), 256),
        "spans": written_spans(F.col(spans))})
