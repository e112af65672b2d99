"""SimHash near-duplicates found through an index of fingerprint bytes by position."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.llm.common import column, components, forest, gathered, majority_bits, one_name, \
    pairs_in, ready, spread, texts, whole_groups
from changeflow.session import written

SHINGLE = 4
MAX_BITS = 4
SEED = 42
BYTES = 8
BLOCK = 1024
WORDS_AT_ONCE = 1 << 20


def fingerprints(values: list[str | None], shingle: int = SHINGLE) -> np.ndarray:
    """The SimHash of each text over its word shingles, repeats included.

    Words are what ASCII white space parts, A-Z lowered. A text of fewer words
    than a shingle is one shingle; one without words gives zero. A bit is set if
    more than half of the shingles' XXH64 values have it.
    """
    out, hashes, sizes, waiting = [], [], [], 0
    for value in values:
        words = (value or "").encode("utf-8", "surrogatepass").lower().split()
        n = max(len(words) - shingle + 1, min(len(words), 1))
        if n <= 1:
            found = [xxhash.xxh64_intdigest(b" ".join(words), SEED)] if words else []
        else:
            text = b" ".join(words)
            ends = np.cumsum(np.fromiter(map(len, words), "i8", len(words)) + 1)
            starts = [0, *ends[:n - 1].tolist()]
            stops = (ends[shingle - 1:] - 1).tolist()
            found = map(xxhash.xxh64_intdigest,
                        [text[a:b] for a, b in zip(starts, stops)], repeat(SEED))
        hashes.append(np.fromiter(found, "<u8", n))
        sizes.append(n)
        waiting += n
        if waiting > WORDS_AT_ONCE:
            out.append(majority_bits(np.concatenate(hashes), np.array(sizes)))
            hashes, sizes, waiting = [], [], 0
    if sizes:
        out.append(majority_bits(np.concatenate(hashes), np.array(sizes)))
    return np.concatenate(out) if out else np.zeros(0, "<u8")


def with_fingerprint(df: DataFrame, text: str, into: str, shingle: int = SHINGLE) -> DataFrame:
    """Add the SimHash of ``text`` as the long ``into`` and drop the text."""
    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = fingerprints(texts(batch, text), shingle)
            yield batch.drop_columns([text]).append_column(into, pa.array(found.view("<i8")))

    schema = df.drop(text).withColumn(into, F.lit(0).cast("bigint")).schema
    return df.mapInArrow(add, schema)


def position_keys(min_shared: int, width: int) -> list[tuple[int, ...]]:
    """Sets of ``width`` byte positions, one of which lies inside any ``min_shared`` positions.

    Positions are dealt to as many groups as force ``width`` of any
    ``min_shared`` into one of them: the sets inside the groups are enough.
    """
    groups = max((min_shared - 1) // (width - 1), 1) if width > 1 else 1
    if width == 1:
        return [(p,) for p in range(BYTES - min_shared + 1)]
    dealt = [range(g, BYTES, groups) for g in range(groups)]
    return [c for group in dealt for c in combinations(group, width)]


def key_width(distinct: int, min_shared: int) -> int:
    """Byte positions of an index key: enough to keep postings of random bytes short."""
    width = 1
    while width < min_shared and distinct > BLOCK << (8 * width):
        width += 1
    return max(width, min(2, min_shared))


def links_of(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links (a, b) that join all fingerprints of ``distinct`` within ``max_bits`` bits.

    Fingerprints that differ in at most k bits share at least 8 - k bytes at
    their positions. Postings list the fingerprints that share some bytes at
    fixed positions; inside a posting the shared positional bytes of each pair
    are counted, pairs below 8 - k are left out, and the rest compared bit by
    bit. Each posting gives a spanning forest of its links, not every pair.
    Long postings are split into pairs of blocks.
    """
    if not 0 <= max_bits < BYTES:
        raise ValueError("the byte index finds distances from 0 to 7 bits")
    min_shared = BYTES - max_bits
    sets = position_keys(min_shared, key_width(distinct.count(), min_shared))
    masks = [sum(0xFF << (8 * p) for p in s) for s in sets]
    signed = [m - (1 << 64) if m >= 1 << 63 else m for m in masks]
    postings = distinct.select("fp", F.posexplode(F.array(*[
        F.col("fp").bitwiseAND(F.lit(m)) for m in signed])).alias("positions", "bytes"))
    keys = ["positions", "bytes", "lo", "hi"]
    dealt = gathered(spread(postings, ["positions", "bytes"], "fp", BLOCK), keys)

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in whole_groups(batches, keys):
            fps = column(table, "fp").astype("<i8").view("<u8")
            mine = column(table, "mine")
            crossing = column(table, "lo") != column(table, "hi")
            found = []
            for i, j in pairs_in(starts, table.num_rows):
                differ = fps[i] ^ fps[j]
                shared = (differ.view("u1").reshape(-1, BYTES) == 0).sum(axis=1, dtype="u1")
                ok = (shared >= min_shared) & (~crossing[i] | (mine[i] != mine[j]))
                i, j, differ = i[ok], j[ok], differ[ok]
                near = np.bitwise_count(differ) <= max_bits
                if near.any():
                    found.append(forest(fps[i[near]].view("<i8"), fps[j[near]].view("<i8")))
            if found:
                a, b = forest(*map(np.concatenate, zip(*found)))
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return dealt.select("fp", "mine", *keys).mapInArrow(search, "a bigint, b bigint")


def near_duplicates(spark: SparkSession, docs: DataFrame, ident: str = "doc_id",
                    text: str = "text", shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """(ident, fingerprint, component_id) for every row of ``docs``.

    Rows whose fingerprints differ in at most ``max_bits`` bits are linked;
    ``component_id`` is the smallest ident that links reach. Equal fingerprints
    are put together first, so copies cost no pairs. A null or empty text, or
    one of white space only, has fingerprint zero and is linked like any other;
    a repeated row gets the same result each time. A null ident is never the
    smallest: it stands only where a component has no other. Other columns are
    left aside; an empty table gives no rows.
    """
    groups = _groups(spark, docs, ident, text, shingle, max_bits)
    return groups.select(F.col("ident").alias(ident),
                         F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                         F.col("head.ident").alias("component_id"))


def one_of_each(spark: SparkSession, docs: DataFrame, ident: str = "doc_id", text: str = "text",
                shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` with one document of each near-duplicate group.

    The one with the smallest ident stays, null idents last; if rows with that
    ident have different texts, the one whose text has the smallest hash. Of rows
    that agree in ident and text, one stays. All columns are kept.
    """
    key = one_name(docs, "key")
    kept = _groups(spark, docs, ident, text, shingle, max_bits) \
        .select("head").distinct() \
        .select(F.struct("head.ident", "head.text_hash").alias(key))
    keyed = docs.withColumn(key, F.struct(F.col(ident).alias("ident"),
                                          _text_hash(text).alias("text_hash")))
    return keyed.join(kept, key, "left_semi").dropDuplicates([key]).drop(key)


def _text_hash(text: str) -> Column:
    return F.xxhash64(F.col(text), F.col(text).isNull())


def _groups(spark: SparkSession, docs: DataFrame, ident: str, text: str, shingle: int,
            max_bits: int) -> DataFrame:
    """Each row's ident, fp, and its group's ``head``: (no ident, ident, text_hash)."""
    ready(spark)
    small = docs.select(F.col(ident).alias("ident"), _text_hash(text).alias("text_hash"),
                        F.col(text).alias("text"))
    rows = written(with_fingerprint(small, "text", "fp", shingle), "fingerprints")
    who = F.struct(F.col("ident").isNull().alias("unnamed"), "ident", "text_hash")
    distinct = written(rows.groupBy("fp").agg(F.min(who).alias("first")), "distinct")
    roots = components(links_of(distinct.select("fp"), max_bits))
    known = written(distinct.join(roots, distinct["fp"] == roots["node"], "left")
                    .select("fp", "first", F.coalesce("root", "fp").alias("root")), "roots")
    heads = known.groupBy("root").agg(F.min("first").alias("head"))
    return rows.join(known.join(heads, "root").select("fp", "head"), "fp") \
        .select("ident", "fp", "head")
