"""Embedding near-duplicates by randomised-rotation binary codes."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.llm.common import column, components, forest, gathered, pairs_in, ready, spread, \
    whole_groups
from changeflow.session import written

AT_LEAST = 0.95
SEED = 20_240
MISS = 1e-4  # chance that a pair right at the threshold shares no key
DEVIATIONS = 7.0  # of an estimate; beyond them an exact value is not looked at
SPARE_BITS = 4  # key bits beyond the logarithm of the number of vectors
BLOCK = 1024


def tables_for(vectors: int, at_least: float = AT_LEAST, miss: float = MISS) -> tuple[int, int]:
    """(bits of a key, number of keys) for so many vectors.

    A key has a few bits more than it takes to number the vectors, so that chance
    meetings stay in proportion to their number. Two vectors at cosine c agree in
    a bit with chance 1 - acos(c) / pi; there are as many keys as a pair at the
    threshold needs to share one but for the chance ``miss``.
    """
    bits = min(max(math.ceil(math.log2(max(vectors, 2))) + SPARE_BITS, 8), 60)
    together = (1 - math.acos(at_least) / math.pi) ** bits
    if together >= 1:
        return bits, 1
    return bits, max(math.ceil(math.log(miss) / math.log1p(-together)), 1)


@lru_cache(maxsize=64)
def rotation(size: int, number: int) -> np.ndarray:
    """The ``number``-th random rotation of a space, the same in every process."""
    noise = np.random.default_rng([SEED, size, number]).standard_normal((size, size))
    q, r = np.linalg.qr(noise)
    return q * np.where(np.diag(r) < 0, -1.0, 1.0)


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one; they are scaled first, so that no square overflows."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt(np.einsum("ij,ij->i", scaled, scaled))[:, None]


def codes(vectors: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Packed signs of as many rotations as give ``bits`` bits, and correction factors.

    The factor is the inner product of a unit vector with its first code, read as
    the corners (+-1, ..., +-1) / sqrt(size) of a cube.
    """
    size = vectors.shape[1]
    rows, signs, factor = unit(vectors), [], None
    for number in range(-(-bits // size)):
        turned = rows @ rotation(size, number)
        if factor is None:
            factor = np.abs(turned).sum(axis=1) / math.sqrt(size)
        signs.append(turned > 0)
    return np.packbits(np.concatenate(signs, axis=1), axis=1), factor


def keys_of(packed: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """The keys (row, table) that the first bits of packed codes make."""
    flags = np.unpackbits(packed, axis=1, count=bits * tables)
    return flags.reshape(len(packed), tables, bits) @ (1 << np.arange(bits, dtype="i8"))


def estimates(code: np.ndarray, factor: np.ndarray, turned: np.ndarray) -> np.ndarray:
    """Unbiased estimates of cosines from first codes (as signs) of one side and the
    rotated unit vectors of the other."""
    return np.einsum("ij,ij->i", code, turned) / (factor * math.sqrt(code.shape[1]))


def lowest_estimate(factor: np.ndarray, size: int, at_least: float) -> np.ndarray:
    """What the estimate of a pair at ``at_least`` or more does not fall below.

    The estimate errs by sqrt(1 - c^2) * sqrt(1 - f^2) / f times a coordinate of a
    random direction in size - 1 dimensions, whose deviation is 1 / sqrt(size - 1).
    """
    if size < 3:
        return np.full(len(factor), -np.inf)
    spread_of = np.sqrt(np.clip(1 - factor ** 2, 0, None)) / factor
    return at_least - math.sqrt(1 - at_least ** 2) * spread_of * DEVIATIONS / math.sqrt(size - 1)


def usable(vector: Column) -> Column:
    """Whether a vector has only finite components, and not only zeros."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x)
                      & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def near_vectors(spark: SparkSession, vectors: DataFrame, ident: str = "vec_id",
                 vector: str = "embedding", at_least: float = AT_LEAST,
                 miss: float = MISS) -> DataFrame:
    """(ident, n_links, component_id, kept) for every row of ``vectors``.

    Rows whose cosine in double precision is ``at_least`` or more are linked.
    Equal vectors are put together first. Each different vector is stored with
    the signs of random rotations and a correction factor. Runs of sign bits are
    keys; vectors that share one are compared, in the first such key only: an
    unbiased estimate from code and factor with its confidence bound decides
    which cosines are computed exactly. Long lists are split into pairs of
    blocks. A task returns counts and a spanning forest of its links, not pairs.

    A vector that is null, empty, zero or has a null or non-finite component
    links with nothing: n_links 0 and its own component. Vectors of different
    sizes are never linked. ``component_id`` is the smallest ident that links
    reach, null idents left aside; ``kept`` tells whether it is the row's own. A
    repeated row is a further vector. Other columns are left aside; an empty
    table gives no rows.
    """
    ready(spark)
    rows = vectors.select(F.col(ident).alias("ident"), F.col(vector).alias("vector")) \
        .withColumn("ok", usable(F.col("vector")))
    # Two independent 64-bit hashes stand for the vector where rows are matched.
    marks = {"h1": F.xxhash64("vector"), "h2": F.xxhash64(F.lit(1), "vector")}
    members = rows.select("ident", "ok", *[m.alias(n) for n, m in marks.items()])
    classes = written(
        rows.where("ok").select("ident", F.col("vector").cast("array<double>").alias("vector"),
                                *[m.alias(n) for n, m in marks.items()])
        .groupBy("h1", "h2").agg(F.first("vector").alias("vector"), F.min("ident").alias("first"),
                                 F.count(F.lit(1)).alias("copies"))
        .withColumn("cid", F.monotonically_increasing_id()), "vectors")
    bits, tables = tables_for(classes.count(), at_least, miss)
    stored = written(_with_codes(classes.select("cid", "copies", "vector"), bits * tables), "codes")
    found = written(_search(_lists(stored, bits, tables), bits, tables, at_least), "found")
    links = found.where("b IS NOT NULL").select("a", "b")
    counts = found.where("b IS NULL").groupBy(F.col("a").alias("cid")).agg(
        F.sum("n").alias("links"))
    roots = components(links)
    known = written(classes.select("h1", "h2", "cid", "first", "copies")
                    .join(counts, "cid", "left")
                    .join(roots, F.col("cid") == F.col("node"), "left")
                    .withColumn("root", F.coalesce("root", "cid"))
                    .select("h1", "h2", "root", "first",
                            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")),
                    "classes")
    heads = known.groupBy("root").agg(F.min("first").alias("component_id"))
    named = known.join(heads, "root").select("h1", "h2", "n_links", "component_id",
                                             F.lit(True).alias("ok"))
    result = members.join(named, ["h1", "h2", "ok"], "left")
    component = F.when(F.col("ok"), F.col("component_id")).otherwise(F.col("ident"))
    return result.select(
        F.col("ident").alias(ident), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"), component.eqNullSafe(F.col("ident")).alias("kept"))


def _matrix(table: pa.Table | pa.RecordBatch, rows: np.ndarray) -> np.ndarray:
    """The vectors, all of one size, of the given rows."""
    lists = table.column("vector")
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    return lists.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False) \
        .reshape(len(rows), -1).astype("f8")


def _sizes(table: pa.Table | pa.RecordBatch) -> np.ndarray:
    lists = table.column("vector")
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    return np.diff(lists.offsets.to_numpy())


def _with_codes(classes: DataFrame, bits: int) -> DataFrame:
    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = _sizes(batch)
            for size in np.unique(sizes):
                rows = np.flatnonzero(sizes == size)
                packed, factor = codes(_matrix(batch, rows), bits)
                out = batch.take(pa.array(rows))
                yield out.append_column("code", pa.array([p.tobytes() for p in packed], pa.binary())) \
                    .append_column("factor", pa.array(factor))

    schema = classes.withColumns({"code": F.lit(b""), "factor": F.lit(0.0)}).schema
    return classes.mapInArrow(encode, schema)


def _packed(table: pa.Table | pa.RecordBatch, rows: np.ndarray) -> np.ndarray:
    codes_of = table.column("code")
    codes_of = codes_of.combine_chunks() if isinstance(codes_of, pa.ChunkedArray) else codes_of
    taken = codes_of.take(pa.array(rows)).to_pylist()
    return np.frombuffer(b"".join(taken), "u1").reshape(len(rows), -1)


def _lists(stored: DataFrame, bits: int, tables: int) -> DataFrame:
    """The vectors of every key that two or more share, dealt to pairs of blocks."""
    def keys(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cids = batch.column("cid").to_numpy(zero_copy_only=False)
            sizes = batch.column("size").to_numpy(zero_copy_only=False)
            for size in np.unique(sizes):
                rows = np.flatnonzero(sizes == size)
                made = keys_of(_packed(batch, rows), bits, tables)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.repeat(cids[rows], tables)),
                    pa.array(np.full(len(rows) * tables, size, "i4")),
                    pa.array(np.tile(np.arange(tables, dtype="i4"), len(rows))),
                    pa.array(made.reshape(-1))], ["cid", "size", "number", "key"])

    listed = stored.select("cid", "code", F.size("vector").alias("size")) \
        .mapInArrow(keys, "cid bigint, size int, number int, key bigint")
    return spread(listed, ["size", "number", "key"], "cid", BLOCK).join(stored, "cid")


def _search(lists: DataFrame, bits: int, tables: int, at_least: float) -> DataFrame:
    """Rows (a, null, n): vector a has n more links; and rows (a, b, 0): a and b belong together."""
    keys = ["size", "number", "key", "lo", "hi"]

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in whole_groups(batches, keys, 1 << 12):
            sizes = column(table, "size")
            for size in np.unique(sizes):  # sorted: rows of a size follow each other
                first, last = np.searchsorted(sizes, [size, size + 1])
                own = starts[(starts >= first) & (starts < last)] - first
                a, b, n = _links(table.slice(first, last - first), own, size)
                yield pa.RecordBatch.from_arrays([
                    pa.array(a), pa.array(b, mask=b < 0), pa.array(n)], ["a", "b", "n"])

    def _links(table: pa.Table, starts: np.ndarray, size: int):
        rows = np.arange(table.num_rows)
        vectors = unit(_matrix(table, rows))
        packed, factor = _packed(table, rows), column(table, "factor")
        turned = (vectors @ rotation(size, 0)).astype("f4")
        code = np.where(np.unpackbits(packed, axis=1, count=size), 1, -1).astype("f4")
        own_keys = keys_of(packed, bits, tables)
        lowest = lowest_estimate(factor, size, at_least)
        cids, copies = column(table, "cid"), column(table, "copies")
        number, mine = column(table, "number"), column(table, "mine")
        crossing = column(table, "lo") != column(table, "hi")
        degree, left, right = np.zeros(len(rows), "i8"), [], []
        for i, j in pairs_in(starts, len(rows), 1 << 18):
            ok = ~crossing[i] | (mine[i] != mine[j])
            i, j = i[ok], j[ok]
            i, j = _first_meetings(i, j, number, own_keys)
            near = estimates(code[i], factor[i], turned[j]) >= lowest[i] - 1e-5
            i, j = i[near], j[near]
            exact = np.einsum("ij,ij->i", vectors[i], vectors[j]) >= at_least
            i, j = i[exact], j[exact]
            np.add.at(degree, i, copies[j])
            np.add.at(degree, j, copies[i])
            a, b = forest(cids[i], cids[j])
            left.append(a)
            right.append(b)
        joined = forest(np.concatenate(left), np.concatenate(right)) if left else (cids[:0],) * 2
        linked = np.flatnonzero(degree)
        return (np.concatenate([cids[linked], joined[0]]),
                np.concatenate([np.full(len(linked), -1), joined[1]]),
                np.concatenate([degree[linked], np.zeros(len(joined[0]), "i8")]))

    return lists.select("cid", "copies", "vector", "code", "factor", "mine", *keys) \
        .transform(lambda df: gathered(df, keys)).mapInArrow(search, "a bigint, b bigint, n bigint")


def _first_meetings(i: np.ndarray, j: np.ndarray, number: np.ndarray,
                    own_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs that share no key of an earlier table than the one they meet in."""
    for earlier in range(int(number[i].max()) if len(i) else 0):
        new = (number[i] <= earlier) | (own_keys[i, earlier] != own_keys[j, earlier])
        i, j = i[new], j[new]
    return i, j
