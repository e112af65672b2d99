"""What several text operators share: groups of pairs, bit sums, components."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.session import fresh_dir, remove_dir, save, ship_package

WORD_GAP = "[ \\t-\\r]+"  # the white space between words: blank, tab to carriage return
PAIRS_AT_ONCE = 1 << 18
ARROW_BYTES = "8m"
FEW_GROUPS = 1 << 17  # rows of a key and a count that may be broadcast, about 4 MB


def spread(members: DataFrame, keys: list[str], ident: str, block: int,
           groups: int | None = None) -> DataFrame:
    """Members of groups of two or more, dealt to pairs of blocks of their group.

    A group of up to ``block`` members is one task's work. A larger one is cut by
    a hash of ``ident`` into blocks of about that size, and each pair of blocks
    (``lo`` <= ``hi``) becomes a group of its own, so that no task holds more than
    two blocks. ``mine`` is the member's block: where ``lo`` < ``hi``, only pairs
    from different blocks are to be looked at. If there can be no more than
    ``groups`` groups and that is few, their sizes are broadcast.
    """
    sizes = members.groupBy(*keys).agg(F.count(F.lit(1)).alias("members")) \
        .where(F.col("members") > 1)
    if groups is not None and groups <= FEW_GROUPS:
        sizes = F.broadcast(sizes)
    blocks = F.ceil(F.col("members") / block)
    dealt = members.join(sizes, keys).withColumn("mine", F.pmod(F.xxhash64(ident), blocks)
                                                 .cast("int"))
    other = F.explode(F.sequence(F.lit(0), (blocks - 1).cast("int")))
    return dealt.withColumn("other", other).withColumns({
        "lo": F.least("mine", "other"), "hi": F.greatest("mine", "other"),
    }).drop("other", "members")


def gathered(df: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of each key next to each other in one partition."""
    return df.repartition(*keys).sortWithinPartitions(*keys)


def whole_groups(batches: Iterable[pa.RecordBatch], keys: list[str],
                 rows: int = 1 << 13) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of complete groups of a gathered partition, with the groups' starts.

    Groups are collected until there are about ``rows`` rows; a group that spans
    batches is put together first.
    """
    held, count = [], 0
    for batch in batches:
        if batch.num_rows == 0:
            continue
        held.append(batch)
        count += batch.num_rows
        if count < rows:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        starts = group_starts(table, keys)
        last = int(starts[-1])
        if last == 0:
            held = table.to_batches()
            rows = max(rows, 2 * count)  # look again when the group has doubled
            continue
        yield table.slice(0, last), starts[:-1]
        held = [b for b in table.slice(last).to_batches()]
        count = table.num_rows - last
    if held:
        table = pa.Table.from_batches(held).combine_chunks()
        yield table, group_starts(table, keys)


def group_starts(table: pa.Table, keys: list[str]) -> np.ndarray:
    """Where a row's key differs from the row before."""
    change = np.zeros(table.num_rows, dtype=bool)
    change[:1] = True
    for key in keys:
        values = column(table, key)
        change[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(change)


def column(table: pa.Table, name: str) -> np.ndarray:
    """A column without nulls as a numpy array."""
    return table.column(name).combine_chunks().to_numpy(zero_copy_only=False)


def pairs_in(starts: np.ndarray, total: int,
             most: int = PAIRS_AT_ONCE) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers (i < j) of all pairs inside the groups, about ``most`` at once."""
    if total == 0:
        return
    ends = np.append(starts[1:], total)
    after = np.repeat(ends, ends - starts) - np.arange(total) - 1  # partners behind each row
    done = np.concatenate([[0], np.cumsum(after)])
    row = 0
    while row < total:
        until = max(int(np.searchsorted(done, done[row] + most, side="right")) - 1, row + 1)
        n = after[row:until]
        i = np.repeat(np.arange(row, until), n)
        j = i + 1 + np.arange(len(i)) - np.repeat(done[row:until] - done[row], n)
        if len(i):
            yield i, j
        row = until


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, root) that join the same nodes as the links (a, b), fewer of them."""
    if len(a) == 0:
        return a, b
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = at[:len(a)], at[len(a):]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[left], root[right])
        new = root.copy()
        np.minimum.at(new, root[left], low)
        np.minimum.at(new, root[right], low)
        new = new[new]
        if np.array_equal(new, root):
            break
        root = new
    moved = root != np.arange(len(nodes))
    return nodes[moved], nodes[root[moved]]


def components(links: DataFrame, held: list[str] | None = None) -> DataFrame:
    """(node, root) of every node in ``links`` (a, b bigint); root is the smallest reachable.

    Large-star and small-star steps in turn: each node's neighbours move to the
    smallest one, until nothing changes. A step is a combined minimum for each
    node and a join with it, so a node with very many neighbours is spread over
    tasks. Each round is a written table in the shared folder, and goes when the next one
    is there; the path of the last one is added to ``held``, if given, for ``release``.
    """
    spark = links.sparkSession
    now = links.where("a <> b").select(F.greatest("a", "b").alias("a"),
                                       F.least("a", "b").alias("b")).distinct()
    path, before = fresh_dir(spark, "links"), None
    save(now, path)
    now = spark.read.schema("a bigint, b bigint").parquet(path)
    while (mark := _mark(now)) != before:
        before, used = mark, path
        if mark[0] == 0:
            break
        path = fresh_dir(spark, "links")
        save(_small_star(_large_star(now)), path)
        now = spark.read.schema("a bigint, b bigint").parquet(path)
        remove_dir(spark, used)
    if held is not None:
        held.append(path)
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(now.select("b", "b").distinct()).distinct()


def _mark(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")),
                           F.sum(F.pmod(F.xxhash64("b", "a"), F.lit(1 << 31)))).first())


def _large_star(links: DataFrame) -> DataFrame:
    """Move each node's larger neighbours to the smallest of its neighbours and itself."""
    low = links.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
    # A node's larger neighbours are the rows where it is b.
    return links.join(low, links["b"] == low["node"], "left") \
        .select("a", F.least("b", "low").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """Move each node's smaller neighbours, and itself, to the smallest of them."""
    low = links.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
    moved = links.join(low, links["a"] == low["node"]) \
        .where(F.col("b") != F.col("low")).select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.union(low.select("node", "low")).distinct()


# Bit k of a byte as a one in the k-th of eight byte-wide counters.
_COUNTERS = np.array([sum(((byte >> k) & 1) << (8 * k) for k in range(8))
                      for byte in range(256)], dtype="<u8")


def majority_bits(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For each run of hashes the 64 bits that more than half of them have set.

    ``sizes`` are the runs' lengths; an empty run gives zero. Bits are counted
    eight at a time in byte-wide counters, in pieces of at most 255 hashes.
    """
    out = np.zeros(len(sizes), dtype="<u8")
    full = np.flatnonzero(sizes)
    if len(full) == 0:
        return out
    n = sizes[full]
    first = np.concatenate([[0], np.cumsum(n)[:-1]])
    pieces = -(-n // 255)
    piece_of = np.concatenate([[0], np.cumsum(pieces)[:-1]])
    inside = np.arange(pieces.sum()) - np.repeat(piece_of, pieces)
    cuts = np.repeat(first, pieces) + 255 * inside
    octets = hashes.astype("<u8").view("u1").reshape(-1, 8)
    found = np.zeros((len(full), 8), dtype="u1")
    for k in range(8):
        part = np.add.reduceat(_COUNTERS[octets[:, k]], cuts).view("u1").reshape(-1, 8)
        counts = np.add.reduceat(part.astype("i8"), piece_of, axis=0)
        found[:, k] = np.packbits(2 * counts > n[:, None], axis=1, bitorder="little")[:, 0]
    out[full] = found.reshape(-1).view("<u8")
    return out


def ready(spark: SparkSession) -> None:
    """Prepare a session for operators that run Python over whole texts.

    Ships the package, and bounds the bytes of an Arrow batch, since rows of long
    texts make batches of ten thousand rows too large for a worker.
    """
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)


def texts(batch: pa.RecordBatch, name: str) -> list:
    """A string column as Python values."""
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def slices(batch: pa.RecordBatch, rows: int = 256, size: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of at most ``rows`` rows and about ``size`` bytes.

    A row larger than that is a piece of its own.
    """
    step = max(min(rows, batch.num_rows * size // max(batch.get_total_buffer_size(), 1)), 1)
    for at in range(0, batch.num_rows, step):
        piece = batch.slice(at, step)
        if piece.num_rows > 1 and piece.nbytes > 2 * size:
            yield from slices(piece, piece.num_rows // 2, size)
        else:
            yield piece


def one_name(df: DataFrame, want: str) -> str:
    """``want``, or a name like it that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while want.lower() in taken:
        want = f"_{want}"
    return want


def whole_text(name: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(name), F.lit(""))


HOT = 1_000  # at most so many keys can hold more than a thousandth of all rows
SALTS = 64


def join_hot(left: DataFrame, right: DataFrame, keys: list[str], rows: int) -> DataFrame:
    """Left join of ``left`` (of ``rows`` rows) with ``right``, whose keys are its own.

    The keys that hold more than a thousandth of the left rows, fewer than a
    thousand, are broadcast; their rows are dealt over salts and their partners
    repeated for each salt, so that no task gets all rows of a key.
    """
    hot = F.broadcast(left.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
                      .where(F.col("_rows") > rows / HOT).select(*keys, F.lit(True).alias("_hot")))
    salted = left.withColumn("_place", F.pmod(F.xxhash64(*left.columns), F.lit(SALTS)).cast("int")) \
        .join(hot, keys, "left") \
        .withColumn("_salt", F.when(F.col("_hot"), F.col("_place")).otherwise(0))
    every = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    repeated = right.join(hot, keys, "left").withColumn("_salt", F.explode(every)).drop("_hot")
    return salted.join(repeated, [*keys, "_salt"], "left").drop("_salt", "_hot", "_place")
