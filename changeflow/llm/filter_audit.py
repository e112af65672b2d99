"""How filters overlap: sorted lists of failing ids, merged in every order."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterable, Iterator, Sequence
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow.llm.common import join_hot, ready, slices
from changeflow.session import written

MIN_WORDS = 50
DISTINCT = 65  # percent of the words
CAPITALS = 5  # percent of the code points
SIGNS = b"#$%&*|"
UPPER = bytes(range(ord("A"), ord("Z") + 1))
RANGE_ROWS = 1 << 16  # failing rows whose lists are held at once

Check = Callable[[bytes], bool]


def too_short(text: bytes) -> bool:
    return len(text.split()) < MIN_WORDS


def repetitive(text: bytes) -> bool:
    words = text.split()
    return 100 * len(set(words)) < DISTINCT * len(words)


def shouting(text: bytes) -> bool:
    points = len(text.decode("utf-8", "surrogatepass"))
    return 100 * (len(text) - len(text.translate(None, UPPER))) > CAPITALS * points


def has_signs(text: bytes) -> bool:
    return len(text.translate(None, SIGNS)) < len(text)


# Each tells of a whole text whether the filter of that letter removes it.
CHECKS: dict[str, Check] = {"A": too_short, "B": repetitive, "C": shouting, "D": has_signs}
COPIES = "E"


def without(ids: np.ndarray, others: np.ndarray) -> np.ndarray:
    """The entries of a sorted list that another sorted list has not.

    The entries of the shorter list are looked up in the longer one; each search
    starts from where the last one ended, so runs in between are skipped.
    """
    if len(ids) == 0 or len(others) == 0:
        return ids
    if len(ids) <= len(others):
        at = np.minimum(np.searchsorted(others, ids), len(others) - 1)
        return ids[others[at] != ids]
    at = np.searchsorted(ids, others)
    inside = at < len(ids)
    at, others = at[inside], others[inside]
    left = np.ones(len(ids), bool)
    left[at[ids[at] == others]] = False
    return ids[left]


def union(lists: Sequence[np.ndarray]) -> np.ndarray:
    """The sorted entries of any of the sorted lists, merged into the longest."""
    ordered = sorted(lists, key=len, reverse=True)
    merged = ordered[0] if ordered else np.zeros(0, "i8")
    for ids in ordered[1:]:
        new = without(ids, merged)
        merged = np.insert(merged, np.searchsorted(merged, new), new)
    return merged


def interactions(lists: list[np.ndarray], marked: list[np.ndarray]) -> Iterator[tuple]:
    """(filter, filters before it as bits, ids gone with it, removed, removed of each marked list)."""
    for before in range(1 << len(lists)):
        gone = union([ids for i, ids in enumerate(lists) if before >> i & 1])
        for i, ids in enumerate(lists):
            if not before >> i & 1:
                removed = without(ids, gone)
                yield (i, before, len(gone) + len(removed), len(removed),
                       *[len(removed) - len(without(removed, m)) for m in marked])


def audit(spark: SparkSession, docs: DataFrame, labels: DataFrame,
          checks: dict[str, Check] | None = None, ident: str = "doc_id", text: str = "text",
          part: str = "source") -> DataFrame:
    """One row for each part, order of the filters and step of that order.

    Columns: part, filter_order, step, kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, shapley. The filters are the ``checks``, of whole
    texts, and after them ``E``: a smaller ident has an identical text, anywhere
    in the table. Failing rows are sorted by part and ident; in ranges of at
    most ``RANGE_ROWS`` rows each filter has its sorted list of failing ids.
    For each set of filters the lists are merged, and what a further filter
    removes beyond that is the difference; sizes are summed over the ranges.

    A null text is empty, a null part is ''. A null ident has no smaller ones, is
    smaller than none and has no labels. Repeated rows count each; rows of one
    ident do not make each other copies. If labels repeat an ident, one that says
    1 is enough. Texts are judged whole, one at a time, however long. Ties cannot
    change a count. Other columns are left aside, whatever their names. A part
    without failing rows has its rows, with zeros; an empty table gives none.
    """
    ready(spark)
    checks = CHECKS if checks is None else checks
    letters = [*checks, COPIES]
    judged = written(_judged(docs.select(
        F.col(ident).alias("ident"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("text")),
        list(checks.values())), "judged")
    firsts = judged.groupBy("digest").agg(F.min("ident").alias("first"), F.max("ident").alias("last")) \
        .where("first < last").drop("last")
    copy = F.when(F.col("ident") > F.col("first"), 1 << len(checks)).otherwise(0)
    failing = join_hot(judged, firsts, ["digest"], judged.count()) \
        .select("part", "ident", F.col("fails").bitwiseOR(copy).alias("fails")).where("fails > 0")
    said = labels.groupBy(F.col(ident).alias("ident")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"),
        F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    marked = failing.join(said, "ident", "left").select(
        "part", "ident", "fails", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("good", "toxic")])
    sums = written(_merged(marked, len(letters)).groupBy("part", "filter", "before").agg(
        *[F.sum(c).alias(c) for c in ("gone", "removed", "good_lost", "toxic_lost")]), "merged")
    return _by_order(judged.groupBy("part").agg(F.count(F.lit(1)).alias("total")), sums, letters)


def _judged(docs: DataFrame, checks: list[Check]) -> DataFrame:
    """(ident, part, fails, digest): the failed checks as bits, and a hash of the text."""
    def judge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch):
                whole = piece.column(2).to_pylist()
                fails = [sum(check(t) << i for i, check in enumerate(checks)) for t in whole]
                digest = [hashlib.blake2b(t, digest_size=16).digest() for t in whole]
                yield pa.RecordBatch.from_arrays([
                    piece.column(0), piece.column(1), pa.array(fails, pa.int64()),
                    pa.array(digest, pa.binary())], ["ident", "part", "fails", "digest"])

    schema = T.StructType([docs.schema["ident"], docs.schema["part"],
                           T.StructField("fails", T.LongType()),
                           T.StructField("digest", T.BinaryType())])
    return docs.mapInArrow(judge, schema)


def _merged(marked: DataFrame, filters: int) -> DataFrame:
    """(part, filter, before, gone, removed, good_lost, toxic_lost) of each range of ids."""
    names = ["part", "filter", "before", "gone", "removed", "good_lost", "toxic_lost"]

    def merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _ranges(batches):
            parts = batch.column(0).dictionary_encode()
            codes = parts.indices.to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero(np.diff(codes, prepend=-1))
            fails, good, toxic = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2, 3))
            for first, last in zip(cuts, [*cuts[1:], len(codes)]):
                # Rows are in order of part and ident: an id is a row's place in the range, which
                # keeps repeated idents apart.
                lists = [first + np.flatnonzero(fails[first:last] >> i & 1) for i in range(filters)]
                flags = [first + np.flatnonzero(m[first:last]) for m in (good, toxic)]
                found = np.array(list(interactions(lists, flags)), "i8")
                name = parts.dictionary[int(codes[first])].as_py()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(found), pa.string()), *map(pa.array, found.T)], names)

    return marked.repartitionByRange("part", "ident").sortWithinPartitions("part", "ident") \
        .select("part", "fails", "good", "toxic").mapInArrow(
        merge, "part string, " + ", ".join(f"{n} bigint" for n in names[1:]))


def _ranges(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= RANGE_ROWS:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, rows = [], 0
    if rows:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _by_order(totals: DataFrame, sums: DataFrame, letters: list[str]) -> DataFrame:
    n = len(letters)
    steps = []
    for order in permutations(range(n)):
        before = 0
        for step, i in enumerate(order, 1):
            steps.append({"filter_order": "".join(letters[j] for j in order), "step": step,
                          "filter": i, "before": before})
            before |= 1 << i
    every = F.from_json(F.lit(json.dumps(steps)),
                        "array<struct<filter_order string, step int, filter bigint, before bigint>>")
    # In so many of the orders exactly these filters come before.
    orders = F.array(*[F.lit(factorial(k) * factorial(n - 1 - k)) for k in range(n)])
    alone = F.lit((1 << n) - 1) - F.expr("shiftleft(1, CAST(filter AS int))")
    whole = sums.groupBy("part", "filter").agg(
        F.sum(F.when(F.col("before") == 0, F.col("removed"))).alias("failing"),
        F.sum(F.when(F.col("before") == alone, F.col("removed"))).alias("unique_fails"),
        F.sum(F.col("removed") * orders[F.bit_count("before")]).alias("shapley"))
    rows = totals.select("part", "total", F.explode(every).alias("s")) \
        .select("part", "total", "s.*") \
        .join(sums, ["part", "filter", "before"], "left").join(whole, ["part", "filter"], "left")

    def number(name):
        return F.coalesce(name, F.lit(0)).cast("bigint")

    return rows.select(
        "part", "filter_order", "step", (F.col("total") - number("gone")).alias("kept"),
        number("removed").alias("removed"),
        (number("failing") - number("removed")).alias("redundant"),
        number("unique_fails").alias("unique_fails"), number("good_lost").alias("good_lost"),
        number("toxic_lost").alias("toxic_lost"), number("shapley").alias("shapley"))


_ORDERS = " CROSS JOIN ".join(f"l AS l{i}" for i in range(5))
_APART = " AND ".join(f"l{i}.x <> l{j}.x" for i in range(5) for j in range(i))

ORACLE = rf"""
WITH t AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
seen AS (SELECT t, min(doc_id) AS first FROM t GROUP BY t),
said AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic
         FROM labels GROUP BY doc_id),
f AS (
  SELECT part,
    (len(w) < {MIN_WORDS})::INT
    + 2 * (100 * len(list_distinct(w)) < {DISTINCT} * len(w))::INT
    + 4 * (100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')))
           > {CAPITALS} * length(t))::INT
    + 8 * regexp_matches(t, '[#$%&*|]')::INT
    + 16 * coalesce(doc_id > first, false)::INT AS m,
    coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
  FROM t JOIN seen USING (t) LEFT JOIN said USING (doc_id)),
c AS (SELECT part, m, count(*) AS n, count(*) FILTER (good) AS g, count(*) FILTER (toxic) AS x
      FROM f GROUP BY part, m),
l AS (SELECT unnest([0, 1, 2, 3, 4]) AS x),
o AS (SELECT [{', '.join(f'l{i}.x' for i in range(5))}] AS o FROM {_ORDERS} WHERE {_APART}),
s AS (
  SELECT list_aggregate(list_transform(o, lambda k: 'ABCDE'[k + 1]), 'string_agg', '') AS filter_order,
    k::INT AS step, (1 << o[k])::INT AS own,
    coalesce(list_sum(list_transform(o[:k - 1], lambda i: 1 << i)), 0)::INT AS before
  FROM o, unnest(range(1, 6)) AS r(k)),
e AS (
  SELECT part, filter_order, step, own,
    sum(n) FILTER (m & (before | own) = 0) AS kept,
    sum(n) FILTER (m & own > 0 AND m & before = 0) AS removed,
    sum(n) FILTER (m & own > 0 AND m & before > 0) AS redundant,
    sum(n) FILTER (m = own) AS unique_fails,
    sum(g) FILTER (m & own > 0 AND m & before = 0) AS good_lost,
    sum(x) FILTER (m & own > 0 AND m & before = 0) AS toxic_lost
  FROM c, s GROUP BY part, filter_order, step, own)
SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept,
  coalesce(removed, 0)::BIGINT AS removed, coalesce(redundant, 0)::BIGINT AS redundant,
  coalesce(unique_fails, 0)::BIGINT AS unique_fails, coalesce(good_lost, 0)::BIGINT AS good_lost,
  coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
  coalesce(sum(removed) OVER (PARTITION BY part, own), 0)::BIGINT AS shapley
FROM e"""
