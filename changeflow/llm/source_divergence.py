"""How the sources of a language differ in their words: one pass, sorted runs, pair corrections."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from changeflow.llm.common import column, gathered, pairs_in, ready, slices, whole_groups
from changeflow.session import written

MIN_DOCS = 3
SCALE = 1_000_000_000
TOP = 200
BLOCK_WORDS = 1 << 22  # words a block holds before it is spilled
BLOCK_BYTES = 1 << 25  # and the bytes of text, which bound the terms' own bytes
ROWS_OUT = 1 << 16

# Lower-cases A-Z; other ASCII characters part terms, bytes of other characters stay.
_FOLD = bytes(b if b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A else 0x20
              for b in range(256))


def terms(text: bytes) -> list[bytes]:
    """The runs of ASCII letters and other than ASCII characters, A-Z in lower case."""
    return text.translate(_FOLD).split()


class Block:
    """Postings in memory: the terms of many texts, counted together when it is spilled."""

    def __init__(self) -> None:
        self.words: list[pa.Array] = []
        self.groups: list[tuple] = []
        self.sizes: list[int] = []
        self.count = self.seen = 0

    def add(self, groups: list[tuple], texts: list[bytes]) -> None:
        """Take in texts, each with its (lang, source)."""
        found = [terms(t) for t in texts]
        self.words.append(pa.array([w for doc in found for w in doc], pa.binary()))
        self.groups += groups
        self.sizes += map(len, found)
        self.count += len(self.words[-1])
        self.seen += sum(map(len, texts))

    def full(self) -> bool:
        return self.seen >= BLOCK_BYTES or self.count >= BLOCK_WORDS

    def run(self) -> Iterator[pa.RecordBatch]:
        """The block as rows (lang, term, source, n, texts), sorted by the first three."""
        if not self.count:
            return
        coded = pa.chunked_array(self.words).combine_chunks().dictionary_encode()
        order = pc.sort_indices(coded.dictionary)
        known = coded.dictionary.take(order)
        rank = np.empty(len(known), "i8")
        rank[order.to_numpy()] = np.arange(len(known))
        term = rank[coded.indices.to_numpy(zero_copy_only=False)]
        langs, lang = _numbered([g[0] for g in self.groups])
        sources, source = _numbered([g[1] for g in self.groups])
        # One number for (lang, term, source) that sorts like them, from a text's and a term's.
        base = lang * len(known) * len(sources) + source
        doc = np.repeat(np.arange(len(self.sizes)), self.sizes)
        keys, n = np.unique(base[doc] + term * len(sources), return_counts=True)
        once = np.unique(doc * len(known) + term)
        doc, term = np.divmod(once, len(known))
        texts = np.unique(base[doc] + term * len(sources), return_counts=True)[1]
        for at in range(0, len(keys), ROWS_OUT):
            some = slice(at, at + ROWS_OUT)
            rest, source = np.divmod(keys[some], len(sources))
            lang, term = np.divmod(rest, len(known))
            yield pa.RecordBatch.from_arrays([
                langs.take(pa.array(lang)), known.take(pa.array(term)).cast(pa.string()),
                sources.take(pa.array(source)), pa.array(n[some].astype("i8")),
                pa.array(texts[some].astype("i8"))], ["lang", "term", "source", "n", "texts"])


def _numbered(names: list[str]) -> tuple[pa.Array, np.ndarray]:
    """The different names in order, and which of them each name is."""
    found = sorted(set(names))
    at = {name: i for i, name in enumerate(found)}
    return pa.array(found, pa.string()), np.array([at[name] for name in names], "i8")


def runs(docs: DataFrame) -> DataFrame:
    """The spilled runs (lang, term, source, n, texts) of all tasks' blocks."""
    def index(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Block()
        for batch in batches:
            for piece in slices(batch):
                lang, source, text = (c.to_pylist() for c in piece.columns)
                block.add(list(zip(lang, source)), text)
                if block.full():
                    yield from block.run()
                    block = Block()
        yield from block.run()

    return docs.select("lang", "source", "text").mapInArrow(
        index, "lang string, term string, source string, n bigint, texts bigint")


def postings(spark: SparkSession, docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, term, total, held): the kept terms with their counts by source.

    Runs are dealt to shards by a hash of (lang, term). A shard's task sorts what
    it gets, merging its sorted pieces on disk with a heap where they do not fit,
    and adds up neighbours. ``held`` has a (source, n) for each source that has
    the term. A task holds one block, or one term's sources.
    """
    shards = runs(docs).repartition("lang", "term").sortWithinPartitions("lang", "term", "source")
    merged = shards.groupBy("lang", "term", "source").agg(
        F.sum("n").alias("n"), F.sum("texts").alias("texts"))
    return merged.groupBy("lang", "term").agg(
        F.sum("texts").alias("texts"), F.sum("n").alias("total"),
        F.collect_list(F.struct("source", "n")).alias("held")) \
        .where(F.col("texts") >= min_docs).drop("texts")


def share(count: Column | str, size: Column | str) -> Column:
    """1 + floor(SCALE * (count + 1) / size), exact for all long counts."""
    count, size = (F.col(c) if isinstance(c, str) else c for c in (count, size))
    return _div(F.lit(SCALE).cast("decimal(10,0)") * (count + 1).cast("decimal(20,0)"), size) + 1


def gap(p: Column | str, q: Column | str) -> Column:
    """floor((p - q)^2 / q) for shares of at most SCALE + 1."""
    p, q = (F.col(c) if isinstance(c, str) else c for c in (p, q))
    return _div((p - q) * (p - q), q)


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def divergence(spark: SparkSession, docs: DataFrame, min_docs: int = MIN_DOCS,
               top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank) of every (lang, source) of ``docs``.

    A language keeps the terms that are in at least ``min_docs`` of its texts. In
    part ``pair`` the items are the other sources of the language and the value is
    the sum over all kept terms of floor((p - q)^2 / q), p and q being the smoothed
    shares of the two sources. In part ``term`` the items are the source's own kept
    terms whose share is above the language's, ``top`` at most. Ranks are by value,
    descending, then by item.

    One pass over the texts gives counts. For a pair, all terms that neither source
    has give the same value; terms of one source are corrected by a histogram of
    its counts, terms of both by the products of the term's list, summed in the
    task. Work for pairs grows with the sources that share a term.

    A null text, lang or source is ''; so a null is one with empties. A group
    without terms, or in a language without kept terms, still has its pairs. Texts
    are counted whole, however long. Repeated rows are texts of their own. Ties
    are ordered by item. Other columns are left aside; an empty table gives no rows.
    """
    ready(spark)
    clean = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
                          for c in ("lang", "source", "text")])
    kept = written(postings(spark, clean.withColumn("text", F.col("text").cast("binary")), min_docs),
                   "postings")
    single = kept.select("lang", "term", "total", F.explode("held").alias("h")) \
        .select("lang", "term", "total", "h.source", "h.n")
    groups = written(_groups(clean, kept, single), "groups")
    return _term_part(single, groups, top).unionByName(_pair_part(single, groups))


def _groups(docs: DataFrame, kept: DataFrame, single: DataFrame) -> DataFrame:
    """(lang, source, at, size, lang_size, terms): what shares are taken of, and a number."""
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("total").alias("all"))
    sums = single.groupBy("lang", "source").agg(F.sum("n").alias("own"))

    def zero(name):
        return F.coalesce(name, F.lit(0))

    return docs.select("lang", "source").distinct() \
        .join(langs, "lang", "left").join(sums, ["lang", "source"], "left") \
        .select("lang", "source", zero("terms").alias("terms"),
                (zero("own") + zero("terms")).alias("size"),
                (zero("all") + zero("terms")).alias("lang_size"),
                (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).alias("at"))


def _ranked(df: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return df.select("lang", "source", F.lit(part).alias("part"), "item", "value",
                     F.row_number().over(order).alias("rank"))


def _term_part(single: DataFrame, groups: DataFrame, top: int) -> DataFrame:
    both = single.join(groups, ["lang", "source"]).select(
        "lang", "source", F.col("term").alias("item"), share("n", "size").alias("p"),
        share("total", "lang_size").alias("q")).where("p > q")
    # Spark cuts each task's rows to the first ranks of a group before it moves them.
    return _ranked(both.withColumn("value", gap("p", "q")), "term").where(F.col("rank") <= top)


def _pair_part(single: DataFrame, groups: DataFrame) -> DataFrame:
    """All ordered pairs of a language's sources with the sum over its kept terms."""
    known = groups.select("lang", "source", "at", "terms", "size",
                          share(F.lit(0), F.when(F.col("terms") > 0, F.col("size"))).alias("none"))
    one = known.select("lang", *[F.col(c).alias(f"{c}_1") for c in known.columns[1:]])
    two = known.select("lang", *[F.col(c).alias(f"{c}_2") for c in known.columns[1:]])
    pairs = one.join(two, "lang").where("at_1 <> at_2")
    neither = gap("none_1", "none_2")
    base = pairs.select("lang", "at_1", "at_2", _exact(
        F.coalesce(F.col("terms_1") * neither.cast("decimal(19,0)"), F.lit(0))))
    # Terms of one source: for each count the number of its terms with it.
    counted = single.groupBy("lang", "source", "n").agg(F.count(F.lit(1)).alias("times")) \
        .join(groups.select("lang", "source", "at", "size"), ["lang", "source"]) \
        .select("lang", F.col("at").alias("at_1"), "times", share("n", "size").alias("p"))
    first = counted.join(pairs, ["lang", "at_1"]).select("lang", "at_1", "at_2", _exact(
        F.col("times") * (gap("p", "none_2") - neither).cast("decimal(19,0)")))
    second = counted.withColumnRenamed("at_1", "at_2").join(pairs, ["lang", "at_2"]).select(
        "lang", "at_1", "at_2", _exact(
            F.col("times") * (gap("none_1", "p") - neither).cast("decimal(19,0)")))
    shared = _corrections(single.join(known, ["lang", "source"]).select(
        "lang", "term", "at", share("n", "size").alias("p"), "none"))
    third = shared.select("lang", "at_1", "at_2", _exact(F.col("value")))
    sums = base.unionByName(first).unionByName(second).unionByName(third) \
        .groupBy("lang", "at_1", "at_2").agg(F.sum("value").cast("bigint").alias("value"))
    names = groups.select("lang", "source", "at")
    named = sums.join(names.withColumnRenamed("at", "at_1"), ["lang", "at_1"]) \
        .join(names.select("lang", F.col("source").alias("item"), F.col("at").alias("at_2")),
              ["lang", "at_2"])
    return _ranked(named, "pair")


def _exact(value: Column) -> Column:
    return value.cast("decimal(38,0)").alias("value")


def _corrections(listed: DataFrame) -> DataFrame:
    """(lang, at_1, at_2, value): for pairs that share terms, what these give beyond the
    corrections of each source alone; added up over about ``PAIRS_AT_ONCE`` pairs."""
    def gaps(p: np.ndarray, q: np.ndarray) -> np.ndarray:
        return (p - q) ** 2 // q

    def correct(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in whole_groups(batches, ["lang", "term"], 1 << 14):
            langs = table.column("lang").combine_chunks().dictionary_encode()
            code = langs.indices.to_numpy(zero_copy_only=False).astype("i8")
            at, p, none = (column(table, c).astype("i8") for c in ("at", "p", "none"))
            for i, j in pairs_in(starts, table.num_rows):
                a, b = np.concatenate([i, j]), np.concatenate([j, i])
                value = gaps(p[a], p[b]) - gaps(p[a], none[b]) - gaps(none[a], p[b]) \
                    + gaps(none[a], none[b])
                order = np.lexsort((at[b], at[a], code[a]))
                key = np.stack([code[a], at[a], at[b]])[:, order]
                cut = np.flatnonzero(np.append(True, (key[:, 1:] != key[:, :-1]).any(axis=0)))
                yield pa.RecordBatch.from_arrays([
                    langs.dictionary.take(pa.array(key[0, cut])), pa.array(key[1, cut]),
                    pa.array(key[2, cut]), pa.array(np.add.reduceat(value[order], cut))],
                    ["lang", "at_1", "at_2", "value"])

    return gathered(listed, ["lang", "term"]).mapInArrow(
        correct, "lang string, at_1 bigint, at_2 bigint, value bigint")


ORACLE = rf"""
WITH d AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
t AS (SELECT lang, source, unnest(list_distinct(w)) AS term, 0 AS n, 1 AS texts FROM d
      UNION ALL SELECT lang, source, unnest(w), 1, 0 FROM d),
c AS (SELECT lang, source, term, sum(n)::HUGEINT AS n, sum(texts) AS texts FROM t GROUP BY ALL),
k AS (SELECT lang, term, sum(n)::HUGEINT AS n FROM c GROUP BY lang, term
      HAVING sum(texts) >= {MIN_DOCS}),
v AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS n FROM k GROUP BY lang),
s AS (SELECT c.lang, c.source, sum(c.n)::HUGEINT AS n FROM c JOIN k USING (lang, term)
      GROUP BY c.lang, c.source),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, k.n AS lang_n,
    1 + {SCALE}::HUGEINT * (coalesce(c.n, 0) + 1) // (coalesce(s.n, 0) + v.v) AS p,
    1 + {SCALE}::HUGEINT * (k.n + 1) // (v.n + v.v) AS q
  FROM g JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN s USING (lang, source)
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
    sum((a.p - b.p) * (a.p - b.p) // b.p)::BIGINT AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY a.lang, a.source, b.source),
every AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q) // q)::BIGINT FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value,
  (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank
FROM every QUALIFY part = 'pair' OR rank <= {TOP}"""
