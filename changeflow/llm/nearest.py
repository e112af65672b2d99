"""Approximate nearest neighbours: a forest of random-projection trees, one queue, exact reranking."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow.llm.common import column, group_starts, join_hot, ready
from changeflow.llm.embeddings import unit, usable
from changeflow.session import written

K = 5
EVERY = 50  # vectors whose id this divides are the queries
TREES = 4
LEAVES = 128  # leaves a tree has, so that a search makes a bounded number of visits
LEAF = 64  # vectors a leaf should hold at least
LEAF_BYTES = 1 << 23  # and at most, in double precision; a larger table has more leaves
SAMPLE_ROWS = 1 << 16  # vectors the trees are fitted on, at most
SAMPLE_BYTES = 1 << 25
SAMPLE_LEAF = 8  # sample vectors a leaf holds at least
PROBES = 256  # sample vectors whose true neighbours set how far a search goes
RECALL = 0.96  # of the probes' true neighbours that a search has to reach
SEED = 20_260
CHUNK = 1 << 18  # cosines at once


@dataclass
class Tree:
    """Splits: a node sends a vector left if its product with ``turn`` is at most ``cut``.

    Children below zero are leaves: -1 is leaf 0. A tree without nodes is leaf 0.
    """

    turn: np.ndarray
    cut: np.ndarray
    low: np.ndarray
    high: np.ndarray

    def leaves(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each vector."""
        at = np.full(len(vectors), 0 if len(self.cut) else -1)
        while len(rows := np.flatnonzero(at >= 0)):
            node = at[rows]
            side = np.einsum("ij,ij->i", vectors[rows], self.turn[node]) <= self.cut[node]
            at[rows] = np.where(side, self.low[node], self.high[node])
        return -1 - at


@dataclass
class Forest:
    """The trees for vectors of one size, the vectors in each leaf, and how many a search looks at.

    A leaf of more than ``block`` vectors is dealt to blocks.
    """

    trees: list[Tree]
    block: int = 4 * LEAF
    rows: list[dict[int, int]] = field(default_factory=list)
    budget: float = math.inf

    def visits(self, vector: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(tree, leaf, its vectors), from all trees by one queue, nearest boundary first."""
        margins = [tree.turn @ vector - tree.cut if len(tree.cut) else None for tree in self.trees]
        queue = [(0.0, t, 0 if len(tree.cut) else -1) for t, tree in enumerate(self.trees)]
        while queue:
            far, t, node = heapq.heappop(queue)
            if node < 0:
                yield t, -1 - node, self.rows[t].get(-1 - node, 0)
                continue
            tree, margin = self.trees[t], float(margins[t][node])
            near, other = (tree.low, tree.high) if margin <= 0 else (tree.high, tree.low)
            heapq.heappush(queue, (far, t, int(near[node])))
            heapq.heappush(queue, (max(far, abs(margin)), t, int(other[node])))

    def blocks(self, rows: int) -> int:
        return -(-rows // self.block)

    def search(self, vector: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """The leaves that a search looks at: as many as hold the budget's vectors."""
        seen = 0
        for tree, leaf, rows in self.visits(vector):
            if seen >= self.budget:
                return
            seen += rows
            if rows:
                yield tree, leaf, rows


def fit_tree(vectors: np.ndarray, leaf: int, random: np.random.Generator) -> Tree:
    """A tree over unit vectors: each node splits at the median along the line between two
    random centres, moved a few times to the means of the vectors nearest to them."""
    turns, cuts, children = [], [], []

    def split(rows: np.ndarray) -> tuple | None:
        if len(rows) <= leaf:
            return None
        some = vectors[random.choice(rows, min(len(rows), 256), replace=False)]
        a, b = some[0], some[1]
        for _ in range(6):
            nearer = some @ (a - b) > 0
            if nearer.all() or not nearer.any():
                break
            a, b = (m / max(np.linalg.norm(m), 1e-12) for m in
                    (some[nearer].mean(axis=0), some[~nearer].mean(axis=0)))
        turn = a - b
        length = np.linalg.norm(turn)
        turn = turn / length if length > 1e-9 else random.standard_normal(vectors.shape[1])
        along = np.einsum("ij,j->i", vectors[rows], turn)
        cut = float(np.median(along))
        left = along <= cut
        return (turn, cut, rows[left], rows[~left]) if not left.all() else None

    leaves, waiting = 0, [(np.arange(len(vectors)), None, None)]
    while waiting:
        rows, parent, side = waiting.pop()
        found = split(rows)
        if found is None:
            name, leaves = -1 - leaves, leaves + 1
        else:
            name = len(cuts)
            turns.append(found[0])
            cuts.append(found[1])
            children.append([0, 0])
            waiting += [(found[2], name, 0), (found[3], name, 1)]
        if parent is not None:
            children[parent][side] = name
    turn = np.array(turns) if turns else np.zeros((0, vectors.shape[1]))
    child = np.array(children, "i8").reshape(-1, 2)
    return Tree(turn, np.array(cuts), child[:, 0], child[:, 1])


def nearest(spark: SparkSession, vectors: DataFrame, ident: str = "vec_id",
            vector: str = "embedding", k: int = K, is_query: Column | None = None,
            recall: float = RECALL) -> DataFrame:
    """(query_id, rank, ident, score): the ``k`` vectors of largest cosine found for each query.

    Queries are the rows where ``is_query`` holds (ids divisible by ``EVERY`` if
    not given), candidates all rows of another id. Equal vectors are put together:
    one search serves them, and their k + 1 smallest ids are all that can be
    among the answers. The trees are fitted on a sample of different vectors, at
    most ``SAMPLE_ROWS`` and ``SAMPLE_BYTES``; every vector is then put into a leaf
    of each tree. A search takes leaves from all trees by one queue, those whose
    boundaries are nearest first, until they hold a number of vectors that
    is the same for all queries: as many as it takes to reach the share ``recall``
    of the true neighbours, found among all vectors, of ``PROBES`` sample vectors.
    So a table without any structure is searched to a large part. The vectors of the
    leaves, dealt to blocks where a leaf is large, are ranked by exact cosines in
    double precision; block by block the best go on.

    Ties go to the smaller id. If there are fewer than k candidates all are
    found. Vectors that are null, empty, zero or have a null or non-finite
    component are no queries and no candidates; those of different sizes never
    meet. Rows that repeat id and vector count once; an id with several vectors has an
    answer for each. Rows without an id take no part. Other columns are left
    aside, whatever their names; an empty table gives no rows.
    """
    ready(spark)
    asked = (F.col("ident") % EVERY == 0) if is_query is None else is_query
    kind = vectors.schema[vector].dataType
    single = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType)
    rows = vectors.select(F.col(ident).alias("ident"), F.col(vector).cast(
        "array<float>" if single else "array<double>").alias("vector")) \
        .where(F.col("ident").isNotNull() & usable(F.col("vector"))) \
        .withColumns({"h1": F.xxhash64("vector"), "h2": F.xxhash64(F.lit(1), "vector")})
    ids = written(rows.select("h1", "h2", "ident").distinct(), "ids")
    order = Window.partitionBy("h1", "h2").orderBy("ident")
    firsts = ids.withColumn("at", F.row_number().over(order)).where(F.col("at") <= k + 1) \
        .groupBy("h1", "h2").agg(F.sort_array(F.collect_list("ident")).alias("ids"))
    query = ids.withColumn("asked", F.coalesce(asked, F.lit(False)))
    classes = written(rows.groupBy("h1", "h2").agg(F.first("vector").alias("vector"))
                      .join(query.groupBy("h1", "h2").agg(F.max("asked").alias("asked")), ["h1", "h2"])
                      .join(firsts, ["h1", "h2"])
                      .withColumn("cid", F.monotonically_increasing_id()), "vectors")
    forests = _fitted(classes)
    share = spark.sparkContext.broadcast(forests)
    placed = written(_placed(classes, share), "leaves")
    counts = placed.groupBy("size", "tree", "leaf").agg(F.count(F.lit(1)).alias("rows")).collect()
    _counted(forests, counts)
    if any(len(tree.cut) for forest in forests.values() for tree in forest.trees):
        _set_budgets(classes, placed, forests, k, recall)
    share.unpersist()
    found = _search(classes, placed, spark.sparkContext.broadcast(forests), k)
    best = Window.partitionBy("query").orderBy(F.desc("score"), "first")
    short = found.withColumn("at", F.dense_rank().over(best)).where(F.col("at") <= k + 1) \
        .select("query", "cid", "score").distinct()
    answers = short.join(classes.select("cid", "ids"), "cid") \
        .select("query", "score", F.explode("ids").alias("near")) \
        .groupBy("query").agg(F.slice(F.array_sort(F.collect_list(F.struct(
            (-F.col("score")).alias("less"), "near"))), 1, k + 1).alias("found")) \
        .join(classes.select(F.col("cid").alias("query"), "h1", "h2"), "query")
    asking = query.where("asked").select("ident", "h1", "h2")
    joined = join_hot(asking, answers.select("h1", "h2", "found"), ["h1", "h2"], asking.count())
    kept = F.slice(F.filter("found", lambda x: x["near"] != F.col("ident")), 1, k)
    return joined.select("ident", F.posexplode(kept).alias("at", "hit")).select(
        F.col("ident").alias("query_id"), (F.col("at") + 1).alias("rank"),
        F.col("hit.near").alias(ident), (-F.col("hit.less")).alias("score"))


def _lists(table: pa.Table | pa.RecordBatch, rows: np.ndarray | None = None) -> np.ndarray:
    """The vectors, all of one size, of the given rows, in double precision."""
    lists = table.column("vector")
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    lists = lists if rows is None else lists.take(pa.array(rows))
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1).astype("f8")


def _by_size(batch: pa.RecordBatch, rows: int = 1 << 12) -> Iterator[tuple[int, np.ndarray]]:
    """(size, row numbers) of the batch's vectors, at most ``rows`` at once."""
    sizes = batch.column("vector").value_lengths().to_numpy(zero_copy_only=False)
    for size in np.unique(sizes):
        of_size = np.flatnonzero(sizes == size)
        for at in range(0, len(of_size), rows):
            yield int(size), of_size[at:at + rows]


def _fitted(classes: DataFrame) -> dict[int, Forest]:
    """Forests by vector size, fitted on a sample whose size does not depend on the table's."""
    total = classes.count()
    if total == 0:
        return {}
    width = classes.agg(F.max(F.size("vector"))).first()[0]
    most = max(min(SAMPLE_ROWS, SAMPLE_BYTES // (8 * width)), PROBES)
    some = classes.select("cid", "vector", "h1")
    if total > most:
        part = math.ceil(min(1.2 * most / total, 1) * (1 << 40))
        some = some.where(F.pmod(F.xxhash64(F.lit(SEED), "h1"), F.lit(1 << 40)) < part)
    taken = some.orderBy(F.xxhash64(F.lit(SEED), "h1"), "cid").limit(most).drop("h1").toArrow()
    forests = {}
    for batch in taken.combine_chunks().to_batches():
        sizes = batch.column("vector").value_lengths().to_numpy(zero_copy_only=False)
        for size in np.unique(sizes):
            rows = np.flatnonzero(sizes == size)
            data = unit(_lists(batch, rows))
            whole = len(rows) * total // batch.num_rows  # vectors of this size, about
            wanted = max(LEAF, min(whole // LEAVES, LEAF_BYTES // (8 * int(size))))
            leaf = max(SAMPLE_LEAF, wanted * batch.num_rows // total)
            trees = TREES if len(rows) > leaf else 1
            forests[int(size)] = Forest([
                fit_tree(data, leaf, np.random.default_rng([SEED, int(size), t]))
                for t in range(trees)], 2 * wanted)
    return forests


def _forest(forests: dict[int, Forest], size: int) -> Forest:
    """The size's forest; vectors of a size that is not in the sample share one leaf."""
    if size not in forests:
        nothing = np.zeros(0, "i8")
        return Forest([Tree(np.zeros((0, size)), np.zeros(0), nothing, nothing)], rows=[{}])
    return forests[size]


def _placed(classes: DataFrame, forests) -> DataFrame:
    """(cid, size, tree, leaf) of every vector in every tree."""
    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cids = batch.column("cid").to_numpy(zero_copy_only=False)
            for size, rows in _by_size(batch):
                data = unit(_lists(batch, rows))
                for t, tree in enumerate(_forest(forests.value, size).trees):
                    yield pa.RecordBatch.from_arrays([
                        pa.array(cids[rows]), pa.array(np.full(len(rows), size, "i4")),
                        pa.array(np.full(len(rows), t, "i4")),
                        pa.array(tree.leaves(data).astype("i8"))], ["cid", "size", "tree", "leaf"])

    return classes.select("cid", "vector").mapInArrow(
        place, "cid bigint, size int, tree int, leaf bigint")


def _counted(forests: dict[int, Forest], counts: list) -> None:
    for forest in forests.values():
        forest.rows = [{} for _ in forest.trees]
    for row in counts:
        if row["size"] not in forests:
            forests[row["size"]] = _forest(forests, row["size"])
        forests[row["size"]].rows[row["tree"]][row["leaf"]] = row["rows"]


def _set_budgets(classes: DataFrame, placed: DataFrame, forests: dict[int, Forest], k: int,
                 recall: float) -> None:
    """How many vectors a search has to look at, from the true neighbours of a few vectors."""
    spark = classes.sparkSession
    probes = classes.orderBy(F.xxhash64(F.lit(SEED + 1), "h1"), "cid").limit(PROBES) \
        .select("cid", "vector").toArrow().combine_chunks().to_batches()[0]
    by_size = {}
    for size, rows in _by_size(probes):
        by_size[size] = (probes.column("cid").to_numpy()[rows], unit(_lists(probes, rows)))
    asked = spark.sparkContext.broadcast(by_size)

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list[tuple]] = {}
        for batch in batches:
            cids = batch.column("cid").to_numpy(zero_copy_only=False)
            for size, rows in _by_size(batch):
                names, wanted = asked.value.get(size, ((), None))
                if len(names) == 0:
                    continue
                near = wanted @ unit(_lists(batch, rows)).T
                near[names[:, None] == cids[rows][None, :]] = -np.inf
                top = np.argsort(-near, axis=1)[:, :k]
                for i, name in enumerate(names):
                    held = best.get(int(name), []) + [
                        (float(near[i, j]), int(cids[rows[j]])) for j in top[i]]
                    best[int(name)] = sorted(held, reverse=True)[:k]
        flat = [(name, score, cid) for name, held in best.items() for score, cid in held
                if score > -math.inf]
        if flat:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in zip(*flat)], ["probe", "score", "cid"])

    order = Window.partitionBy("probe").orderBy(F.desc("score"), "cid")
    true = classes.select("cid", "vector").mapInArrow(
        compare, "probe bigint, score double, cid bigint") \
        .withColumn("at", F.row_number().over(order)).where(F.col("at") <= k)
    homes: dict[int, dict[int, set]] = {}
    for row in true.join(placed, "cid").select("probe", "cid", "tree", "leaf").collect():
        homes.setdefault(row["probe"], {}).setdefault(row["cid"], set()).add((row["tree"], row["leaf"]))
    for size, (names, data) in by_size.items():
        needed = []
        for name, vector in zip(names, data):
            left, seen = dict(homes.get(int(name), {})), 0
            for tree, leaf, rows in forests[size].visits(vector):
                if not left:
                    break
                needed += [seen + 1 for h in left.values() if (tree, leaf) in h]
                left = {c: h for c, h in left.items() if (tree, leaf) not in h}
                seen += rows
        needed.sort()
        if needed:
            forests[size].budget = max(needed[min(math.ceil(recall * len(needed)), len(needed)) - 1],
                                       2 * LEAF, 8 * (k + 1) * len(forests[size].trees))


def _search(classes: DataFrame, placed: DataFrame, forests, k: int) -> DataFrame:
    """(query, cid, first, score): the best of each block of a leaf for each query that visits it."""
    keys = ["size", "tree", "leaf", "block"]

    def visit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cids = batch.column("cid").to_numpy(zero_copy_only=False)
            for size, rows in _by_size(batch, 64):
                forest = _forest(forests.value, size)
                for row, vector in zip(rows, unit(_lists(batch, rows))):
                    to = [(size, t, leaf, block) for t, leaf, n in forest.search(vector)
                          for block in range(forest.blocks(n))]
                    for at in range(0, len(to), 1 << 10):
                        part = list(zip(*to[at:at + (1 << 10)]))
                        yield pa.RecordBatch.from_arrays([
                            pa.array(part[0], pa.int32()), pa.array(part[1], pa.int32()),
                            pa.array(part[2], pa.int64()), pa.array(part[3], pa.int32()),
                            pa.array(np.full(len(part[0]), cids[row])),
                            batch.column("vector").take(pa.array(np.full(len(part[0]), row)))],
                            [*keys, "cid", "vector"])

    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, tree, leaf, cid = (batch.column(c).to_pylist() for c in ("size", "tree", "leaf", "cid"))
            block = [c % forests.value[s].blocks(forests.value[s].rows[t][n])
                     for s, t, n, c in zip(size, tree, leaf, cid)]
            yield batch.append_column("block", pa.array(block, pa.int32()))

    def rank(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, name = [], None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            starts = group_starts(table, [*keys, "asks"])
            for first, last in zip(starts, [*starts[1:], table.num_rows]):
                piece = table.slice(first, last - first)
                key = tuple(piece.column(c)[0].as_py() for c in keys)
                if key != name:
                    held, name = [], key
                if not piece.column("asks")[0].as_py():
                    held.append(piece)  # a leaf's block comes before the queries that visit it
                elif held:
                    if len(held) > 1:
                        held = [pa.concat_tables(held)]
                    yield from _best(piece, held[0], k)

    pieces = f"size int, tree int, leaf bigint, block int, cid bigint, vector {_type(classes)}"
    visits = classes.where("asked").select("cid", "vector").mapInArrow(visit, pieces)
    dealt = placed.mapInArrow(deal, T.StructType([*placed.schema, T.StructField("block", T.IntegerType())]))
    members = dealt.join(classes.select("cid", "vector", F.col("ids")[0].alias("first")), "cid")
    both = members.select(*keys, "cid", "vector", "first", F.lit(0).alias("asks")).unionByName(
        visits.withColumns({"first": F.lit(None), "asks": F.lit(1)}))
    ident = members.schema["first"].dataType.simpleString()
    return both.repartition(*keys).sortWithinPartitions(*keys, "asks").mapInArrow(
        rank, f"query bigint, cid bigint, first {ident}, score double")


def _type(classes: DataFrame) -> str:
    return classes.schema["vector"].dataType.simpleString()


def _best(asking: pa.Table, block: pa.Table, k: int) -> Iterator[pa.RecordBatch]:
    """The k + 1 nearest of the block for each asking vector, ties to the smaller first id."""
    wanted, data = unit(_lists(asking)), unit(_lists(block))
    names, cids = column(asking, "cid"), column(block, "cid")
    firsts = column(block, "first")
    by_first = np.argsort(firsts, kind="stable")
    step = max(CHUNK // len(data), 1)
    for at in range(0, len(wanted), step):
        some = wanted[at:at + step]
        rough = some @ data.T
        # Products of matrices round differently; what may be among the best is computed again.
        least = -np.partition(-rough, min(k, len(data) - 1), axis=1)[:, min(k, len(data) - 1)]
        i, j = np.nonzero(rough[:, by_first] >= least[:, None] - 1e-9)
        j = by_first[j]
        score = np.clip(np.einsum("ij,ij->i", some[i], data[j]), -1, 1)
        order = np.lexsort((np.argsort(by_first)[j], -score, i))
        i, j, score = i[order], j[order], score[order]
        start = np.searchsorted(i, i)
        top = np.arange(len(i)) - start <= k
        yield pa.RecordBatch.from_arrays([
            pa.array(names[at:at + step][i[top]]), pa.array(cids[j[top]]),
            block.column("first").combine_chunks().take(pa.array(j[top])), pa.array(score[top])],
            ["query", "cid", "first", "score"])
