"""Changelogs: frames with an ``op`` column and columns that order the changes.

``op`` is one of +I (insert), -U (before an update), +U (after an update) and
-D (delete). All operators that fold a key's history first reduce it to one row
per map task (partial aggregation), so a hot key never travels whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow.session import written

INSERT, BEFORE, AFTER, DELETE = "+I", "-U", "+U", "-D"
ADDS = (INSERT, AFTER)
RETRACTS = (BEFORE, DELETE)


# ---- row-wise routing -------------------------------------------------------

def append_only(changes: DataFrame, op: str = "op") -> DataFrame:
    """Without a key only inserts can be stored; the rest is dropped."""
    return changes.where(F.col(op) == INSERT).drop(op)


def additions(changes: DataFrame, op: str = "op") -> DataFrame:
    """Rows that add something; retractions are dropped."""
    return changes.where(F.col(op).isin(*ADDS))


def without_before(changes: DataFrame, op: str = "op") -> DataFrame:
    """All kinds but -U."""
    return changes.where(F.col(op) != BEFORE)


def as_retract_pairs(changes: DataFrame, op: str = "op") -> DataFrame:
    """Collapse ``op`` to ``is_add`` and pack the other columns into ``payload``."""
    rest = [c for c in changes.columns if c != op]
    return changes.select(F.col(op).isin(*ADDS).alias("is_add"), F.struct(*rest).alias("payload"))


def flatten_changelog(changes: DataFrame, op: str = "op", keep_op: bool = False) -> DataFrame:
    """Every record's payload as a plain row, retractions included.

    ``keep_op`` is the safe form: without it a retraction looks like an addition.
    """
    return changes if keep_op else changes.drop(op)


# ---- folding a history ------------------------------------------------------

def _sequence(order: Sequence[str]) -> Column:
    return F.struct(*order)


def _sortable(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(_sortable(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _sortable(kind.elementType)
    return not isinstance(kind, (T.MapType, T.VariantType))


def _extreme(df: DataFrame, columns: Sequence[str], order: Sequence[str],
             where: Column | None = None, first: bool = False) -> Column:
    """The aggregate that keeps ``columns`` of the last (or first) row by ``order``.

    The largest struct of (order, columns) is that row. It costs less than
    max_by and settles ties by the values, so a repeated run gives the same row.
    Columns without an order of their own, such as maps, need max_by.
    """
    at, row = _sequence(order), F.struct(*columns)
    if all(_sortable(df.schema[c].dataType) for c in columns):
        pair = F.struct(at.alias("at"), row.alias("row"))
        pair = pair if where is None else F.when(where, pair)
        return (F.min(pair) if first else F.max(pair))["row"]
    if where is not None:
        at, row = F.when(where, at), F.when(where, row)
    return F.min_by(row, at) if first else F.max_by(row, at)


def compact(changes: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last change of each key, in stream order."""
    rest = [c for c in changes.columns if c not in keys]
    last = _extreme(changes, rest, order).alias("_last")
    return changes.groupBy(*keys).agg(last).select(*keys, "_last.*").select(*changes.columns)


def materialize(changes: DataFrame, keys: Sequence[str], order: Sequence[str],
                op: str = "op") -> DataFrame:
    """The table after all changes; a key whose last change retracts it is gone."""
    return compact(changes, keys, order).where(~F.col(op).isin(*RETRACTS)).drop(op)


def _meet(target: DataFrame, folded: DataFrame, keys: Sequence[str], few: bool) -> DataFrame:
    """All target rows (marked ``_there``) and all folded keys, matched by key.

    One full outer join moves both sides, unless the target is bucketed by key.
    With ``few`` the folded changes are written first, so that Spark knows their
    size: if it is below the broadcast threshold, target rows look up their
    change where they are, and the changes without a row are found by the keys
    that had one. Above the threshold the same joins shuffle.
    """
    names, marked = list(keys), target.withColumn("_there", F.lit(True))
    if not few:
        return marked.join(folded, names, "full_outer")
    folded = written(folded, "folded")
    matched = target.select(*names).join(folded.select(*names), names, "left_semi")
    fresh = folded.join(matched, names, "left_anti")
    return marked.join(folded, names, "left").unionByName(fresh, allowMissingColumns=True)


def apply_changelog(target: DataFrame, changes: DataFrame, keys: Sequence[str],
                    order: Sequence[str], update_strategy: str = "update",
                    ignore_delete: bool = True, fixed: Sequence[str] = (),
                    few: bool = False, op: str = "op") -> DataFrame:
    """``target`` after ``changes``, as if they ran one by one in stream order.

    +I puts the row. +U follows ``update_strategy``: ``update`` sets the columns
    of an existing key and does nothing for an absent one, ``insert`` puts the
    row, ``discard`` does nothing. -D removes the key unless ``ignore_delete``.
    -U does nothing. ``fixed`` columns (partition columns) change only with +I.

    A key's history folds to three facts: the last row put or set, the time of
    the last put, and the time of the last delete. Both join sides then hold a
    key once, so no key is hot in the join. ``few`` plans for changes far smaller
    than the target and runs a job to fold them first, see :func:`_meet`.
    """
    if update_strategy not in ("update", "insert", "discard"):
        raise ValueError(f"unknown update strategy {update_strategy!r}")
    values = [c for c in target.columns if c not in keys]
    put_ops = ADDS if update_strategy == "insert" else (INSERT,)
    set_ops = put_ops + ((AFTER,) if update_strategy == "update" else ())
    used = set_ops + (() if ignore_delete else (DELETE,))
    put, written, gone = (F.col(op).isin(*ops) for ops in (put_ops, set_ops, (DELETE,)))
    at = _sequence(order)

    facts = [
        _extreme(changes, values, order, written).alias("_row"),
        F.max(F.when(put, at)).alias("_put"),
        F.max(F.when(gone, at)).alias("_gone"),
    ]
    if fixed:
        facts.append(_extreme(changes, fixed, order, put).alias("_home"))
    folded = changes.where(F.col(op).isin(*used)).groupBy(*keys).agg(*facts)

    joined = _meet(target, folded, keys, few)
    alive = (F.when(F.col("_gone").isNull(), F.col("_there").isNotNull() | F.col("_put").isNotNull())
             .otherwise(F.col("_put") > F.col("_gone")))

    def pick(column: str) -> Column:
        source = "_home" if column in fixed else "_row"
        return F.when(F.col(source).isNotNull(), F.col(f"{source}.{column}")) \
            .otherwise(F.col(column)).alias(column)

    return joined.where(alive).select(*keys, *[pick(c) for c in values]).select(*target.columns)


def apply_flagged(target: DataFrame, changes: DataFrame, keys: Sequence[str],
                  order: Sequence[str], flag: str = "is_add") -> DataFrame:
    """True puts the row, false deletes its key."""
    tagged = changes.withColumn("op", F.when(F.col(flag), F.lit(AFTER)).otherwise(F.lit(DELETE)))
    return apply_changelog(target, tagged.drop(flag), keys, order, "insert", ignore_delete=False)


def upsert(target: DataFrame, rows: DataFrame, keys: Sequence[str], order: Sequence[str],
           op: str | None = None, deletes: str = "refuse") -> DataFrame:
    """Insert, or replace all non-key columns on a key conflict.

    Rows that retract are refused while the job runs, or with
    ``deletes='as_upsert'`` put like any other row.
    """
    if deletes not in ("refuse", "as_upsert"):
        raise ValueError(f"deletes must be refuse or as_upsert, not {deletes!r}")
    if op is not None and deletes == "refuse":
        refuse = F.raise_error(F.concat(F.lit("upsert cannot take "), F.col(op)))
        rows = rows.where(F.when(F.col(op).isin(*RETRACTS), refuse.cast("boolean")).otherwise(True))
    tagged = rows.withColumn("op", F.lit(AFTER))
    return apply_changelog(target, tagged, keys, order, "insert")


def write_op(target: DataFrame, rows: DataFrame, keys: Sequence[str], operation: str,
             order: Sequence[str], ignore_duplicate: bool = False,
             ignore_not_found: bool = False) -> DataFrame:
    """Apply one operation to every row of a batch.

    INSERT meets a known key, UPDATE or DELETE an unknown one: the job fails, or
    skips the row when the matching ``ignore`` flag is set. UPSERT never
    conflicts. Among rows of one key the first insert and the last update count.
    The checks ride inside the one join that also builds the result.
    """
    if operation not in ("INSERT", "UPDATE", "DELETE", "UPSERT"):
        raise ValueError(f"unknown operation {operation!r}")
    values = [c for c in target.columns if c not in keys]
    batch = rows.groupBy(*keys).agg(
        _extreme(rows, values or keys, order, first=operation == "INSERT").alias("_new"),
        F.count(F.lit(1)).alias("_n"),
    )
    joined = target.withColumn("_there", F.lit(True)).join(batch, list(keys), "full_outer")
    there, new = F.col("_there").isNotNull(), F.col("_new").isNotNull()

    conflict, keep = F.lit(False), F.lit(True)
    take = new
    if operation == "INSERT":
        take = new & ~there
        if not ignore_duplicate:
            conflict = (new & there) | (F.col("_n") > 1)
    elif operation in ("UPDATE", "DELETE"):
        keep = there if operation == "UPDATE" else (there & ~new)
        if not ignore_not_found:
            conflict = new & ~there
    failed = F.raise_error(F.concat(F.lit(f"{operation} conflict on key "),
                                    F.to_json(F.struct(*keys)))).cast("boolean")
    kept = joined.where(F.when(conflict, failed).otherwise(keep))
    picked = [F.when(take, F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) for c in values]
    return kept.select(*keys, *picked).select(*target.columns)


# The change kind each named operation stands for.
OPERATIONS = {"INSERT": INSERT, "UPDATE": AFTER, "UPSERT": AFTER, "DELETE": DELETE}


def map_operations(rows: DataFrame, columns: Sequence[str], operation: str | Column,
                   op: str = "op") -> DataFrame:
    """Rows as changes of a table with ``columns``.

    ``operation`` names one operation for all rows, or is a user's expression
    giving each row's. Columns match by name; a missing one fails at once, and
    extra ones stay for ordering.
    """
    missing = [c for c in columns if c not in rows.columns]
    if missing:
        raise ValueError(f"rows lack the columns {missing}")
    if isinstance(operation, str):
        if operation not in OPERATIONS:
            raise ValueError(f"unknown operation {operation!r}")
        return rows.withColumn(op, F.lit(OPERATIONS[operation]))
    kinds = F.create_map(*[F.lit(x) for pair in OPERATIONS.items() for x in pair])
    return rows.withColumn(op, F.try_element_at(kinds, operation))


# ---- keys -------------------------------------------------------------------

def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that are null in a part or occur more than once, with their counts."""
    has_null = F.lit(False)
    for key in keys:
        has_null = has_null | F.col(key).isNull()
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counted.where((F.col("n") > 1) | has_null)


def require_key(df: DataFrame, keys: Sequence[str], hash_columns: Sequence[str] = (),
                insert_only: bool = False, check_rows: bool = False) -> DataFrame:
    """Refuse a table definition or content that breaks the key rules."""
    if not keys and not insert_only:
        raise ValueError("updates and deletes need a primary key")
    unknown = [c for c in (*keys, *hash_columns) if c not in df.columns]
    if unknown:
        raise ValueError(f"no such columns: {unknown}")
    outside = [c for c in hash_columns if c not in keys]
    if outside:
        raise ValueError(f"hash columns outside the key: {outside}")
    if check_rows and keys and not key_violations(df, keys).isEmpty():
        raise ValueError(f"null or repeated values of key {list(keys)}")
    return df
