"""Typed predicates, projections and simple row filters."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The operations a typed predicate may name.
_COMPARISONS = {
    "EQUAL": lambda c, v: c == v,
    "GREATER": lambda c, v: c > v,
    "GREATER_EQUAL": lambda c, v: c >= v,
    "LESS": lambda c, v: c < v,
    "LESS_EQUAL": lambda c, v: c <= v,
    "IS_IN": lambda c, v: c.isin(list(v)),
    "IS_NULL": lambda c, _: c.isNull(),
    "IS_NOT_NULL": lambda c, _: c.isNotNull(),
}


def predicate(column: str, op: str, value=None) -> Column:
    """One ``(column, op, value)`` term as a column expression."""
    if op not in _COMPARISONS:
        raise ValueError(f"unknown predicate operation {op!r}")
    return _COMPARISONS[op](F.col(column), value)


def all_of(terms: Iterable[tuple]) -> Column:
    """The conjunction of typed terms; no terms means true."""
    return reduce(and_, (predicate(*term) for term in terms), F.lit(True))


def project(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exactly ``columns``, in that order; unknown names fail before the job."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"no such columns: {missing}")
    return df.select(*columns)


def expand(df: DataFrame, struct: str, columns: Sequence[str] | None = None) -> DataFrame:
    """The fields of a struct column as top-level columns."""
    if columns is None:
        return df.select(f"{struct}.*")
    return df.select(*[F.col(f"{struct}.{c}").alias(c) for c in columns])


def union_streams(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Bag union by column name; works on batch and streaming frames."""
    return reduce(lambda a, b: a.unionByName(b), others, first)
