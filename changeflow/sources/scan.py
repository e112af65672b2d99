"""Bounded table scans."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from changeflow.functions.number import whole_quotient
from changeflow.operators.predicates import all_of, project
from changeflow.sources.splits import range_bounds, split_range


def scan(spark: SparkSession, source: str | Sequence[str] | DataFrame,
         columns: Sequence[str] | None = None, where: Column | None = None,
         predicates: Iterable[tuple] = (), limit: int = -1, fmt: str = "parquet",
         schema: StructType | str | None = None,
         options: Mapping[str, str] | None = None) -> DataFrame:
    """Read ``columns`` of a table, filtered and limited.

    Filters stay in the plan and also reach the file reader as far as it can
    take them; only the asked columns are read. ``limit`` of -1 means none.
    """
    if isinstance(source, DataFrame):
        df = source
    else:
        reader = spark.read.format(fmt).options(**(options or {}))
        reader = reader.schema(schema) if schema else reader
        df = reader.load(source if isinstance(source, str) else list(source))
    terms = list(predicates)
    if terms:
        df = df.where(all_of(terms))
    if where is not None:
        df = df.where(where)
    if columns is not None:
        df = project(df, columns)
    return df if limit < 0 else df.limit(limit)


def literal_rows(spark: SparkSession, rows: Sequence[tuple], schema: StructType | str) -> DataFrame:
    """Typed literal rows."""
    return spark.createDataFrame(list(rows), schema)


def range_number(key: Column, lower: int, upper: int, n: int) -> Column:
    """Which of the ``n`` ranges of :func:`split_range` holds ``key``, as arithmetic.

    Spans that a bigint cannot hold are counted in decimals.
    """
    n, size, big = range_bounds(lower, upper, n)
    wide = upper - lower >= 1 << 62

    def whole(value: int) -> Column:
        return F.lit(Decimal(value)).cast("decimal(21,0)") if wide else F.lit(value)

    at = key.cast("decimal(21,0)" if wide else "bigint") - whole(lower)
    head = whole(big * size)
    in_head = whole_quotient(at, whole(size))
    if big == n or size == 1:
        return in_head.cast("int")
    in_tail = F.lit(big) + whole_quotient(at - head, whole(size - 1))
    return F.when(at < head, in_head).otherwise(in_tail).cast("int")


def scan_ranges(df: DataFrame, key: str, lower: int, upper: int, n: int,
                number: str | None = None) -> DataFrame:
    """The rows with ``lower <= key <= upper``; others and null keys are left out.

    Files already split the read, so the bounds go down as one filter. ``number``
    adds the range each row belongs to without moving any row.
    """
    split_range(lower, upper, 1)
    bounded = df.where(F.col(key).between(lower, upper))
    return bounded if number is None else bounded.withColumn(
        number, range_number(F.col(key), lower, upper, n))


def scan_shards(spark: SparkSession, paths: Sequence[str], key: str | None = None,
                lower: int | None = None, upper: int | None = None,
                columns: Sequence[str] | None = None) -> DataFrame:
    """The bag union of all shards, optionally with bounds on each of them.

    All shards go into one scan, whose tasks Spark packs by file size; a plan
    with a union branch per shard would grow with the number of shards.
    """
    if not paths:
        raise ValueError("a sharded table needs at least one shard")
    df = spark.read.parquet(*paths)
    if key is not None and lower is not None and upper is not None:
        df = df.where(F.col(key).between(lower, upper))
    return df if columns is None else project(df, columns)
