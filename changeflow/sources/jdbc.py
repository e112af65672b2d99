"""Tables behind JDBC. Spark's own reader and writer do the work."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from changeflow.sources.splits import plan_splits


def range_predicates(column: str, lower: int, upper: int, n: int) -> list[str]:
    """One inclusive condition per partition.

    The reader's own lowerBound/upperBound only place the cuts and keep rows
    outside, so the bounds are given as conditions.
    """
    return [f"{column} BETWEEN {s.lower} AND {s.upper}"
            for s in plan_splits((), n, lower, upper)]


def jdbc_scan(spark: SparkSession, url: str, table: str, schema: StructType | str | None = None,
              predicates: Sequence[str] | None = None, fetch: int = 10_000,
              properties: Mapping[str, str] | None = None) -> DataFrame:
    """Read a table; each predicate is one partition with its own connection."""
    options = {"fetchsize": str(fetch), **(properties or {})}
    if schema is not None:
        ddl = schema if isinstance(schema, str) else schema.toDDL()
        options["customSchema"] = ddl
    if predicates:
        return spark.read.jdbc(url, table, predicates=list(predicates), properties=options)
    return spark.read.jdbc(url, table, properties=options)


def jdbc_scan_shards(spark: SparkSession, urls: Sequence[str], table: str,
                     column: str | None = None, lower: int | None = None,
                     upper: int | None = None, n: int | None = None,
                     properties: Mapping[str, str] | None = None) -> DataFrame:
    """The bag union of a table's shards, each read in its planned ranges."""
    splits = plan_splits(urls, n, lower, upper)
    frames = []
    for url in urls:
        mine = [s for s in splits if url in s.shards]
        conditions = [f"{column} BETWEEN {s.lower} AND {s.upper}" for s in mine
                      if s.lower is not None]
        frames.append(jdbc_scan(spark, url, table, predicates=conditions or None,
                                properties=properties))
    first, *others = frames
    for other in others:
        first = first.unionByName(other)
    return first


def jdbc_write(df: DataFrame, url: str, table: str, batch: int = 1000, connections: int = 32,
               properties: Mapping[str, str] | None = None) -> None:
    """Append rows in batches, over ``connections`` connections.

    The exchange keeps the work before it as parallel as it was.
    """
    df.repartition(connections).write.jdbc(
        url, table, mode="append", properties={"batchsize": str(batch), **(properties or {})})
