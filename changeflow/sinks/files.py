"""Partitioned, sharded, routed and indexed file tables.

Layout writes rebalance on the partition columns: AQE joins small groups into
full-size files and splits a hot group over several tasks.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.functions.time import DAY, MONTH, with_time_parts
from changeflow.operators.changelog import BEFORE
from changeflow.operators.placement import with_shard
from changeflow.session import path_exists


def rebalanced(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of a partition value together, but never a hot value on one task."""
    return df.hint("rebalance", *[F.col(c) for c in columns])


def partition_names(spec: str) -> list[str]:
    """The columns of a partition spec such as ``a,${b=2}``.

    The value of a name written as ``${name=value}`` is taken from the row too.
    """
    parts = [p.strip() for p in spec.split(",") if p.strip()]
    return [re.sub(r"^\$\{\s*(\w+)\s*=.*\}$", r"\1", p) for p in parts]


def write_partitioned(df: DataFrame, path: str, spec: str | Sequence[str],
                      static: Mapping[str, object] | None = None, mode: str = "append",
                      max_records: int = 0) -> None:
    """Write by partition columns, which go last and leave the value columns.

    ``static`` sets a partition column to one literal. ``mode='overwrite'``
    replaces only the partitions the rows touch, and may be run again; an append
    that is run again adds its rows again.
    """
    columns = partition_names(spec) if isinstance(spec, str) else list(spec)
    if static:
        df = df.withColumns({c: F.lit(v) for c, v in static.items()})
        columns += [c for c in static if c not in columns]
    values = [c for c in df.columns if c not in columns]
    writer = rebalanced(df.select(*values, *columns), columns).write.mode(mode)
    (writer.option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", max_records)
     .partitionBy(*columns).parquet(path))


def write_time_partitioned(df: DataFrame, path: str, ms_col: str, zone: str = "UTC",
                           day: str = "dt", hour: str = "hr", mode: str = "append") -> None:
    """Write by the day and hour of an epoch-ms column; finishes with ``_SUCCESS``."""
    write_partitioned(with_time_parts(df, ms_col, zone, day, hour), path, [day, hour], mode=mode)


def write_sharded(df: DataFrame, path: str, strategy: str, n: int, key: str | None = None,
                  op: str | None = None) -> list[str]:
    """Write each row to the folder of its shard; returns the folders there are.

    A shard without rows has none. With an ``op`` column, -U rows are left out.
    """
    if op is not None:
        df = df.where(F.col(op) != BEFORE)
    placed = with_shard(df, strategy, n, key)
    rebalanced(placed, ["shard"]).write.mode("append").partitionBy("shard").parquet(path)
    folders = [f"{path}/shard={i}" for i in range(n)]
    return [folder for folder in folders if path_exists(df.sparkSession, folder)]


def save_table(df: DataFrame, name: str, partitions: Sequence[str] = (),
               path: str | None = None, fmt: str = "parquet") -> None:
    """Append to a table, creating it from the frame's schema when it is missing."""
    values = [c for c in df.columns if c not in partitions]
    rows = df.select(*values, *partitions)
    rows = rebalanced(rows, partitions) if partitions else rows
    writer = rows.write.format(fmt).mode("append")
    writer = writer.partitionBy(*partitions) if partitions else writer
    (writer.option("path", path) if path else writer).saveAsTable(name)


def save_bucketed(df: DataFrame, name: str, keys: Sequence[str], buckets: int,
                  path: str | None = None) -> None:
    """Write with rows hashed and sorted by key, so later joins on it need no shuffle.

    Rows come to the writers hashed the same way, so a bucket is one file, or
    several where a hot key made AQE split it.
    """
    missing = [k for k in keys if k not in df.columns]
    if not keys or missing:
        raise ValueError(f"bucketing needs key columns of the table, not {list(keys)}")
    guarded = df.where(F.when(any_null(keys), F.raise_error(
        F.lit("null in a key column")).cast("boolean")).otherwise(True))
    first, *others = keys
    writer = (guarded.hint("rebalance", buckets, *[F.col(k) for k in keys]).write.format("parquet").mode("overwrite")
              .bucketBy(buckets, first, *others).sortBy(first, *others))
    (writer.option("path", path) if path else writer).saveAsTable(name)


def any_null(columns: Sequence[str]) -> Column:
    term = F.lit(False)
    for column in columns:
        term = term | F.col(column).isNull()
    return term


def insert(df: DataFrame, table: str, overwrite: bool = False) -> None:
    """Insert by position; overwriting replaces the partitions the rows touch.

    Spark's own insert takes the mode of an overwrite from the session, which other
    writes share. So a partitioned table is overwritten in its folder, with the mode
    as an option of this write alone, and its new partitions are made known.
    """
    spark = df.sparkSession
    columns = spark.catalog.listColumns(table)
    parts = [c.name for c in columns if c.isPartition]
    if not overwrite or not parts:
        df.write.insertInto(table, overwrite=overwrite)
        return
    names = [c.name for c in columns]
    if len(df.columns) != len(names):
        raise ValueError(f"{table} has {len(names)} columns, not {len(df.columns)}")
    said = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    kinds = spark.table(table).schema
    rows = df.select(*[F.col(f"`{have}`").cast(kinds[name].dataType).alias(name)
                       for have, name in zip(df.columns, names)])
    rebalanced(rows, parts).write.format(said["Provider"]).mode("overwrite") \
        .option("partitionOverwriteMode", "dynamic").partitionBy(*parts).save(said["Location"])
    spark.catalog.recoverPartitions(table)
    spark.catalog.refreshTable(table)


def routed(df: DataFrame, prefix: str, db: str = "dbName", table: str = "tableName",
           body: str = "table_details") -> DataFrame:
    """``topic`` and ``value`` of each change, ready for a topic-aware sink."""
    topic = F.concat_ws(".", F.lit(prefix), F.col(db), F.col(table))
    return df.select(topic.alias("topic"), F.col(body).alias("value"))


def write_routed(df: DataFrame, path: str, prefix: str, **columns: str) -> None:
    """One folder of text lines per topic."""
    rebalanced(routed(df, prefix, **columns), ["topic"]).write.mode("append") \
        .partitionBy("topic").text(path)


def index_name(project: Column, day_text: Column) -> Column:
    """``project-yyyy-MM`` for a ``yyyy-MM-dd...`` text; null if either is null."""
    month = F.date_format(F.to_date(F.substring(day_text, 1, 10), DAY), MONTH)
    return F.concat(project, F.lit("-"), month)
