"""Page views and unique visitors, and key profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.functions.time import DAY, DAY_HOUR


def bucket_of(ts: str, grain: str) -> Column:
    """The start of the day or hour: a fixed-width value that groups cheaply."""
    if grain == "day":
        return F.to_date(F.col(ts))
    if grain == "hour":
        return F.date_trunc("hour", F.col(ts))
    raise ValueError(f"grain must be day or hour, not {grain!r}")


def bucket_text(bucket: str | Column, grain: str) -> Column:
    return F.date_format(bucket, DAY if grain == "day" else DAY_HOUR)


def pv_uv(df: DataFrame, ts: str, by: Sequence[str], who: str, grain: str = "day") -> DataFrame:
    """``pv = count(*)`` and ``uv = count(distinct who)`` per time bucket and ``by``.

    Grouping runs on the truncated time and text is rendered once per result row.
    One distinct column lets Spark combine (group, who) pairs before the shuffle
    and spread a hot group over all tasks by ``who``.
    """
    counted = (
        df.groupBy(bucket_of(ts, grain).alias("_bucket"), *by)
        .agg(F.count(F.lit(1)).alias("pv"), F.count_distinct(F.col(who)).alias("uv"))
    )
    return counted.select(bucket_text("_bucket", grain).alias("dt"), *by, "pv", "uv")


def key_stats(df: DataFrame, key: str) -> DataFrame:
    """Min, max, row count and distribution factor of an integer key, in one pass.

    The factor is (max - min + 1) / rows, rounded up at the fourth decimal.
    """
    base = df.agg(F.min(key).alias("min_key"), F.max(key).alias("max_key"),
                  F.count(F.lit(1)).alias("row_count"))
    return base.withColumn("factor", factor_of())


def factor_of() -> Column:
    """The distribution factor from min_key, max_key and row_count."""
    span = (F.col("max_key").cast("decimal(38,0)") - F.col("min_key") + 1) * 10_000
    steps = F.floor((span + F.col("row_count") - 1) / F.nullif("row_count", F.lit(0)))
    return steps.cast("double") / 10_000
