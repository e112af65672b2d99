"""Keep bad rows apart from good ones."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.operators.conform import foreign_type, misfits
from changeflow.operators.metrics import counted

REASON = "_reason"


def judge(df: DataFrame, columns: Mapping[str, str] | None = None,
          rules: Mapping[str, Column] | None = None) -> DataFrame:
    """Add why a row is bad (null for good rows).

    A row is bad when a value does not fit its declared type or a rule is not
    true for it.
    """
    reasons = []
    if columns:
        reasons += [F.when(misfits(df, {c: t}), F.lit(f"type:{c}")) for c, t in columns.items()]
    for name, holds in (rules or {}).items():
        reasons.append(F.when(~F.coalesce(holds, F.lit(False)), F.lit(f"rule:{name}")))
    found = F.concat_ws(",", *reasons) if reasons else F.lit("")
    return df.withColumn(REASON, F.nullif(found, F.lit("")))


def write_with_quarantine(df: DataFrame, path: str, columns: Mapping[str, str] | None = None,
                          rules: Mapping[str, Column] | None = None,
                          on_failure: Callable[[DataFrame], object] | None = None) -> dict:
    """Write good rows and bad rows in one pass, in folders ``is_bad=0`` and ``is_bad=1``.

    Rows keep their raw values; :func:`good_rows` applies the types on reading.
    ``on_failure`` then gets the bad rows, if there are any. Returns how many rows
    were ``good`` and ``bad``, counted on their way.
    """
    bad = F.col(REASON).isNotNull()
    judged, seen = counted(judge(df, columns, rules), "judged", {
        "good": F.count(F.when(~bad, 1)), "bad": F.count(F.when(bad, 1))})
    (judged.withColumn("is_bad", bad.cast("int"))
     .write.mode("append").partitionBy("is_bad").parquet(path))
    numbers = {name: seen.get[name] for name in ("good", "bad")}
    if on_failure is not None and numbers["bad"]:
        on_failure(bad_rows(df.sparkSession, path))
    return numbers


def good_rows(spark: SparkSession, path: str,
              columns: Mapping[str, str] | None = None) -> DataFrame:
    rows = spark.read.parquet(path).where("is_bad = 0").drop(REASON, "is_bad")
    if not columns:
        return rows
    others = [c for c in rows.columns if c not in columns]
    return rows.select(*others, *[F.col(c).try_cast(foreign_type(t)).alias(c)
                                  for c, t in columns.items()])


def bad_rows(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).where("is_bad = 1").drop("is_bad")


def raise_on_failure(bad: DataFrame) -> None:
    """The default policy: stop, naming how many rows are bad and some of them."""
    shown = [r.asDict() for r in bad.limit(20).collect()]
    raise ValueError(f"{bad.count()} bad rows, for example {shown}")
