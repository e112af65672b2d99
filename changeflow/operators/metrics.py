"""Counting rows on their way, without another pass."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def counted(df: DataFrame, name: str = "rows",
            measures: Mapping[str, Column] | None = None) -> tuple[DataFrame, Observation]:
    """The same rows, and an observation with their number once a job has run.

    Works in batch; a stream reports the same metrics in its progress under
    ``name`` when observed with :func:`watched`.
    """
    seen = Observation(name)
    return df.observe(seen, *_measures(measures)), seen


def watched(df: DataFrame, name: str = "rows",
            measures: Mapping[str, Column] | None = None) -> DataFrame:
    """The same for a stream: each batch's numbers are in the query's progress."""
    return df.observe(name, *_measures(measures))


def _measures(measures: Mapping[str, Column] | None) -> list[Column]:
    extra = [measure.alias(label) for label, measure in (measures or {}).items()]
    return [F.count(F.lit(1)).alias("n"), *extra]
