"""The list of queries, each with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Run = Callable[[SparkSession, str], DataFrame]

RUNS: dict[str, Run] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Run], Run]:
    """Register a query; without ``oracle`` it is checked by the tests alone."""
    def register(run: Run) -> Run:
        if name in RUNS:
            raise ValueError(f"query {name} is registered twice")
        RUNS[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return run
    return register


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
