"""Every query against its SQL twin."""

import glob
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry_points
from changeflow.plans import catalog

RUNS, ORACLES = catalog.RUNS, catalog.ORACLES


@pytest.fixture(scope="module")
def oracle(sf_dir):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def shown(value):
    if pd.isna(value):
        return "<null>"
    if isinstance(value, float):
        return f"{value:.9g}"
    return str(value)


def rows(frame: pd.DataFrame) -> list[tuple]:
    names = sorted(frame.columns)
    return sorted(tuple(shown(v) for v in row) for row in frame[names].itertuples(index=False))


def test_every_query_has_an_oracle():
    assert sorted(RUNS) == sorted(ORACLES)


@pytest.mark.parametrize("name", sorted(RUNS))
def test_query(name, spark, sf_dir, oracle):
    ours = RUNS[name](spark, sf_dir)
    theirs = oracle.execute(ORACLES[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert rows(ours.toPandas()) == rows(theirs)


def test_entry_offers_every_query():
    assert set(RUNS) <= set(entry_points.queries())
    assert set(ORACLES) <= set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry(spark):
    assert entry_points.entry(spark).columns == ["dt", "event_type", "pv", "uv"]
