"""Queries of the subpackage that SQL can express, against DuckDB."""

import glob
import os

import duckdb
import pytest

from changeflow.llm.queries import ORACLES, RUNS

TABLES = ["/root/testdata/sf0.001", "/root/testdata/sf0.01"]


@pytest.mark.parametrize("folder", TABLES)
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(name, folder, spark):
    connection = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        table = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    ours = RUNS[name](spark, folder)
    theirs = connection.execute(ORACLES[name])
    names = sorted(ours.columns)
    order = {c[0]: i for i, c in enumerate(theirs.description)}
    assert sorted(order) == names
    want = sorted(str([row[order[n]] for n in names]) for row in theirs.fetchall())
    assert sorted(str([row[n] for n in names]) for row in ours.collect()) == want
