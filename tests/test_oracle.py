"""Every query that has SQL gives the same rows as DuckDB."""

from __future__ import annotations

import math
import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def db():
    if not Path(FOLDER).is_dir():
        pytest.skip("no test tables here")
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for p in Path(FOLDER).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    return con


def plain(value: object) -> object:
    if value is None or isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, bool):
        return value
    return round(float(value), 6) if hasattr(value, "__float__") else str(value)


def normal(columns: list[str], data: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in data), key=repr)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_same_rows(spark, db, name):
    ours = entry.queries()[name](spark, FOLDER)
    theirs = db.sql(entry.oracle_sql()[name])
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert normal(ours.columns, [tuple(r) for r in ours.collect()]) == normal(theirs.columns, theirs.fetchall())


def test_entry(spark):
    if not Path("/root/testdata/sf0.001").is_dir():
        pytest.skip("no test tables here")
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_runs(spark, name):
    if not Path(FOLDER).is_dir():
        pytest.skip("no test tables here")
    df = entry.queries()[name](spark, FOLDER)
    assert df.columns and (df.count() > 0 or name == "p10_found")  # few texts may hold no abuse
