"""Every query against its SQL on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from sieveline.plans import core, reference, triage


def value(v):
    return round(float(v), 6) if isinstance(v, float) or type(v).__name__ == "Decimal" else v


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for f in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def test_names_agree():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(n for catalog in (core, reference, triage) for n in catalog.ORACLE))
def test_query_equals_sql(spark, sf, duck, name):
    df = entry.queries()[name](spark, sf)
    got = df.collect()
    cur = duck.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in cur.description]
    assert sorted(columns) == sorted(df.columns)
    want = sorted((tuple(value(r[columns.index(c)]) for c in sorted(columns)) for r in cur.fetchall()), key=repr)
    assert sorted((tuple(value(r[c]) for c in sorted(columns)) for r in got), key=repr) == want


@pytest.mark.parametrize("name", sorted(n for catalog in (core, reference, triage) for n in catalog.QUERIES if n not in catalog.ORACLE))
def test_query_runs(spark, sf, name):
    df = entry.queries()[name](spark, sf)
    assert df.columns and df.count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
