"""Every query with SQL gives DuckDB's rows on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

from fluvia.plans import all_queries, all_sql


def plain(v):
    return float(f"{v:.9g}") if isinstance(v, float) and not math.isnan(v) else v


@pytest.fixture(scope="module")
def db(sf):
    db = duckdb.connect()
    for p in Path(sf).glob("*.parquet"):
        db.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    return db


@pytest.mark.parametrize("name", sorted(all_sql()))
def test_sql(spark, sf, db, name):
    df = all_queries()[name](spark, sf)
    cols = sorted(df.columns)
    want = db.sql("SELECT " + ", ".join(f'"{c}"' for c in cols) + f" FROM ({all_sql()[name]})").fetchall()
    got = [tuple(plain(r[c]) for c in cols) for r in df.collect()]
    assert sorted(got, key=str) == sorted((tuple(plain(v) for v in r) for r in want), key=str)


@pytest.mark.parametrize("name", sorted(set(all_queries()) - set(all_sql())))
def test_runs(spark, sf, name):
    assert all_queries()[name](spark, sf).count() > 0
