"""Every query with SQL against DuckDB on the smallest tables."""

import math
from datetime import date, datetime
from pathlib import Path

import duckdb
import pytest

from goldenloom.plans.catalog import ORACLE_SQL, QUERIES

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in Path(DATA).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


def plain(v):
    if isinstance(v, datetime) and (v.hour, v.minute, v.second, v.microsecond) == (0, 0, 0, 0):
        return str(v.date())
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.6g}"
    if isinstance(v, (datetime, date)):
        return str(v)
    return f"{float(v):.6g}" if not isinstance(v, (str, bool, type(None))) and hasattr(v, "__float__") and not isinstance(v, int) else str(v)


def rows(columns, found):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted(tuple(plain(r[k]) for k in order) for r in found)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    found = rows(df.columns, df.collect())
    if name in ORACLE_SQL:
        want = duck.execute(ORACLE_SQL[name])
        columns = [d[0] for d in want.description]
        assert sorted(df.columns) == sorted(columns)
        assert found == rows(columns, want.fetchall())
