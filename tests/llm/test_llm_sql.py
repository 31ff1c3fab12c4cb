"""The queries that have SQL, against DuckDB; and that every operator's query is registered."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__
from goldenloom.llm.queries import ORACLE_SQL, QUERIES

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    for f in Path(DATA).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    want = con.execute(ORACLE_SQL[name])
    columns = [d[0] for d in want.description]
    df = QUERIES[name](spark, DATA)
    assert sorted(df.columns) == sorted(columns)
    assert sorted(map(tuple, df.select(columns).collect())) == sorted(want.fetchall())


def test_all_are_registered():
    names = __spark_entry__.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)) and "pipeline" in names


def test_pipeline_over_the_smallest_tables(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    left, counts = docs, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, left, DATA).cache()
        assert left.columns == docs.columns, name
        counts.append(left.count())
    assert sorted(counts, reverse=True) == counts and counts[-1] > 0
    assert corpus_pipeline.run(spark, DATA).count() == counts[-1]
