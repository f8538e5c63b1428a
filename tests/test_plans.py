"""Every plan with an oracle gives the DuckDB oracle's rows (sf0.001); the
others run and return rows."""

import math
import os

import duckdb
import pytest

from conftest import SF001

import __spark_entry__ as entry

QUERIES = entry.queries()
ORACLES = entry.oracle_sql()
TABLES = ["documents", "labels", "events", "conversations", "pages", "benchmark", "embeddings"]


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else f"{round(v, 6):.6f}"
    return str(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF001, t)}.parquet')")
    return con


def test_every_plan_has_a_callable():
    assert len(QUERIES) >= 40
    assert set(ORACLES) <= set(QUERIES)


# Spark simple type name -> DuckDB type name
DUCK_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
              "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP"}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_plan_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF001)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(ORACLES[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _rows(df.columns, rows) == _rows(ocols, res.fetchall())
    spark_types = {f.name: DUCK_TYPES.get(f.dataType.simpleString(), f.dataType.simpleString())
                   for f in df.schema.fields}
    rel = duck.sql(ORACLES[name])
    assert spark_types == {c: str(t) for c, t in zip(rel.columns, rel.types)}


def test_entry_runs(spark):
    out = entry.entry(spark)
    assert out.count() == 1
    assert "accuracy" in out.columns
