"""Every registered query against its DuckDB oracle on the smallest tables
(row count, column names and an order-insensitive value hash), the same check
the driver runs at sf0.01."""

import hashlib

import pytest

import __spark_entry__ as entry
from basketflow.plans.registry import ORACLES, QUERIES
from tests.conftest import SF

duckdb = pytest.importorskip("duckdb")

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    yield c
    c.close()


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return repr(round(v, 6))
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return str(v)


def _digest(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.md5("\n".join(lines).encode()).hexdigest(), len(lines)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _digest(rows, df.columns) == _digest(res.fetchall(), ocols)


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES) and set(QUERIES) <= set(entry.queries())


def test_rf_auroc_two_ways_agree(spark):
    row = entry.queries()["rf_auroc"](spark, SF).first()
    assert row.agree == 1 and row.n_pos > 0 and row.n_neg > 0


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["item", "payload"]
    assert df.count() > 0
