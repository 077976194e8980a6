"""Every registered query against its DuckDB oracle on the smallest scale
(the driver's own check runs the same comparison at sf0.01)."""

import importlib.util
import os

import duckdb
import pytest

import __spark_entry__ as E

from conftest import ROOT, SF001

_spec = importlib.util.spec_from_file_location("oracle_check", os.path.join(ROOT, "scripts", "oracle_check.py"))
oc = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(oc)

QUERIES = {k: f for k, f in E.queries().items() if k not in E.LLM_QUERIES}
SQLS = {k: q for k, q in E.oracle_sql().items() if k in QUERIES}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in oc.TABLES:
        p = f"{SF001}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_an_oracle_or_is_listed():
    assert set(QUERIES) == set(SQLS)


@pytest.mark.parametrize("name", sorted(SQLS))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF001)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(SQLS[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert oc.digest(df.columns, rows)[0] == oc.digest(ocols, orows)[0]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == 179
