"""Every registered query against its SQL oracle (DuckDB) on sf0.001,
and the rows-only queries for a stable, non-failing run."""

import pytest

import __spark_entry__ as E
from devicegrid.operators import ml
from devicegrid.plans.compare import compare, duckdb_conn

SQLS = E.oracle_sql()
QUERIES = E.queries()


@pytest.fixture(scope="module", autouse=True)
def few_rounds():
    """Five boosting rounds instead of 300: enough for rows, columns and checks."""
    fit = ml.fit_fault_model
    ml.fit_fault_model = lambda train: fit(train, max_iter=5)
    yield
    ml.fit_fault_model = fit


@pytest.fixture(scope="module")
def con(sf_dir):
    return duckdb_conn(sf_dir)


def test_every_oracle_has_a_query():
    assert set(SQLS) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(n for n in SQLS if not n.startswith("op")))
def test_query_matches_oracle(spark, sf_dir, con, name):
    r = compare(spark, name, sf_dir, QUERIES, SQLS, con)
    assert r["status"] == "match", r


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n not in SQLS and not n.startswith(("op", "pipeline"))))
def test_rows_only_query_runs(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    assert df.count() > 0 or name == "dispatch_candidates"


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "cash_status" in df.columns
