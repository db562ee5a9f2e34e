"""Driver contract: stable entry schema, documented queries, aligned names."""

import __spark_entry__ as E


def test_entry_schema_is_stable(spark):
    a, b = E.entry(spark), E.entry(spark)
    assert a.schema == b.schema
    assert a.columns[:2] == ["atm_id", "event_date"]


def test_every_query_is_documented_and_callable():
    qs = E.queries()
    assert len(qs) == len(set(qs)) >= 50
    for name, fn in qs.items():
        assert callable(fn) and (fn.__doc__ or "").strip(), name


def test_oracle_sql_selects_named_columns():
    for name, sql in E.oracle_sql().items():
        assert sql.lstrip().upper().startswith("WITH"), name
        assert "SELECT" in sql.upper(), name
