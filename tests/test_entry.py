"""Driver contract: entry runs, every query has a callable, oracle keys are a subset."""

import __spark_entry__ as E


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 4
    assert set(df.columns) == {"region", "observations", "healthy_pct", "suitable_pct"}


def test_registry_consistent():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 140
