"""Driver contract: entry() runs; every query has a unique name; oracle keys are a subset."""

import __spark_entry__ as entry


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "target" in df.columns


def test_registry_shape():
    qs, sql = entry.queries(), entry.oracle_sql()
    assert len(qs) >= 80
    assert set(sql) <= set(qs)
