"""Every catalogue query against its DuckDB oracle on the smallest tables."""

import pytest

from tests.conftest import SF_SMALL


def test_catalogue_matches_oracle(spark):
    from kintsugi.plans.verify import compare
    res = compare(spark, SF_SMALL, verbose=False)
    bad = {n: r for n, r in res.items() if "error" in r or not r.get("match", True)}
    assert not bad, bad
    assert not [n for n, r in res.items() if r["python"]]  # all of it runs in the JVM


def test_entry_contract(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
    from kintsugi.plans import catalog
    assert set(catalog.queries()) <= set(e.queries())


def test_filters_and_columns_reach_the_scan(spark):
    from kintsugi.plans import catalog
    plan = catalog.queries()["filter_eq_bool"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<o_orderkey:bigint>" in plan
    plan = catalog.queries()["log_running_cost"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "params_json" not in plan
