"""Driver contract and Spark-vs-DuckDB parity on sf0.001 for a representative set of queries.

``scripts/check_oracle.py`` runs every registered query; this test keeps the suite fast.
"""
import pytest

import __spark_entry__ as entry
from ledgerflow.plans.compare import compare

PARITY = [
    "pl_actuals", "budget_variance", "budget_variance_from_agg", "programme_runrate", "close_monitor",
    "fx_impact", "ic_reconciliation", "forecast_accuracy", "api_budget_variance", "api_programme_burn",
    "extract_budget_actual", "qc_journal_rules", "slow_closer", "variance_hierarchy_rollup", "l1_journal",
    "translate_amounts", "kpi_tiles",
]


def test_every_query_has_an_oracle():
    from ledgerflow.plans import registry

    q, o = registry.all_queries(), registry.all_oracles()
    assert len(q) >= 100
    assert set(q) == set(o)
    assert set(q) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() >= 0 and df.columns == ["programme_id", "actual", "budget"]


@pytest.mark.parametrize("name", PARITY)
def test_parity(spark, duck, name):
    from conftest import SF_SMALL

    df = entry.queries()[name](spark, SF_SMALL)
    res = compare(df, entry.oracle_sql()[name], duck)
    assert res["ok"], res
