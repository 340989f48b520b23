"""Typed CSV reader/sinks, the Parquet ledger and the aggregate-vs-base reconciliation."""
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from ledgerflow.operators import materialise, reconcile
from ledgerflow.sources import files


def test_typed_csv_round_trip_and_pandas_style_ints(spark, tmp_path):
    p = tmp_path / "tasks.csv"
    p.write_text(
        "close_task_id,company_code,fiscal_year,fiscal_period,task_id,period_end_date,due_date,"
        "actual_completion_date,completed_by_user_id,delay_working_days,extra\n"
        "1,CO0,2023,1,T01,2023-01-31,2023-02-01,2023-02-01,USR-F9C262,0.0,x\n"
        "2,CO0,2023,1,T12,2023-01-31,2023-02-07,,,,y\n")
    df = files.read_typed_csv(spark, "close_tasks", str(p))
    rows = df.orderBy("close_task_id").collect()
    assert rows[0].delay_working_days == 0 and rows[0].actual_completion_date.isoformat() == "2023-02-01"
    assert rows[1].actual_completion_date is None and rows[1].delay_working_days is None
    assert "extra" not in df.columns


def test_missing_column_is_an_error(spark, tmp_path):
    p = tmp_path / "company.csv"
    p.write_text("company_code,company_name\nCO0,X\n")
    with pytest.raises(files.MissingColumnError):
        files.read_typed_csv(spark, "company", str(p))


def test_csv_sink_writes_lower_case_booleans_and_empty_nulls(spark, tmp_path):
    df = spark.createDataFrame([(True, None, "a")], "b boolean, n string, s string")
    out = str(tmp_path / "out")
    files.write_csv(df, out)
    text = "".join(open(os.path.join(out, f)).read() for f in os.listdir(out) if f.endswith(".csv"))
    assert "true,,a" in text


def test_aggregate_served_views_equal_base_views(ctx):
    L = ctx.L
    res = reconcile.reconcile_many([
        ("pl", ctx.vj.transform(lambda v: __import__("ledgerflow.operators.kpis", fromlist=["x"]).pl_actuals(v)),
         materialise.pl_actuals_from_agg(ctx.agg, L.company, L.gl_account),
         ["company_code", "fiscal_year", "fiscal_period", "pl_section", "account_group"], "amount_group_currency", 0.0),
    ]).first()
    assert res.passed and res.missing_left == 0 and res.missing_right == 0


def test_parquet_ledger_round_trip(spark, ledger):
    from ledgerflow.plans.context import Ctx
    from ledgerflow.operators import kpis

    root = tempfile.mkdtemp(prefix="ledgerflow-test-")
    files.materialise_ledger(ledger, root)
    pq = files.ParquetLedger(spark, root)
    assert pq.dimension_rows["company"] == 5
    a = kpis.fx_impact(Ctx(spark, ledger_obj=pq).vj).agg(F.sum("fx_impact")).first()[0]
    b = kpis.fx_impact(Ctx(spark, ledger_obj=ledger).vj).agg(F.sum("fx_impact")).first()[0]
    assert a == b


def test_json_sink_single_file(spark, tmp_path):
    df = spark.createDataFrame([("CO0", 1.5)], "company_code string, value double")
    out = str(tmp_path / "json")
    files.write_json(df, out)
    parts = [f for f in os.listdir(out) if f.endswith(".json")]
    assert len(parts) == 1 and '"company_code":"CO0"' in open(os.path.join(out, parts[0])).read()


def test_no_published_view_exposes_user_columns(ctx):
    """QC20/PF10: published views carry no pseudonymous user column; L1/L2 do."""
    from ledgerflow.operators import kpis, publish

    L = ctx.L
    views = {
        "api_budget_variance": publish.api_budget_variance(ctx.variance, L.company, L.cost_center, L.programme,
                                                           L.gl_account),
        "api_close_monitor": publish.api_close_monitor(kpis.close_monitor(ctx.tasks_h, ctx.vj), L.company),
        "api_pl_actuals": publish.api_pl_actuals(kpis.pl_actuals(ctx.vj)),
        "api_ic_reconciliation": publish.api_ic_reconciliation(ctx.ic),
        "journal_interface": publish.journal_interface(L.journal, L.company, L.gl_account, L.cost_center,
                                                       L.programme),
    }
    assert publish.exposed_user_columns(views) == []
    assert publish.exposed_user_columns({"l2": ctx.vj}) == [("l2", "posting_user_id")]
