"""KPI semantics pinned on hand-sized frames and on the sf0.001 demo ledger."""
import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerflow import config
from ledgerflow.operators import kpis, ledger as lg

D = dt.date


def test_days_to_close_is_null_while_open_never_zero(ctx):
    d = kpis.days_to_close(ctx.tasks_h)
    open_rows = d.where("is_open").collect()
    assert open_rows, "the slow entity's last period should be open"
    assert all(r.days_to_close is None for r in open_rows)
    assert d.where("NOT is_open AND days_to_close IS NULL").count() == 0


def test_late_flag_never_on_special_periods_and_means_entry_after_due(ctx):
    vj = ctx.vj
    assert vj.where("is_late_posting AND fiscal_period > 12").count() == 0
    t10 = ctx.L.close_tasks.where("task_id = 'T10'").select(
        "company_code", "fiscal_year", F.col("fiscal_period").alias("reporting_period"), "due_date")
    late = vj.where("is_late_posting").join(t10, ["company_code", "fiscal_year", "reporting_period"])
    assert late.where("entry_date <= due_date").count() == 0
    assert late.count() > 0


def test_variance_pct_null_where_budget_zero_and_unmatched_rows_survive(spark):
    keys = "company_code string, fiscal_year int, fiscal_period int, cost_center string, account_group string, " \
           "programme_key string"
    actual = spark.createDataFrame(
        [("CO0", 2000, 1, "CC1", "MAT", "P1", Decimal("100.00")),
         ("CO0", 2000, 1, "CC2", "MAT", "(none)", Decimal("50.00"))], keys + ", actual_amount decimal(18,2)")
    budget = spark.createDataFrame(
        [("CO0", 2000, 1, "CC1", "MAT", "P1", Decimal("80.00")),
         ("CO0", 2000, 1, "CC3", "MAT", "P1", Decimal("10.00"))], keys + ", budget_amount decimal(18,2)")
    rows = {r.cost_center: r for r in kpis.budget_variance(actual, budget).collect()}
    assert set(rows) == {"CC1", "CC2", "CC3"}
    assert rows["CC1"].variance == Decimal("20.00") and abs(rows["CC1"].variance_pct - 0.25) < 1e-12
    assert rows["CC2"].variance_pct is None and rows["CC2"].budget_amount == 0
    assert rows["CC3"].actual_amount == 0 and rows["CC3"].variance == Decimal("-10.00")


def test_runrate_finished_programme_has_no_remaining_and_eac_equals_actuals(ctx):
    rr = {r.programme_id: r for r in ctx.runrate(2000, 12, 3).collect()}
    furn = rr["PRG-FURN"]  # ended 1999-12-31
    assert furn.remaining_periods == 0 and furn.eac == furn.actuals_to_date


def test_runrate_window_uses_last_observed_periods(ctx):
    w1 = {r.programme_id: r.run_rate for r in ctx.runrate(window=1).collect()}
    w12 = {r.programme_id: r.run_rate for r in ctx.runrate(window=12).collect()}
    assert set(w1) == set(w12) and any(w1[k] != w12[k] for k in w1)


def test_fx_zero_for_group_currency_entities_and_identity(ctx):
    fx = kpis.fx_impact(ctx.vj)
    eur = fx.where("local_currency = 'EUR'").agg(F.sum("fx_impact").alias("s")).first().s
    assert eur == 0
    bad = fx.where(F.col("amount_at_actual_rate") - F.col("amount_at_budget_rate") != F.col("fx_impact"))
    assert bad.count() == 0
    assert fx.where("local_currency <> 'EUR' AND fx_impact <> 0").count() > 0


def test_mape_excludes_zero_actuals_and_horizon_at_least_one(ctx):
    rows = ctx.forecast_rows
    assert rows.where("actual = 0").count() == 0
    assert rows.where("horizon_periods < 1").count() == 0
    acc = kpis.forecast_accuracy(rows).collect()
    assert acc and all(r.mape >= 0 for r in acc)


def test_intercompany_key_is_ordered_and_threshold_zero_flags_more(ctx):
    ic = ctx.ic
    pairs = [r.ic_pair for r in ic.select("ic_pair").distinct().collect()]
    assert all(p.split("|")[0] < p.split("|")[1] for p in pairs)
    strict = kpis.ic_reconciliation(ctx.vj, 0).where("is_mismatch").count()
    assert strict > ic.where("is_mismatch").count()


def test_sign_rules_on_non_reversals(ctx):
    vj = ctx.vj.where("NOT is_reversal AND NOT is_intercompany")
    assert vj.where("account_group = 'REV' AND signed_amount_group > 0").count() == 0
    assert vj.where("account_group = 'PER' AND signed_amount_group < 0").count() == 0


def test_fx_chain_rounds_at_every_hop(spark):
    rates = spark.createDataFrame(
        [("GBP", "EUR", 2025, 1, "M", Decimal("1.168000")), ("USD", "EUR", 2025, 1, "M", Decimal("0.920000"))],
        "from_currency string, to_currency string, fiscal_year int, fiscal_period int, rate_type string, "
        "exchange_rate decimal(15,6)")
    df = spark.createDataFrame([(Decimal("1000.00"), "USD", "GBP", 2025, 1)],
                               "eur decimal(15,2), doc string, loc string, fiscal_year int, fiscal_period int")
    r = lg.translate_amounts(df, rates, "eur", "doc", "loc").first()
    doc = round(Decimal("1000.00") / Decimal("0.92"), 2)
    local = round(doc * Decimal("0.92") / Decimal("1.168"), 2)
    assert r.amount_doc_currency == doc
    assert r.amount_local_currency == local
    assert r.amount_group_currency == round(local * Decimal("1.168"), 2)


def test_schedule_elapsed_uses_whole_months(spark):
    df = spark.createDataFrame(
        [("P", D(2023, 1, 1), D(2027, 12, 31), Decimal("100.00"), Decimal("1000.00"))],
        "programme_id string, start_date date, end_date date, actuals_to_date decimal(18,2), "
        "total_budget_eur decimal(15,2)")
    r = kpis.programme_burn(df, D(2026, 6, 30)).first()
    assert r.pct_time_elapsed == round(41 / 59, 4) == 0.6949
    assert r.pct_budget_consumed == 0.1


def test_close_monitor_repeats_entity_measures_on_every_task(ctx):
    m = kpis.close_monitor(ctx.tasks_h, ctx.vj)
    per = m.groupBy("company_code", "fiscal_year", "fiscal_period").agg(
        F.countDistinct("line_count").alias("n"), F.count(F.lit(1)).alias("tasks"))
    assert per.where("n > 1").count() == 0
    assert per.where(F.col("tasks") != len(config.CLOSE_TASKS)).count() == 0


def test_long_documents_keep_unique_keys_and_gapless_lines(spark, tmp_path):
    """Two documents of 1,500 lines in neighbouring entities, and amounts a million times larger."""
    import shutil

    from ledgerflow.operators import quality
    from ledgerflow.sources.demo import DemoLedger

    folder = tmp_path / "sf"
    folder.mkdir()
    for t in ("region", "nation", "customer", "supplier", "part", "orders"):
        shutil.copy(f"/root/testdata/sf0.001/{t}.parquet", folder)
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    order = li.agg(F.min("l_orderkey")).first()[0]
    supp = spark.read.parquet("/root/testdata/sf0.001/supplier.parquet").join(
        spark.read.parquet("/root/testdata/sf0.001/nation.parquet"), F.col("s_nationkey") == F.col("n_nationkey"))
    one, two = (supp.where(F.col("n_regionkey") == r).agg(F.min("s_suppkey")).first()[0] for r in (1, 2))
    many = li.where(F.col("l_orderkey") == order).limit(1).crossJoin(spark.range(1500)).withColumn(
        "l_linenumber", F.col("id").cast(li.schema["l_linenumber"].dataType))
    li = li.withColumn("l_extendedprice", F.col("l_extendedprice") * 1e6)
    for s in (one, two):
        li = li.unionByName(many.withColumn("l_suppkey", F.lit(s).cast(li.schema["l_suppkey"].dataType)).select(*li.columns))
    li.write.parquet(str(folder / "lineitem.parquet"))
    L = DemoLedger(spark, str(folder))
    assert L.journal.groupBy("journal_id").count().where("count > 1").count() == 0
    lines = L.journal_base.groupBy("document_number").agg(F.count(F.lit(1)).alias("n"), F.max("document_line").alias("last"))
    assert lines.where("n <> last").count() == 0 and lines.agg(F.max("n")).first()[0] >= 1500
    assert quality.primary_key_rule(L.journal, "journal", ["journal_id"]).first()["violations"] == 0
    # planned sums and ratios hold far beyond 64 bits of cents
    from ledgerflow.plans.context import Ctx

    for r in Ctx(spark, ledger_obj=L).runrate().collect():
        assert r.eac is not None and abs(float(r.eac)) > 1e9


def test_phased_budget_sums_back_to_the_annual_budget(ctx):
    x = ctx.budget_cells.groupBy("company_code", "fiscal_year", "cost_center", "account_group", "programme_key").agg(
        F.sum("budget_amount").alias("s"), F.max("amount_annual").alias("a"), F.count(F.lit(1)).alias("n"))
    assert x.where((F.round("s", 2) != F.col("a")) | (F.col("n") != 12)).count() == 0


def test_run_rate_is_not_rounded_before_eac(spark):
    monthly = spark.createDataFrame([("P", 200001, Decimal("0.01")), ("P", 200002, Decimal("0.01")), ("P", 200003, Decimal("0.00"))],
                                    "programme_id string, period_key int, period_cost decimal(18,2)")
    programme = spark.createDataFrame([("P", "n", "t", D(2000, 1, 1), D(2010, 3, 31), "CO0", "ACTIVE", Decimal("100.00"))],
                                      "programme_id string, programme_name string, programme_type string, start_date date, "
                                      "end_date date, lead_company_code string, status string, total_budget_eur decimal(28,2)")
    r = kpis.runrate_from_monthly(monthly, programme, 2000, 3, 3).first()
    assert r.remaining_periods == 120 and abs(float(r.eac) - (0.02 + 0.02 / 3 * 120)) < 1e-5


def test_fx_carryover_only_where_reversals_post(ctx):
    rows = kpis.fx_reversal_carryover(ctx.vj)
    assert rows.where("reversal_lines = 0").count() == 0
    assert kpis.fx_reversal_carryover(ctx.vj.where("not is_reversal")).count() == 0


def test_forecast_covers_every_combination_and_knows_the_base(spark, ctx):
    from ledgerflow.operators import plan

    journal = spark.createDataFrame(
        [("C", 2000, p, "CC1", None, "S", Decimal(a), False) for p, a in ((10, "60000.00"), (11, "30000.00"))],
        "company_code string, fiscal_year int, fiscal_period int, cost_center string, programme_id string, "
        "debit_credit_ind string, amount_group_currency decimal(15,2), is_reversal boolean")
    got = {(r.version, r.fiscal_period): float(r.amount_group_currency)
           for r in plan.forecast_build(journal, ctx.L.dim_date, ctx.L.fiscal_span).collect()}
    assert len(got) == 9 + 6 + 3  # no posting up to any snapshot, yet all are forecast
    mean = 45000.0
    assert got[("FC-Q3", 12)] == mean                      # unknown period: the year's mean
    assert got[("FC-Q3", 10)] == round(60000 + (mean - 60000) * 1 / 12, 2)
    assert got[("FC-Q1", 11)] == round(30000 + (mean - 30000) * 8 / 12, 2)
