"""Registered queries: calendar, FX, ledger derivations, planning, L1 contracts and sources."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config, schemas
from ..functions.columns import money, period_end_date, period_key, programme_key
from ..operators import calendar as cal
from ..operators import ledger, plan
from ..sources import files
from .catalog import M, money_cols, register
from .context import Ctx
from .oracle_preamble import BUDGET_CENTS, half_up

# ======================================================================== calendar
@register("holidays", "SELECT holiday_date FROM holidays")
def q_holidays(ctx: Ctx) -> DataFrame:
    """CA1 — fixed and Easter-relative holidays of the calendar window."""
    return cal.holidays(ctx.L.calendar_years)


@register("dim_date", "SELECT * FROM dim_date")
def q_dim_date(ctx: Ctx) -> DataFrame:
    """CA2/WN1/WN3 — daily calendar with fiscal attributes and working-day counters."""
    return ctx.L.dim_date


@register("working_days_in_period", """
SELECT fiscal_year, fiscal_period, CAST(sum(CASE WHEN is_working_day THEN 1 ELSE 0 END) AS BIGINT) AS working_days
FROM dim_date GROUP BY fiscal_year, fiscal_period
""")
def q_wd_in_period(ctx: Ctx) -> DataFrame:
    """CA5 — working days per fiscal period."""
    return cal.working_days_in_period(ctx.L.dim_date)


@register("covered_periods", "SELECT * FROM covered")
def q_covered(ctx: Ctx) -> DataFrame:
    """CA6 — closed regular periods; the final year stops early."""
    return ctx.L.periods


@register("next_period_map", """
SELECT fiscal_year, fiscal_period,
       lead(fiscal_year) OVER (ORDER BY fiscal_year, fiscal_period) AS next_fiscal_year,
       lead(fiscal_period) OVER (ORDER BY fiscal_year, fiscal_period) AS next_fiscal_period
FROM covered
""")
def q_next_period(ctx: Ctx) -> DataFrame:
    """WN7 — next covered period per period; the last has none."""
    return cal.next_period_map(ctx.L.periods)


@register("nth_working_day", """
, pe AS (SELECT c.fiscal_year, c.fiscal_period, last_day(make_date(c.fiscal_year, c.fiscal_period, 1)) AS period_end_date,
                CAST(n.range AS INTEGER) AS n
         FROM covered c, range(1, 6) n)
SELECT pe.fiscal_year, pe.fiscal_period, pe.period_end_date, pe.n, w.working_date AS nth_working_day
FROM pe LEFT JOIN dim_date d ON d.date_id = pe.period_end_date LEFT JOIN wd w ON w.wd_seq = d.working_day_seq + pe.n
""")
def q_nth_wd(ctx: Ctx) -> DataFrame:
    """CA4/WN6 — the 1st..5th working day after every covered period end."""
    p = ctx.L.periods.withColumn("period_end_date", period_end_date()) \
        .select("*", F.explode(F.sequence(F.lit(1), F.lit(5))).alias("n"))
    return cal.nth_working_day(p, "period_end_date", "n", ctx.L.dim_date)


@register("working_days_between", """
SELECT c.close_task_id, dd.working_day_seq - dp.working_day_seq AS wd_to_due,
       da.working_day_seq - dp.working_day_seq AS wd_to_completion
FROM close_tasks c
LEFT JOIN dim_date dp ON dp.date_id = c.period_end_date
LEFT JOIN dim_date dd ON dd.date_id = c.due_date
LEFT JOIN dim_date da ON da.date_id = c.actual_completion_date
""")
def q_wd_between(ctx: Ctx) -> DataFrame:
    """CA3 — working days from period end to due date and to completion (half-open interval)."""
    t = ctx.L.close_tasks.select("close_task_id", "period_end_date", "due_date", "actual_completion_date")
    t = cal.working_days_between(t, "period_end_date", "due_date", ctx.L.dim_date, "wd_to_due")
    t = cal.working_days_between(t, "period_end_date", "actual_completion_date", ctx.L.dim_date, "wd_to_completion")
    return t.select("close_task_id", "wd_to_due", "wd_to_completion")


@register("next_working_day", """
SELECT m.date_id AS month_start, w.working_date AS next_working_day
FROM dim_date m
LEFT JOIN dim_date d ON d.date_id = m.date_id - 1
LEFT JOIN wd w ON w.wd_seq = d.working_day_seq + 1
WHERE m.day_of_month = 1
""")
def q_next_wd(ctx: Ctx) -> DataFrame:
    """CA7 — first working day on or after the first day of every month."""
    m = ctx.L.dim_date.where(F.col("day_of_month") == 1).select(F.col("date_id").alias("month_start"))
    return cal.next_working_day(m, "month_start", ctx.L.dim_date)


# ======================================================================== FX
@register("fx_rate_pair", """
SELECT from_currency, to_currency, fiscal_year, fiscal_period, CAST(rate_actual AS DOUBLE) AS rate_actual,
       CAST(rate_budget AS DOUBLE) AS rate_budget FROM fx_pair
""")
def q_fx_pair(ctx: Ctx) -> DataFrame:
    """FX1/AG3 — actual and budget rate side by side."""
    r = ledger.fx_rate_pair(ctx.L.rates)
    return r.withColumn("rate_actual", F.col("rate_actual").cast("double")).withColumn(
        "rate_budget", F.col("rate_budget").cast("double"))


@register("rate_lookup", """
SELECT n.local_currency, n.fiscal_year, n.fiscal_period, CAST(r.exchange_rate AS DOUBLE) AS rate
FROM (SELECT DISTINCT local_currency, fiscal_year, fiscal_period FROM journal) n
LEFT JOIN rates_m r ON r.from_currency = n.local_currency AND r.fiscal_year = n.fiscal_year
                   AND r.fiscal_period = least(n.fiscal_period, 12)
""")
def q_rate_lookup(ctx: Ctx) -> DataFrame:
    """FX2 — the actual rate every journal (currency, year, period) needs; specials use period 12."""
    need = ctx.L.journal.select("local_currency", "fiscal_year", "fiscal_period").distinct()
    out = ledger.rate_lookup(need, ctx.L.rates, "local_currency")
    return out.withColumn("rate", F.col("rate").cast("double"))


@register("budget_rate_freeze", """
SELECT m.from_currency, m.fiscal_year, CAST(m.exchange_rate AS DOUBLE) AS frozen_rate,
       bool_and(b.exchange_rate = m.exchange_rate) AS matches_budget_rate
FROM rates m JOIN rates b ON b.from_currency = m.from_currency AND b.fiscal_year = m.fiscal_year AND b.rate_type = 'B'
WHERE m.rate_type = 'M' AND m.fiscal_period = 1
GROUP BY m.from_currency, m.fiscal_year, m.exchange_rate
""")
def q_budget_rate_freeze(ctx: Ctx) -> DataFrame:
    """FX3 — budget rate = the fiscal year's opening actual rate, flat over the year."""
    from pyspark.sql import Window

    r = ctx.L.rates
    w = Window.partitionBy("from_currency", "fiscal_year").orderBy("fiscal_period") \
        .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    m = r.where(F.col("rate_type") == "M").withColumn("frozen_rate", F.first("exchange_rate").over(w))
    frozen = m.select("from_currency", "fiscal_year", "frozen_rate").distinct()
    b = r.where(F.col("rate_type") == "B").select("from_currency", "fiscal_year", F.col("exchange_rate").alias("b"))
    j = frozen.join(b, ["from_currency", "fiscal_year"])
    return j.groupBy("from_currency", "fiscal_year", "frozen_rate").agg(
        F.bool_and(F.col("b") == F.col("frozen_rate")).alias("matches_budget_rate")
    ).withColumn("frozen_rate", F.col("frozen_rate").cast("double"))


_FX4_DOC = half_up("CAST(f.amount_group_currency * 100 AS HUGEINT) * 1000000", "CAST(r.exchange_rate * 1000000 AS HUGEINT)")


@register("translate_amounts", f"""
, t0 AS (
  SELECT f.company_code, f.cost_center, f.programme_id, f.fiscal_year, f.fiscal_period, f.version,
         co.local_currency, r.exchange_rate AS rate, {_FX4_DOC} AS doc_cents,
         CAST(r.exchange_rate * 1000000 AS HUGEINT) AS micro
  FROM forecast f JOIN company co ON co.company_code = f.company_code
  LEFT JOIN rates_m r ON r.from_currency = co.local_currency AND r.fiscal_year = f.fiscal_year
                     AND r.fiscal_period = f.fiscal_period
),
t1 AS (
  SELECT *, {half_up('doc_cents * micro', 'micro')} AS local_cents FROM t0
)
SELECT company_code, cost_center, programme_id, fiscal_year, fiscal_period, version, local_currency,
       CAST(CAST(doc_cents AS DECIMAL(20, 0)) * 0.01 AS DOUBLE) AS amount_doc_currency,
       CAST(CAST(local_cents AS DECIMAL(20, 0)) * 0.01 AS DOUBLE) AS amount_local_currency,
       CAST(round(CAST(CAST(local_cents AS DECIMAL(20, 0)) * 0.01 AS DECIMAL(15, 2)) * rate, 2) AS DOUBLE)
         AS amount_group_currency
FROM t1
""")
def q_translate(ctx: Ctx) -> DataFrame:
    """FX4 — forecast EUR amounts into each entity's currency, rounded to cents at every hop."""
    co = ctx.L.company.select("company_code", "local_currency")
    f = ctx.L.forecast.join(F.broadcast(co), "company_code").withColumnRenamed(
        "amount_group_currency", "eur").withColumn("doc_ccy", F.col("local_currency"))
    out = ledger.translate_amounts(f, ctx.L.rates, "eur", "doc_ccy", "local_currency")
    return money_cols(out.select("company_code", "cost_center", "programme_id", "fiscal_year", "fiscal_period",
                                 "version", "local_currency", "amount_doc_currency", "amount_local_currency",
                                 "amount_group_currency"),
                      "amount_doc_currency", "amount_local_currency", "amount_group_currency")


@register("fx_reversal_carryover", f"""
SELECT company_code, fiscal_year, reporting_period AS fiscal_period,
       {M('sum(signed_amount_group - round(signed_amount_at_actual_rate, 2))')} AS carryover,
       CAST(sum(CASE WHEN is_reversal THEN 1 ELSE 0 END) AS BIGINT) AS reversal_lines
FROM v_journal GROUP BY company_code, fiscal_year, reporting_period
HAVING sum(signed_amount_group - round(signed_amount_at_actual_rate, 2)) <> 0
""")
def q_fx_carryover(ctx: Ctx) -> DataFrame:
    """FX8 — booked minus recomputed group amount (non-zero where reversals carried an old rate)."""
    from ..operators import kpis

    return money_cols(kpis.fx_reversal_carryover(ctx.vj), "carryover")


# ======================================================================== ledger
_VJ_MONEY = ["amount_doc_currency", "amount_local_currency", "amount_group_currency", "signed_amount_group",
             "signed_amount_local", "signed_amount_at_actual_rate", "signed_amount_at_budget_rate"]
_VJ_COLS = [
    "journal_id", "company_code", "company_name", "country_key", "document_number", "document_line",
    "document_type", "posting_date", "document_date", "entry_date", "fiscal_year", "fiscal_period",
    "reporting_period", "gl_account", "gl_account_name", "account_group", "account_group_name", "pl_section",
    "cost_center", "cost_center_name", "division_id", "division_name", "department_id", "department_name",
    "is_overhead", "programme_id", "programme_name", "programme_type", "debit_credit_ind", "doc_currency",
    "amount_doc_currency", "local_currency", "amount_local_currency", "group_currency", "amount_group_currency",
    "signed_amount_group", "signed_amount_local", "signed_amount_at_actual_rate", "signed_amount_at_budget_rate",
    "rate_actual", "rate_budget", "is_manual_posting", "is_late_posting", "is_intercompany", "ic_partner_company",
    "ic_pair", "posting_user_id", "is_reversal", "reversed_document",
]


def _vj_sql_col(c: str) -> str:
    if c in _VJ_MONEY:
        return f"{M(c)} AS {c}"
    if c in ("rate_actual", "rate_budget"):
        return f"CAST({c} AS DOUBLE) AS {c}"
    return c


@register("harmonised_journal", "SELECT " + ", ".join(_vj_sql_col(c) for c in _VJ_COLS) + " FROM v_journal")
def q_harmonised(ctx: Ctx) -> DataFrame:
    """LG5/JN1-JN4/FX5 — the harmonised journal (signed, flagged, re-translated, described)."""
    vj = ctx.vj
    return money_cols(vj, *_VJ_MONEY).withColumn("rate_actual", F.col("rate_actual").cast("double")) \
        .withColumn("rate_budget", F.col("rate_budget").cast("double"))


@register("journal_flags", f"""
SELECT journal_id, reporting_period, {M('signed_amount_group')} AS signed_amount_group,
       {M('signed_amount_local')} AS signed_amount_local, is_manual_posting, is_late_posting, ic_pair
FROM v_journal
""")
def q_flags(ctx: Ctx) -> DataFrame:
    """LG1-LG4/CA8 — signed amounts, manual and late flags, pair key, reporting period per line."""
    return money_cols(ctx.vj.select("journal_id", "reporting_period", "signed_amount_group", "signed_amount_local",
                                    "is_manual_posting", "is_late_posting", "ic_pair"),
                      "signed_amount_group", "signed_amount_local")


_DERIVED_COLS = ("company_code, document_number, document_line, posting_date, fiscal_year, fiscal_period, "
                 "debit_credit_ind, local_currency, {m1} AS amount_local_currency, {m2} AS amount_group_currency, "
                 "ic_partner_company, reversed_document").format(
    m1=M("amount_local_currency"), m2=M("amount_group_currency"))
_DERIVED_SPARK = ["company_code", "document_number", "document_line", "posting_date", "fiscal_year",
                  "fiscal_period", "debit_credit_ind", "local_currency", "amount_local_currency",
                  "amount_group_currency", "ic_partner_company", "reversed_document"]


@register("accrual_reversals", f"SELECT {_DERIVED_COLS} FROM j_rev")
def q_reversals(ctx: Ctx) -> DataFrame:
    """LG7 — next-period reversals of accrual (SB) lines, amounts carried over."""
    r = ledger.accrual_reversals(ctx.L.journal_base, ctx.L.rates, ctx.L.company, ctx.L.dim_date, ctx.L.last_covered)
    return money_cols(r.select(*_DERIVED_SPARK), "amount_local_currency", "amount_group_currency")


@register("intercompany_mirrors", f"SELECT {_DERIVED_COLS} FROM j_mirror")
def q_mirrors(ctx: Ctx) -> DataFrame:
    """LG8 — partner-side mirror lines of intercompany postings."""
    m = ledger.intercompany_mirrors(ctx.L.journal_base, ctx.L.rates, ctx.L.company, ctx.L.dim_date)
    return money_cols(m.select(*_DERIVED_SPARK), "amount_local_currency", "amount_group_currency")


@register("journal_with_derived", f"""
SELECT company_code,
       CASE WHEN is_reversal THEN 'reversal' WHEN document_number LIKE 'M%' THEN 'mirror' ELSE 'original' END AS kind,
       count(*) AS line_count, {M('sum(amount_group_currency)')} AS amount_group_currency
FROM journal GROUP BY ALL
""")
def q_with_derived(ctx: Ctx) -> DataFrame:
    """ST3 — journal = originals + mirrors + reversals; lines and amount per entity and kind."""
    j = ctx.L.journal
    kind = F.when(F.col("is_reversal"), "reversal").when(F.col("document_number").startswith("M"), "mirror") \
        .otherwise("original")
    return j.groupBy("company_code", kind.alias("kind")).agg(
        F.count(F.lit(1)).alias("line_count"), money(F.sum("amount_group_currency")).alias("amount_group_currency"))


@register("active_programme_window", """
SELECT p.programme_id, c.fiscal_year, c.fiscal_period,
       p.start_date <= last_day(make_date(c.fiscal_year, c.fiscal_period, 1))
       AND p.end_date >= make_date(c.fiscal_year, c.fiscal_period, 1) AS is_programme_active
FROM programme p, covered c
""")
def q_active_window(ctx: Ctx) -> DataFrame:
    """LG9 — is each programme running in each covered period (interval overlap)."""
    every = ctx.L.periods.agg(F.collect_list(F.struct("fiscal_year", "fiscal_period")).alias("p"))  # one row a month
    master = ctx.L.programme_master
    g = master.select("programme_id").join(F.broadcast(every)).select("programme_id", F.explode("p").alias("p")).select(
        "programme_id", "p.fiscal_year", "p.fiscal_period")
    g = g.withColumn("period_start", F.make_date("fiscal_year", "fiscal_period", F.lit(1))) \
        .withColumn("period_end", period_end_date())
    return ledger.active_programme_window(g, master).select(
        "programme_id", "fiscal_year", "fiscal_period", "is_programme_active")


@register("narrow_cost_projection", f"""
SELECT j.company_code, j.fiscal_year, least(j.fiscal_period, 12) AS fiscal_period, j.cost_center, j.programme_id,
       a.account_group, a.pl_section,
       {M("CASE WHEN j.debit_credit_ind = 'S' THEN j.amount_group_currency ELSE -j.amount_group_currency END")}
         AS signed_amount_group,
       j.document_type IN ('SA', 'SB') AS is_manual_posting
FROM journal j JOIN gl_account a ON a.gl_account = j.gl_account WHERE j.cost_center IS NOT NULL
""")
def q_narrow(ctx: Ctx) -> DataFrame:
    """PF8 — lean cost projection: nine columns and one (broadcast) join."""
    from ..functions.columns import is_manual, reporting_period, signed
    from ..functions.hints import dim

    acc = dim(ctx.L.gl_account, "gl_account", "account_group", "pl_section")
    j = ctx.L.journal.where(F.col("cost_center").isNotNull()).join(acc, "gl_account")
    return j.select("company_code", "fiscal_year", reporting_period().alias("fiscal_period"), "cost_center",
                    "programme_id", "account_group", "pl_section",
                    money(signed("amount_group_currency")).alias("signed_amount_group"),
                    is_manual().alias("is_manual_posting"))


# ======================================================================== planning
@register("plan_actuals", f"""
SELECT company_code, fiscal_year, fiscal_period, cost_center, account_group, programme_key,
       {M('actual_amount')} AS actual_amount FROM plan_act
""")
def q_plan_actuals(ctx: Ctx) -> DataFrame:
    """PL1 — signed regular actuals at plan grain with the NULL-programme sentinel."""
    return money_cols(plan.plan_actuals(ctx.L.journal, ctx.L.gl_account), "actual_amount")


@register("budget_build", f"""
SELECT company_code, fiscal_year, cost_center, account_group, programme_id, version,
       {M('amount_group_currency')} AS amount_group_currency FROM budget
""")
def q_budget_build(ctx: Ctx) -> DataFrame:
    """PL2 — budget = prior complete year x 1.03 (first year x 1.00), small cells dropped."""
    return money_cols(ctx.L.budget.drop("budget_id"), "amount_group_currency")


@register("forecast_build", f"""
SELECT company_code, cost_center, programme_id, fiscal_year, fiscal_period, version, snapshot_date,
       horizon_periods, {M('amount_group_currency')} AS amount_group_currency FROM forecast
""")
def q_forecast_build(ctx: Ctx) -> DataFrame:
    """PL3 — quarterly rolling forecast snapshots with a run-rate base."""
    return money_cols(ctx.L.forecast.drop("forecast_id"), "amount_group_currency")


@register("programme_budget_derive", f"SELECT programme_id, {M('total_budget_eur')} AS total_budget_eur FROM programme")
def q_prog_budget(ctx: Ctx) -> DataFrame:
    """PL4 — programme budget = mean monthly burn x duration x 1.05."""
    return money_cols(ctx.L.programme.select("programme_id", "total_budget_eur"), "total_budget_eur")


#: Last period key that counts for a programme's budget: what it overran afterwards does not raise it.
BUDGET_BASELINE = {"PRG-AUTO": 199806, "PRG-HOME": 199912}


@register("programme_budget_baseline", """
, cut AS (
  SELECT programme_id, sum(period_cost) AS total, count(*) AS n FROM prog_monthly
  WHERE fiscal_year * 100 + fiscal_period <= CASE programme_id {cases} ELSE 999912 END GROUP BY programme_id
)
SELECT m.programme_id, {budget} AS total_budget_eur FROM prog_master m JOIN cut b ON b.programme_id = m.programme_id
""".format(cases=" ".join(f"WHEN '{k}' THEN {v}" for k, v in BUDGET_BASELINE.items()),
           budget=M(f"CAST(CAST({BUDGET_CENTS} AS DECIMAL(30, 0)) * 0.01 AS DECIMAL(28, 2))")))
def q_prog_budget_baseline(ctx: Ctx) -> DataFrame:
    """PL4 — programme budgets from the burn up to a baseline period, before the overruns of two programmes."""
    out = plan.programme_budget_derive(ctx.L.journal, ctx.L.programme_master, baseline=BUDGET_BASELINE)
    return money_cols(out.select("programme_id", "total_budget_eur"), "total_budget_eur")


@register("close_calendar", "SELECT * FROM close_tasks")
def q_close_calendar(ctx: Ctx) -> DataFrame:
    """PL5 — entity x period x task schedule (due = n-th working day, delay, open tasks)."""
    return ctx.L.close_tasks


@register("plan_combos", f"""
, cells AS (
  SELECT company_code, fiscal_year, fiscal_period, cost_center, coalesce(programme_id, '(none)') AS programme_key,
         sum(CASE WHEN debit_credit_ind = 'S' THEN amount_group_currency ELSE -amount_group_currency END) AS amount
  FROM journal WHERE fiscal_period <= 12 AND cost_center IS NOT NULL
  GROUP BY company_code, fiscal_year, fiscal_period, cost_center, coalesce(programme_id, '(none)')
),
big AS (SELECT company_code, fiscal_year, cost_center, programme_key FROM cells
        GROUP BY company_code, fiscal_year, cost_center, programme_key HAVING abs(sum(amount)) >= 50000)
SELECT c.company_code, c.fiscal_year, c.fiscal_period, c.cost_center, c.programme_key, {M('c.amount')} AS amount
FROM cells c SEMI JOIN big b ON b.company_code = c.company_code AND b.fiscal_year = c.fiscal_year
                            AND b.cost_center = c.cost_center AND b.programme_key = c.programme_key
""")
def q_plan_combos(ctx: Ctx) -> DataFrame:
    """PL6 — keep combinations whose absolute annual actual reaches 50 000."""
    from ..functions.columns import signed

    cells = ctx.L.journal.where((F.col("fiscal_period") <= 12) & F.col("cost_center").isNotNull()).groupBy(
        "company_code", "fiscal_year", "fiscal_period", "cost_center", programme_key().alias("programme_key")
    ).agg(F.sum(signed("amount_group_currency")).alias("amount"))
    out = plan.plan_combos(cells, ["company_code", "fiscal_year", "cost_center", "programme_key"], "amount",
                           config.FORECAST_MIN_ANNUAL_EUR)
    return money_cols(out, "amount")


_WEIGHTS_445 = [w / 13 for w in (4, 4, 5)] * 4
_WEIGHTS_445 = [w / 4 for w in _WEIGHTS_445]


@register("plan_spread_weighted", """
, cells AS (
  SELECT company_code, fiscal_year, cost_center, account_group, coalesce(programme_id, '(none)') AS programme_key,
         sum(amount_group_currency) AS annual
  FROM budget GROUP BY company_code, fiscal_year, cost_center, account_group, coalesce(programme_id, '(none)')
),
w AS (SELECT * FROM (VALUES {vals}) t(p, w))
SELECT company_code, fiscal_year, cost_center, account_group, programme_key, w.p AS fiscal_period,
       CAST(annual AS DOUBLE) * w.w AS amount_period
FROM cells, w
""".format(vals=", ".join(f"({i + 1}, CAST('{w!r}' AS DOUBLE))" for i, w in enumerate(_WEIGHTS_445))))
def q_plan_spread(ctx: Ctx) -> DataFrame:
    """PL7 — annual budget spread over 12 periods with a 4-4-5 weighting."""
    cells = ctx.L.budget.groupBy("company_code", "fiscal_year", "cost_center", "account_group",
                                 programme_key().alias("programme_key")).agg(
        F.sum("amount_group_currency").alias("annual"))
    out = plan.plan_spread(cells, "annual", _WEIGHTS_445)
    return out.select("company_code", "fiscal_year", "cost_center", "account_group", "programme_key",
                      F.col("fiscal_period").cast("int").alias("fiscal_period"), "amount_period")


@register("plan_copy_actual", f"""
SELECT company_code, fiscal_year, fiscal_period, cost_center, account_group, programme_key,
       {M('actual_amount')} AS actual_amount, 'FORECAST' AS version
FROM plan_act WHERE fiscal_year * 100 + fiscal_period <= {config.AS_OF_YEAR * 100 + config.AS_OF_PERIOD}
""")
def q_plan_copy(ctx: Ctx) -> DataFrame:
    """PL8 — closed-period actuals copied into the FORECAST version."""
    a = plan.plan_actuals(ctx.L.journal, ctx.L.gl_account)
    return money_cols(plan.plan_copy_actual(a, config.AS_OF_YEAR * 100 + config.AS_OF_PERIOD), "actual_amount")


@register("plan_uplift", f"""
SELECT company_code, cost_center, programme_id, fiscal_year, fiscal_period, version, horizon_periods,
       {M("CASE WHEN version = 'FC-Q2' AND programme_id = 'PRG-AUTO' THEN round(amount_group_currency * 1.05, 2) "
          "ELSE amount_group_currency END")} AS amount_group_currency
FROM forecast
""")
def q_plan_uplift(ctx: Ctx) -> DataFrame:
    """PL9 — data action: raise FC-Q2 of PRG-AUTO by 5 %."""
    f = ctx.L.forecast.select("company_code", "cost_center", "programme_id", "fiscal_year", "fiscal_period",
                              "version", "horizon_periods", "amount_group_currency")
    return money_cols(plan.plan_uplift(f, "FC-Q2", "PRG-AUTO", 5.0), "amount_group_currency")


# ======================================================================== L1 contracts
_NO_ID = {"budget": ["budget_id"], "forecast": ["forecast_id"]}
_L1_MONEY = {"programme": ["total_budget_eur"], "journal": ["amount_doc_currency", "amount_local_currency",
                                                             "amount_group_currency"],
             "budget": ["amount_group_currency"], "forecast": ["amount_group_currency"]}


def _l1(table: str):
    cols = [c for c in schemas.CONTRACT_COLUMNS[table] if c not in _NO_ID.get(table, [])]
    money_c = _L1_MONEY.get(table, [])
    rate_c = ["exchange_rate"] if table == "rates" else []
    sql_cols = ", ".join(M(c) + f" AS {c}" if c in money_c else (f"CAST({c} AS DOUBLE) AS {c}" if c in rate_c else c)
                         for c in cols)

    def q(ctx: Ctx) -> DataFrame:
        df = files.l1_projection(getattr(ctx.L, table), table).select(*cols)
        df = money_cols(df, *money_c)
        for rc in rate_c:
            df = df.withColumn(rc, F.col(rc).cast("double"))
        return df

    q.__doc__ = f"SC10/PF1 — L1 contract projection of {table}."
    return register(f"l1_{table}", f"SELECT {sql_cols} FROM {table}")(q)


for _t in schemas.SCHEMAS:
    if _t != "close_task":  # the fixed catalogue of tasks; it reads no table
        _l1(_t)


# ======================================================================== sources
@register("load_row_counts", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in schemas.SCHEMAS))
def q_row_counts(ctx: Ctx) -> DataFrame:
    """SC4 — row count per finance table, counted while the tables are loaded (no table is scanned for it)."""
    return ctx.L.row_counts()


_CSV_COLS = list(schemas.CONTRACT_COLUMNS["cost_center"])


@register("scan_typed_csv", f"SELECT {', '.join(_CSV_COLS)} FROM cost_center")
def q_scan_typed_csv(ctx: Ctx) -> DataFrame:
    """SC1/SC5 — cost centres written as CSV to the shared folder and read back by their contract."""
    import uuid

    from ..session import ensure_checkpoint_dir

    path = f"{ensure_checkpoint_dir(ctx.spark).rstrip('/')}/csv-{uuid.uuid4().hex}"
    files.write_csv(files.l1_projection(ctx.L.cost_center, "cost_center"), path)
    return files.read_typed_csv(ctx.spark, "cost_center", path)


@register("sample_slice", f"""
, lines AS MATERIALIZED (SELECT journal_id, document_number, document_line, amount_group_currency FROM journal),
head AS (SELECT DISTINCT document_number FROM (SELECT document_number FROM lines ORDER BY journal_id LIMIT 500))
SELECT l.journal_id, l.document_number, l.document_line, {M('l.amount_group_currency')} AS amount_group_currency
FROM lines l JOIN head h ON h.document_number = l.document_number
""")
def q_sample_slice(ctx: Ctx) -> DataFrame:
    """SC6 — first 500 journal lines in key order, keeping each document's lines together."""
    s = files.sample_slice(ctx.L.journal, 500, ["journal_id"], keep_together="document_number")
    return money_cols(s.select("journal_id", "document_number", "document_line", "amount_group_currency"),
                      "amount_group_currency")


@register("period_key_labels", """
SELECT DISTINCT fiscal_year * 100 + fiscal_period AS period_key,
       CAST(fiscal_year AS VARCHAR) || '-' || lpad(CAST(fiscal_period AS VARCHAR), 2, '0') AS period_label
FROM journal
""")
def q_period_keys(ctx: Ctx) -> DataFrame:
    """SF10/SF17 — period keys and ``YYYY-PP`` labels of every journal period."""
    from ..functions.columns import period_label

    return ctx.L.journal.select(period_key().alias("period_key"), period_label().alias("period_label")).distinct()
