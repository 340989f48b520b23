"""Registered queries: published views, extracts, interfaces and status bands."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions.columns import money
from ..operators import extracts, kpis, publish
from .catalog import (
    EAC_SQL, FULL_YEAR, M, _FC_CTE, _PL_SQL, _TASKS_H_CTE, _VARIANCE_CTE, money_cols, register, runrate_cte,
)
from .context import Ctx
from .oracle_preamble import sql_div_cents, sql_exact_ratio

LABEL = "CAST({y} AS VARCHAR) || '-' || lpad(CAST({p} AS VARCHAR), 2, '0')"


def label(y="fiscal_year", p="fiscal_period") -> str:
    return LABEL.format(y=y, p=p)


# ------------------------------------------------------------------ PB1
@register("api_budget_variance", _VARIANCE_CTE + f"""
, grp AS (SELECT DISTINCT account_group, account_group_name FROM gl_account)
SELECT v.company_code, co.company_name, v.fiscal_year, v.fiscal_period,
       {label('v.fiscal_year', 'v.fiscal_period')} AS fiscal_period_label,
       v.cost_center, cc.cost_center_name, cc.division_name, v.programme_id,
       coalesce(p.programme_name, 'Not programme-related') AS programme_name,
       v.account_group, g.account_group_name,
       {M('v.actual_amount')} AS actual_amount, {M('v.budget_amount')} AS budget_amount,
       {M('v.variance')} AS variance,
       {sql_exact_ratio('v.variance', 'v.budget_amount', 4)} AS variance_pct,
       'EUR' AS currency,
       CASE WHEN v.variance_pct IS NULL THEN 0 WHEN v.variance_pct > 0.10 THEN 1
            WHEN v.variance_pct > 0.05 THEN 2 ELSE 3 END AS variance_criticality
FROM variance v
LEFT JOIN company co ON co.company_code = v.company_code
LEFT JOIN cost_center cc ON cc.cost_center = v.cost_center
LEFT JOIN programme p ON p.programme_id = v.programme_id
LEFT JOIN grp g ON g.account_group = v.account_group
""")
def q_api_budget_variance(ctx: Ctx) -> DataFrame:
    """PB1 — published budget variance with descriptions and criticality."""
    L = ctx.L
    df = publish.api_budget_variance(ctx.variance, L.company, L.cost_center, L.programme_master, L.gl_account)
    return money_cols(df, "actual_amount", "budget_amount", "variance")


# ------------------------------------------------------------------ PB2 / KP12
def _elapsed_sql(x: str, s: str) -> str:
    return (f"((year({x}) - year({s})) * 12 + month({x}) - month({s}) "
            f"- CASE WHEN day({x}) < day({s}) THEN 1 ELSE 0 END)")


_BURN_SQL = runrate_cte(config.AS_OF_YEAR, config.AS_OF_PERIOD, config.RUNRATE_WINDOW) + f"""
, burn AS (
  SELECT *, {EAC_SQL} AS eac,
         {sql_exact_ratio(EAC_SQL, 'total_budget_eur', 4)} AS eac_vs_budget_pct,
         {sql_exact_ratio('actuals_to_date', 'total_budget_eur', 4)} AS pct_budget_consumed,
         round(greatest(0.0, least(1.0, CAST({_elapsed_sql("DATE '2001-06-30'", 'start_date')} AS DOUBLE)
               / CASE WHEN {_elapsed_sql('end_date', 'start_date')} <> 0
                      THEN {_elapsed_sql('end_date', 'start_date')} END)), 4) AS pct_time_elapsed
  FROM rr
)
"""


@register("api_programme_burn", _BURN_SQL + f"""
SELECT programme_id, programme_name, programme_type, lead_company_code, status, start_date, end_date,
       {M('actuals_to_date')} AS actuals_to_date, {M('run_rate')} AS run_rate, remaining_periods,
       {M('eac')} AS eac, {M('total_budget_eur')} AS total_budget, eac_vs_budget_pct, 'EUR' AS currency,
       pct_budget_consumed, pct_time_elapsed,
       CASE WHEN eac_vs_budget_pct > 1.10 THEN 1 WHEN eac_vs_budget_pct > 1.00 THEN 2 ELSE 3 END AS eac_criticality
FROM burn
""")
def q_api_programme_burn(ctx: Ctx) -> DataFrame:
    """PB2 — published programme burn (as of 2001/06, window 3, date 2001-06-30)."""
    burn = kpis.programme_burn(ctx.runrate(), config.AS_OF_DATE)
    return money_cols(publish.api_programme_burn(burn), "actuals_to_date", "run_rate", "eac", "total_budget")


@register("programme_burn", _BURN_SQL + """
SELECT programme_id, pct_budget_consumed, pct_time_elapsed,
       round(pct_budget_consumed - pct_time_elapsed, 4) AS burn_ahead
FROM burn
""")
def q_programme_burn(ctx: Ctx) -> DataFrame:
    """KP12 — % budget consumed, % schedule elapsed and the gap."""
    return kpis.programme_burn(ctx.runrate(), config.AS_OF_DATE).select(
        "programme_id", "pct_budget_consumed", "pct_time_elapsed", "burn_ahead")


@register("programme_burn_ranked", _BURN_SQL + """
SELECT programme_id, eac_vs_budget_pct,
       row_number() OVER (ORDER BY eac_vs_budget_pct DESC NULLS LAST, programme_id) AS rank
FROM burn
""")
def q_programme_burn_ranked(ctx: Ctx) -> DataFrame:
    """TK4 — programmes by EAC / budget, worst first."""
    from ..operators.slicing import ranked

    rr = ctx.runrate().select("programme_id", "eac_vs_budget_pct")
    return ranked(rr, "eac_vs_budget_pct", ["programme_id"])


# ------------------------------------------------------------------ PB3
@register("api_close_monitor", _TASKS_H_CTE + f"""
SELECT m.company_code, co.company_name, m.fiscal_year, m.fiscal_period,
       {label('m.fiscal_year', 'm.fiscal_period')} AS fiscal_period_label,
       m.task_id, m.task_name, m.task_sequence, m.is_milestone, m.period_end_date, m.due_date,
       m.actual_completion_date, m.delay_working_days, m.is_open, m.days_to_close,
       m.line_count, m.manual_line_count, m.late_line_count, {M('m.late_value')} AS late_value,
       {sql_exact_ratio('m.manual_line_count', 'm.line_count', 4)} AS manual_share,
       {sql_exact_ratio('m.late_line_count', 'm.line_count', 4)} AS late_share,
       CASE WHEN m.days_to_close IS NULL THEN 0 WHEN m.days_to_close > 7 THEN 1
            WHEN m.days_to_close > 5 THEN 2 ELSE 3 END AS close_criticality
FROM close_monitor m LEFT JOIN company co ON co.company_code = m.company_code
""")
def q_api_close_monitor(ctx: Ctx) -> DataFrame:
    """PB3 — published close monitor with close criticality."""
    m = kpis.close_monitor(ctx.tasks_h, ctx.vj)
    return money_cols(publish.api_close_monitor(m, ctx.L.company), "late_value")


# ------------------------------------------------------------------ PB4 / PB5
@register("api_pl_actuals", f"""
, pl AS ({_PL_SQL})
SELECT company_code, company_name, fiscal_year, fiscal_period, {label()} AS fiscal_period_label,
       pl_section, account_group, account_group_name, amount_group_currency AS amount, amount_manual,
       line_count, line_count_manual, line_count_late, 'EUR' AS currency
FROM pl
""")
def q_api_pl_actuals(ctx: Ctx) -> DataFrame:
    """PB4 — published P&L actuals."""
    return money_cols(publish.api_pl_actuals(kpis.pl_actuals(ctx.vj)), "amount", "amount_manual")


@register("api_ic_reconciliation", f"""
SELECT ic_pair, fiscal_year, reporting_period AS fiscal_period, {M('sum(signed_amount_group)')} AS net_amount,
       count(*) AS line_count, abs(sum(signed_amount_group)) > 1000 AS is_mismatch, 'EUR' AS currency
FROM v_journal WHERE is_intercompany GROUP BY ic_pair, fiscal_year, reporting_period
""")
def q_api_ic(ctx: Ctx) -> DataFrame:
    """PB5 — published intercompany reconciliation."""
    return money_cols(publish.api_ic_reconciliation(ctx.ic), "net_amount")


@register("ic_open_items", f"""
SELECT ic_pair, fiscal_year, reporting_period AS fiscal_period, {M('sum(signed_amount_group)')} AS net_amount,
       count(*) AS line_count, TRUE AS is_mismatch, replace(ic_pair, '|', ' ↔ ') AS pair_label
FROM v_journal WHERE is_intercompany GROUP BY ic_pair, fiscal_year, reporting_period
HAVING abs(sum(signed_amount_group)) > 1000
""")
def q_ic_open_items(ctx: Ctx) -> DataFrame:
    """KP18 — flagged pairs only, newest first, with a display label."""
    return money_cols(kpis.ic_open_items(ctx.ic), "net_amount")


def _ic_sweep_sql(threshold: int) -> str:
    return f"""
, icx AS (SELECT ic_pair, fiscal_year, reporting_period, sum(signed_amount_group) AS net
          FROM v_journal WHERE is_intercompany GROUP BY ic_pair, fiscal_year, reporting_period)
SELECT {threshold} AS threshold, count(*) AS pair_periods,
       CAST(sum(CASE WHEN abs(net) > {threshold} THEN 1 ELSE 0 END) AS BIGINT) AS flagged
FROM icx
"""


for _thr in (0, config.IC_MATERIALITY_EUR):
    def _make(thr):
        @register(f"ic_materiality_sweep_{thr}", _ic_sweep_sql(thr))
        def q(ctx: Ctx) -> DataFrame:
            """KP19 — intercompany flags with the materiality threshold as a parameter."""
            ic = kpis.ic_reconciliation(ctx.vj, thr)
            return ic.agg(F.lit(thr).alias("threshold"), F.count(F.lit(1)).alias("pair_periods"),
                          F.sum(F.col("is_mismatch").cast("long")).alias("flagged"))
        return q
    _make(_thr)


@register("ic_open_item_stats", """
, icx AS (SELECT ic_pair, fiscal_year, reporting_period, sum(signed_amount_group) AS net
          FROM v_journal WHERE is_intercompany GROUP BY ic_pair, fiscal_year, reporting_period)
SELECT count(*) AS pair_periods,
       CAST(sum(CASE WHEN abs(net) > 1000 THEN 1 ELSE 0 END) AS BIGINT) AS flagged,
       avg(CASE WHEN abs(net) > 1000 THEN 1.0 ELSE 0.0 END) AS flagged_share,
       CAST(max(abs(net)) AS DOUBLE) AS max_abs_net,
       round(median(CAST(abs(net) AS DOUBLE)), 6) AS median_abs_net
FROM icx
""")
def q_ic_stats(ctx: Ctx) -> DataFrame:
    """AG13 — open-item statistics: flagged share, max and median absolute net."""
    s = kpis.ic_open_item_stats(ctx.ic)
    return s.withColumn("max_abs_net", F.col("max_abs_net").cast("double")) \
        .withColumn("median_abs_net", F.round("median_abs_net", 6))


# ------------------------------------------------------------------ PB6
@register("kpi_status_bands", """
, man AS (
  SELECT company_code, fiscal_year, reporting_period AS fiscal_period,
         CAST(sum(CASE WHEN is_manual_posting THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS manual_share
  FROM v_journal GROUP BY company_code, fiscal_year, reporting_period
),
lat AS (
  SELECT company_code, fiscal_year, reporting_period AS fiscal_period,
         CAST(sum(CASE WHEN is_late_posting THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS late_share
  FROM v_journal WHERE fiscal_period <= 12 GROUP BY company_code, fiscal_year, reporting_period
)
SELECT coalesce(m.company_code, l.company_code) AS company_code, coalesce(m.fiscal_year, l.fiscal_year) AS fiscal_year,
       coalesce(m.fiscal_period, l.fiscal_period) AS fiscal_period, m.manual_share,
       CASE WHEN m.manual_share IS NULL THEN NULL WHEN m.manual_share <= 0.12 THEN 'GREEN'
            WHEN m.manual_share <= 0.2 THEN 'AMBER' ELSE 'RED' END AS manual_status,
       l.late_share,
       CASE WHEN l.late_share IS NULL THEN NULL WHEN l.late_share <= 0.02 THEN 'GREEN'
            WHEN l.late_share <= 0.05 THEN 'AMBER' ELSE 'RED' END AS late_status
FROM man m FULL OUTER JOIN lat l
  ON m.company_code = l.company_code AND m.fiscal_year = l.fiscal_year AND m.fiscal_period = l.fiscal_period
""")
def q_status_bands(ctx: Ctx) -> DataFrame:
    """PB6 — documented status bands for manual and late shares."""
    return publish.kpi_status_bands(kpis.manual_share(ctx.vj), kpis.late_postings(ctx.vj))


@register("mape_status", _FC_CTE + """
SELECT version, horizon_periods, round(mape, 9) AS mape, observations,
       CASE horizon_periods WHEN 1 THEN 0.1 WHEN 3 THEN 0.2 END AS mape_limit,
       CASE WHEN horizon_periods NOT IN (1, 3) THEN NULL
            WHEN mape <= CASE horizon_periods WHEN 1 THEN 0.1 WHEN 3 THEN 0.2 END THEN 'GREEN'
            ELSE 'RED' END AS mape_status
FROM fc_acc
""")
def q_mape_status(ctx: Ctx) -> DataFrame:
    """PB6 — MAPE against the documented limits (10 % at h=1, 20 % at h=3)."""
    acc = publish.mape_status(kpis.forecast_accuracy(ctx.forecast_rows))
    return acc.withColumn("mape", F.round("mape", 9))


# ------------------------------------------------------------------ PB7 / PB8
RETENTION_AS_OF = dt.date(2003, 6, 30)


@register("retention_tiers", """
SELECT 'full' AS tier, count(*) AS row_count, count(*) AS lines_covered
FROM journal WHERE posting_date > DATE '2001-06-30'
UNION ALL
SELECT 'pseudonymised', count(*), count(*)
FROM journal WHERE posting_date <= DATE '2001-06-30' AND posting_date > DATE '1996-06-30'
UNION ALL
SELECT 'aggregate_only', count(*), CAST(sum(line_count) AS BIGINT)
FROM (SELECT company_code, fiscal_year, fiscal_period, gl_account, count(*) AS line_count
      FROM journal WHERE posting_date <= DATE '1996-06-30'
      GROUP BY company_code, fiscal_year, fiscal_period, gl_account)
""")
def q_retention(ctx: Ctx) -> DataFrame:
    """PB7 — retention tiers as of 2003-06-30 (24 months full, 7 years without user id, older aggregated)."""
    tiers = publish.retention_tiers(ctx.L.journal, RETENTION_AS_OF)
    full = tiers["full"].agg(F.lit("full").alias("tier"), F.count(F.lit(1)).alias("row_count"),
                             F.count(F.lit(1)).alias("lines_covered"))
    mid = tiers["pseudonymised"].agg(F.lit("pseudonymised").alias("tier"), F.count(F.lit(1)).alias("row_count"),
                                     F.count(F.lit(1)).alias("lines_covered"))
    old = tiers["aggregate_only"].agg(F.lit("aggregate_only").alias("tier"), F.count(F.lit(1)).alias("row_count"),
                                      F.coalesce(F.sum("line_count"), F.lit(0)).cast("long").alias("lines_covered"))
    return full.unionByName(mid).unionByName(old)


@register("retention_full", f"""
SELECT journal_id, posting_date, posting_user_id, {M('amount_group_currency')} AS amount_group_currency
FROM journal WHERE posting_date > DATE '2001-06-30'
""")
def q_retention_full(ctx: Ctx) -> DataFrame:
    """PB7 — the lines of the youngest tier, with their user id."""
    full = publish.retention_tiers(ctx.L.journal, RETENTION_AS_OF)["full"]
    return money_cols(full.select("journal_id", "posting_date", "posting_user_id", "amount_group_currency"),
                      "amount_group_currency")


@register("retention_pseudonymised", f"""
SELECT journal_id, posting_date, gl_account, {M('amount_group_currency')} AS amount_group_currency
FROM journal WHERE posting_date <= DATE '2001-06-30' AND posting_date > DATE '1996-06-30'
""")
def q_retention_pseudonymised(ctx: Ctx) -> DataFrame:
    """PB7/QC20 — the lines of the middle tier; no pseudonym column is left."""
    mid = publish.retention_tiers(ctx.L.journal, RETENTION_AS_OF)["pseudonymised"]
    exposed = set(mid.columns) & set(config.PSEUDONYM_COLUMNS)
    if exposed:
        raise ValueError(f"pseudonym columns in a published tier: {sorted(exposed)}")
    return money_cols(mid.select("journal_id", "posting_date", "gl_account", "amount_group_currency"),
                      "amount_group_currency")


@register("retention_aggregate_only", f"""
SELECT company_code, fiscal_year, fiscal_period, gl_account,
       {M("sum(CASE WHEN debit_credit_ind = 'S' THEN amount_group_currency ELSE -amount_group_currency END)")} AS signed_amount_group,
       count(*) AS line_count
FROM journal WHERE posting_date <= DATE '1996-06-30'
GROUP BY company_code, fiscal_year, fiscal_period, gl_account
""")
def q_retention_aggregate(ctx: Ctx) -> DataFrame:
    """PB7 — the oldest tier, left as sums by entity, period and account."""
    return money_cols(publish.retention_tiers(ctx.L.journal, RETENTION_AS_OF)["aggregate_only"], "signed_amount_group")


@register("analytical_query_runrate", runrate_cte(config.AS_OF_YEAR, config.AS_OF_PERIOD, config.RUNRATE_WINDOW) + f"""
SELECT lead_company_code, programme_type, {M('sum(actuals_to_date)')} AS actuals_to_date,
       {M('sum(run_rate)')} AS run_rate, {M('sum(' + EAC_SQL + ')')} AS eac, {M('sum(total_budget_eur)')} AS total_budget_eur,
       {sql_exact_ratio('sum(' + EAC_SQL + ')', 'sum(total_budget_eur)', 4)} AS eac_vs_budget_pct
FROM rr GROUP BY lead_company_code, programme_type
""")
def q_analytical_runrate(ctx: Ctx) -> DataFrame:
    """PB8 — the same default-sum query over run-rate, by lead entity and programme type."""
    return money_cols(publish.analytical_runrate(ctx.runrate()), "actuals_to_date", "run_rate", "eac", "total_budget_eur")


@register("analytical_query", _VARIANCE_CTE + f"""
SELECT company_code, programme_id, {M('sum(actual_amount)')} AS actual_amount,
       {M('sum(budget_amount)')} AS budget_amount, {M('sum(variance)')} AS variance,
       CAST(sum(variance) AS DOUBLE) / CAST(abs(sum(budget_amount)) AS DOUBLE) AS variance_pct
FROM variance WHERE fiscal_year = {config.AS_OF_YEAR} AND fiscal_period <= {config.AS_OF_PERIOD}
GROUP BY company_code, programme_id
""")
def q_analytical(ctx: Ctx) -> DataFrame:
    """PB8 — default-sum analytical query, year to date 2001/06 by entity and programme."""
    return money_cols(publish.analytical_query(ctx.variance), "actual_amount", "budget_amount", "variance")


# ------------------------------------------------------------------ LG6 / PF10 / PF11
@register("journal_interface", f"""
SELECT j.journal_id, j.company_code, co.company_name, j.document_number, j.document_line, j.document_type,
       j.posting_date, j.fiscal_year, j.fiscal_period, least(j.fiscal_period, 12) AS reporting_period,
       j.gl_account, a.account_group, a.pl_section, j.cost_center, cc.cost_center_name,
       j.programme_id, p.programme_name, j.debit_credit_ind,
       {M("CASE WHEN j.debit_credit_ind = 'S' THEN j.amount_group_currency ELSE -j.amount_group_currency END")}
         AS signed_amount_group,
       {M("CASE WHEN j.debit_credit_ind = 'S' THEN j.amount_local_currency ELSE -j.amount_local_currency END")}
         AS signed_amount_local,
       j.document_type IN ('SA', 'SB') AS is_manual_posting,
       j.is_intercompany, j.ic_partner_company, j.is_reversal, j.reversed_document
FROM journal j
LEFT JOIN company co ON co.company_code = j.company_code
LEFT JOIN gl_account a ON a.gl_account = j.gl_account
LEFT JOIN cost_center cc ON cc.cost_center = j.cost_center
LEFT JOIN programme p ON p.programme_id = j.programme_id
""")
def q_journal_interface(ctx: Ctx) -> DataFrame:
    """LG6/PF10 — journal interface without FX, late flag or user columns."""
    L = ctx.L
    df = publish.journal_interface(L.journal, L.company, L.gl_account, L.cost_center, L.programme_master)
    return money_cols(df, "signed_amount_group", "signed_amount_local")


@register("md_cost_center", """
SELECT cost_center, cost_center_name, company_code, division_id, division_name, department_id, department_name,
       department_id AS parent_id, hierarchy_level, is_overhead, valid_from, valid_to
FROM cost_center
""")
def q_md_cost_center(ctx: Ctx) -> DataFrame:
    """PF11 — cost-centre interface without the manager's user id."""
    L = ctx.L
    return publish.master_data_interface(L.cost_center, L.gl_account, L.programme, L.dim_date)["cost_center"]


@register("md_gl_account", "SELECT * FROM gl_account")
def q_md_gl_account(ctx: Ctx) -> DataFrame:
    """PF11 — G/L account interface."""
    return ctx.L.gl_account


@register("md_programme", f"""
SELECT programme_id, programme_name, programme_type, lead_company_code, start_date, end_date,
       {M('total_budget_eur')} AS total_budget_eur, status FROM programme
""")
def q_md_programme(ctx: Ctx) -> DataFrame:
    """PF11 — programme interface."""
    return money_cols(ctx.L.programme, "total_budget_eur")


@register("md_fiscal_periods", """
SELECT DISTINCT fiscal_year, fiscal_period FROM dim_date WHERE fiscal_period <= 12
""")
def q_md_periods(ctx: Ctx) -> DataFrame:
    """PF11 — distinct regular fiscal periods."""
    L = ctx.L
    return publish.master_data_interface(L.cost_center, L.gl_account, L.programme, L.dim_date)["fiscal_periods"]


# ------------------------------------------------------------------ extracts
def _pd(y="fiscal_year", p="fiscal_period") -> str:
    return f"make_date({y}, least({p}, 12), 1) AS period_date, {label(y, f'least({p}, 12)')} AS fiscal_period_label"


@register("extract_pl_actuals", f"""
SELECT company_code, company_name, fiscal_year, fiscal_period, pl_section, account_group, account_group_name,
       {M('sum(signed_amount_group)')} AS amount_group_currency, count(*) AS line_count,
       CAST(sum(CASE WHEN is_manual_posting THEN 1 ELSE 0 END) AS BIGINT) AS manual_line_count, {_pd()}
FROM v_journal
GROUP BY company_code, company_name, fiscal_year, fiscal_period, pl_section, account_group, account_group_name
""")
def q_extract_pl(ctx: Ctx) -> DataFrame:
    """EX1/EX2 — P&L extract; special periods stay separate rows, dated December."""
    return money_cols(extracts.extract_pl_actuals(ctx.vj), "amount_group_currency")


@register("extract_programme_costs", f"""
SELECT j.programme_id, j.company_code, j.fiscal_year, j.fiscal_period, j.account_group,
       {M('sum(j.signed_amount_group)')} AS amount_group_currency,
       any_value(p.programme_name) AS programme_name, any_value(p.programme_type) AS programme_type,
       {M('any_value(p.total_budget_eur)')} AS total_budget_eur, {_pd('j.fiscal_year', 'j.fiscal_period')}
FROM v_journal j LEFT JOIN programme p ON p.programme_id = j.programme_id
WHERE j.programme_id IS NOT NULL
GROUP BY j.programme_id, j.company_code, j.fiscal_year, j.fiscal_period, j.account_group
""")
def q_extract_programme(ctx: Ctx) -> DataFrame:
    """EX3 — programme cost extract with the repeated (non-additive) programme budget."""
    return money_cols(extracts.extract_programme_costs(ctx.vj, ctx.L.programme),
                      "amount_group_currency", "total_budget_eur")


@register("extract_close_tasks", _TASKS_H_CTE + f"""
SELECT t.close_task_id, t.company_code, co.company_name, t.fiscal_year, t.fiscal_period, t.task_id, t.task_name,
       t.task_sequence, t.target_working_day, t.period_end_date, t.due_date, t.actual_completion_date,
       t.delay_working_days, t.days_to_close, t.is_open AS is_period_open, {_pd('t.fiscal_year', 't.fiscal_period')}
FROM tasks_h t LEFT JOIN company co ON co.company_code = t.company_code
""")
def q_extract_close(ctx: Ctx) -> DataFrame:
    """EX4 — close-task extract with days to close and the period-open flag."""
    L = ctx.L
    return extracts.extract_close_tasks(L.close_tasks, L.close_task, L.company, L.dim_date)


_STACK_CTE = f"""
, st_actual AS (
  SELECT company_code, coalesce(programme_id, '(none)') AS programme_key, account_group, fiscal_year, fiscal_period,
         'ACTUAL' AS version, sum(signed_amount_group) AS amount
  FROM v_journal WHERE fiscal_period <= 12
  GROUP BY company_code, coalesce(programme_id, '(none)'), account_group, fiscal_year, fiscal_period
),
st_bann AS (
  SELECT company_code, coalesce(programme_id, '(none)') AS programme_key, account_group, fiscal_year,
         sum(amount_group_currency) AS annual
  FROM budget GROUP BY company_code, coalesce(programme_id, '(none)'), account_group, fiscal_year
),
st_budget AS (
  SELECT company_code, programme_key, account_group, fiscal_year, CAST(p.range AS INTEGER) AS fiscal_period,
         'BUDGET' AS version, {sql_div_cents('annual', '12')} AS amount
  FROM st_bann, range(1, 13) p
),
st_latest AS (
  SELECT *, row_number() OVER (PARTITION BY company_code, coalesce(programme_id, '(none)'), fiscal_year,
                                            fiscal_period, cost_center
                               ORDER BY horizon_periods, version) AS rn
  FROM forecast
),
st_fc AS (
  SELECT company_code, coalesce(programme_id, '(none)') AS programme_key, '(all)' AS account_group, fiscal_year,
         fiscal_period, 'FORECAST' AS version, sum(amount_group_currency) AS amount
  FROM st_latest WHERE rn = 1
  GROUP BY company_code, coalesce(programme_id, '(none)'), fiscal_year, fiscal_period
),
stack AS (
  SELECT * FROM st_actual UNION ALL SELECT * FROM st_budget UNION ALL SELECT * FROM st_fc
)
"""


@register("extract_budget_actual", _STACK_CTE + f"""
SELECT company_code, programme_key AS programme_id, account_group, fiscal_year, fiscal_period, version,
       {M('amount')} AS amount_group_currency, {_pd()}
FROM stack
""")
def q_extract_stack(ctx: Ctx) -> DataFrame:
    """EX5/ST2 — version stack: actual, budget / 12 and latest forecast on one version column."""
    return money_cols(extracts.version_stack(ctx.vj, ctx.L.budget, ctx.L.forecast), "amount_group_currency")


@register("version_pivot", _STACK_CTE + f"""
, piv AS (
  SELECT programme_key AS programme_id,
         sum(CASE WHEN version = 'ACTUAL' THEN round(amount, 2) END) AS actual,
         sum(CASE WHEN version = 'BUDGET' THEN round(amount, 2) END) AS budget,
         sum(CASE WHEN version = 'FORECAST' THEN round(amount, 2) END) AS forecast
  FROM stack WHERE fiscal_year = {FULL_YEAR} GROUP BY programme_key
)
SELECT programme_id, {M('actual')} AS actual, {M('budget')} AS budget, {M('forecast')} AS forecast,
       {M('coalesce(actual, 0) - coalesce(budget, 0)')} AS variance,
       CASE WHEN budget IS NOT NULL AND budget <> 0
            THEN CAST(coalesce(actual, 0) - coalesce(budget, 0) AS DOUBLE) / CAST(abs(budget) AS DOUBLE) END
         AS variance_pct
FROM piv
""")
def q_version_pivot(ctx: Ctx) -> DataFrame:
    """EX6 — programme x version pivot with variance, one fiscal year."""
    stack = extracts.version_stack(ctx.vj, ctx.L.budget, ctx.L.forecast)
    return money_cols(extracts.version_pivot(stack, FULL_YEAR), "actual", "budget", "forecast", "variance")


@register("latest_forecast", """
, lf AS (
  SELECT *, row_number() OVER (PARTITION BY company_code, coalesce(programme_id, '(none)'), fiscal_year,
                                            fiscal_period, cost_center
                               ORDER BY horizon_periods, version) AS rn
  FROM forecast
)
SELECT company_code, cost_center, programme_id, fiscal_year, fiscal_period, version, snapshot_date,
       horizon_periods, CAST(amount_group_currency AS DOUBLE) AS amount_group_currency
FROM lf WHERE rn = 1
""")
def q_latest_forecast(ctx: Ctx) -> DataFrame:
    """WN5 — latest snapshot per target cell (smallest horizon)."""
    lf = extracts.latest_forecast_rows(ctx.L.forecast)
    return money_cols(lf.drop("forecast_id", "programme_key"), "amount_group_currency")


@register("non_additive_budget", f"""
, pc AS (
  SELECT j.programme_id, j.company_code, j.fiscal_year, j.fiscal_period, j.account_group,
         any_value(p.total_budget_eur) AS total_budget_eur, sum(j.signed_amount_group) AS cost
  FROM v_journal j JOIN programme p ON p.programme_id = j.programme_id
  GROUP BY j.programme_id, j.company_code, j.fiscal_year, j.fiscal_period, j.account_group
),
per AS (SELECT programme_id, min(total_budget_eur) AS budget, sum(cost) AS cost FROM pc GROUP BY programme_id)
SELECT {M('sum(budget)')} AS total_budget, {M('sum(cost)')} AS total_cost, count(*) AS programmes FROM per
""")
def q_non_additive(ctx: Ctx) -> DataFrame:
    """AG17 — programme budget repeats on every extract row: MIN per programme, then SUM."""
    ext = extracts.extract_programme_costs(ctx.vj, ctx.L.programme)
    per = ext.groupBy("programme_id").agg(F.min("total_budget_eur").alias("budget"),
                                          F.sum("amount_group_currency").alias("cost"))
    return per.agg(money(F.sum("budget")).alias("total_budget"), money(F.sum("cost")).alias("total_cost"),
                   F.count(F.lit(1)).alias("programmes"))
