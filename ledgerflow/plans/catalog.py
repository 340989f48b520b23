"""Registered queries: one Spark plan and one hand-written DuckDB oracle per key.

Every query reads the driver tables through the demo adapter (so its work
grows with them) and projects a publish-ready result: money rounded to cents
while still decimal and then cast to double, counts as ``bigint``, ratios as
double.  Column names are identical on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..functions.columns import money
from ..operators import kpis, materialise
from .context import Ctx
from .oracle_preamble import oracle, sql_exact_ratio, sql_wide_div

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Ctx(spark, sf_dir))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        run.build = fn  # type: ignore[attr-defined]
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = oracle(sql)
        return fn

    return deco


def M(x: str) -> str:
    """SQL: money to cents, then double."""
    return f"CAST(round({x}, 2) AS DOUBLE)"


def money_cols(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*[money(c).alias(c) if c in cols else F.col(c) for c in df.columns])


# Years that the benchmark asks for: a complete one and the one of the as-of date.
FULL_YEAR = 1999
OPEN_YEAR = config.AS_OF_YEAR

# ============================================================== P&L (AG1/AG2)
_PL_SQL = f"""
SELECT company_code, company_name, fiscal_year, reporting_period AS fiscal_period, pl_section,
       account_group, account_group_name,
       {M('sum(signed_amount_group)')} AS amount_group_currency,
       count(*) AS line_count,
       {M('sum(CASE WHEN is_manual_posting THEN signed_amount_group ELSE 0 END)')} AS amount_manual,
       CAST(sum(CASE WHEN is_manual_posting THEN 1 ELSE 0 END) AS BIGINT) AS line_count_manual,
       CAST(sum(CASE WHEN is_late_posting THEN 1 ELSE 0 END) AS BIGINT) AS line_count_late,
       CAST(sum(CASE WHEN fiscal_period > 12 THEN 1 ELSE 0 END) AS BIGINT) AS line_count_year_end_adjustment
FROM v_journal
GROUP BY company_code, company_name, fiscal_year, reporting_period, pl_section, account_group, account_group_name
"""


@register("pl_actuals", _PL_SQL)
def q_pl_actuals(ctx: Ctx) -> DataFrame:
    """AG1/AG2/KP21 — P&L actuals with restricted key figures."""
    return money_cols(kpis.pl_actuals(ctx.vj), "amount_group_currency", "amount_manual")


@register("pl_actuals_from_agg", _PL_SQL)
def q_pl_actuals_from_agg(ctx: Ctx) -> DataFrame:
    """AG5 — the same P&L served from the monthly aggregate."""
    return money_cols(materialise.pl_actuals_from_agg(ctx.agg, ctx.L.company, ctx.L.gl_account),
                      "amount_group_currency", "amount_manual")


_BENCH_PL_FULL_SQL = f"""
SELECT company_code, fiscal_year, reporting_period AS fiscal_period, account_group,
       {M('sum(signed_amount_group)')} AS amount, count(*) AS lines
FROM v_journal GROUP BY company_code, fiscal_year, reporting_period, account_group
"""


def _bench_pl_full_base(vj: DataFrame) -> DataFrame:
    return vj.groupBy("company_code", "fiscal_year", F.col("reporting_period").alias("fiscal_period"),
                      "account_group").agg(money(F.sum("signed_amount_group")).alias("amount"),
                                           F.count(F.lit(1)).alias("lines"))


def _bench_pl_full_agg(agg: DataFrame) -> DataFrame:
    return agg.groupBy("company_code", "fiscal_year", "fiscal_period", "account_group").agg(
        money(F.sum("signed_amount_group")).alias("amount"), F.sum("line_count").cast("long").alias("lines"))


@register("bench_pl_actuals_full", _BENCH_PL_FULL_SQL)
def q_bench_pl_full(ctx: Ctx) -> DataFrame:
    """Benchmark question 1 on the base path (the P&L view's unused description joins pruned)."""
    return _bench_pl_full_base(ctx.vj)


@register("bench_pl_actuals_full_agg", _BENCH_PL_FULL_SQL)
def q_bench_pl_full_agg(ctx: Ctx) -> DataFrame:
    """Benchmark question 1 served from the aggregate."""
    return _bench_pl_full_agg(ctx.agg)


_BENCH_PL_YEAR_SQL = f"""
SELECT company_code, reporting_period AS fiscal_period, account_group,
       {M('sum(signed_amount_group)')} AS amount
FROM v_journal WHERE fiscal_year = {FULL_YEAR}
GROUP BY company_code, reporting_period, account_group
"""


@register("bench_pl_actuals_one_year", _BENCH_PL_YEAR_SQL)
def q_bench_pl_year(ctx: Ctx) -> DataFrame:
    """Benchmark question 2 (one fiscal year) on the base path."""
    vj = ctx.vj.where(F.col("fiscal_year") == FULL_YEAR)
    return vj.groupBy("company_code", F.col("reporting_period").alias("fiscal_period"), "account_group").agg(
        money(F.sum("signed_amount_group")).alias("amount"))


@register("bench_pl_actuals_one_year_agg", _BENCH_PL_YEAR_SQL)
def q_bench_pl_year_agg(ctx: Ctx) -> DataFrame:
    """Benchmark question 2 from the aggregate (the fiscal-year filter prunes partitions)."""
    a = ctx.agg.where(F.col("fiscal_year") == FULL_YEAR)
    return a.groupBy("company_code", "fiscal_period", "account_group").agg(
        money(F.sum("signed_amount_group")).alias("amount"))


# ============================================================== KPI-04 variance
_VARIANCE_CTE = f"""
, act_cells AS (
  SELECT company_code, fiscal_year, reporting_period AS fiscal_period, cost_center, account_group,
         coalesce(programme_id, '(none)') AS programme_key, sum(signed_amount_group) AS actual_amount
  FROM v_journal WHERE cost_center IS NOT NULL AND fiscal_period <= 12
  GROUP BY company_code, fiscal_year, reporting_period, cost_center, account_group, coalesce(programme_id, '(none)')
),
bud_cells0 AS (
  SELECT company_code, fiscal_year, cost_center, account_group, coalesce(programme_id, '(none)') AS programme_key,
         sum(amount_group_currency) AS amount_annual
  FROM budget GROUP BY company_code, fiscal_year, cost_center, account_group, coalesce(programme_id, '(none)')
),
bud_cells AS (
  SELECT company_code, fiscal_year, CAST(p.range AS INTEGER) AS fiscal_period, cost_center, account_group,
         programme_key, amount_annual, {sql_wide_div('amount_annual', '12')} AS budget_amount
  FROM bud_cells0, range(1, 13) p
),
variance AS (
  SELECT coalesce(a.company_code, b.company_code) AS company_code,
         coalesce(a.fiscal_year, b.fiscal_year) AS fiscal_year,
         coalesce(a.fiscal_period, b.fiscal_period) AS fiscal_period,
         coalesce(a.cost_center, b.cost_center) AS cost_center,
         coalesce(a.account_group, b.account_group) AS account_group,
         coalesce(a.programme_key, b.programme_key) AS programme_id,
         coalesce(a.actual_amount, 0) AS actual_amount,
         coalesce(b.budget_amount, 0) AS budget_amount,
         coalesce(a.actual_amount, 0) - coalesce(b.budget_amount, 0) AS variance,
         CASE WHEN coalesce(b.budget_amount, 0) <> 0
              THEN CAST(coalesce(a.actual_amount, 0) - b.budget_amount AS DOUBLE) / CAST(abs(b.budget_amount) AS DOUBLE)
         END AS variance_pct
  FROM act_cells a FULL OUTER JOIN bud_cells b
    ON a.company_code = b.company_code AND a.fiscal_year = b.fiscal_year AND a.fiscal_period = b.fiscal_period
   AND a.cost_center = b.cost_center AND a.account_group = b.account_group AND a.programme_key = b.programme_key
)
"""

_VARIANCE_SQL = _VARIANCE_CTE + f"""
SELECT company_code, fiscal_year, fiscal_period, cost_center, account_group, programme_id,
       {M('actual_amount')} AS actual_amount, {M('budget_amount')} AS budget_amount,
       {M('variance')} AS variance, variance_pct
FROM variance
"""


def _variance_out(v: DataFrame) -> DataFrame:
    return money_cols(v, "actual_amount", "budget_amount", "variance")


@register("budget_variance", _VARIANCE_SQL)
def q_budget_variance(ctx: Ctx) -> DataFrame:
    """KP7 — budget variance, full outer join of actual and phased budget."""
    return _variance_out(ctx.variance)


@register("budget_variance_from_agg", _VARIANCE_SQL)
def q_budget_variance_from_agg(ctx: Ctx) -> DataFrame:
    """AG7 — budget variance with the actual side served from the aggregate."""
    return _variance_out(materialise.budget_variance_from_agg(ctx.agg, ctx.budget_cells))


_BENCH_VAR_SQL = _VARIANCE_CTE + f"""
SELECT programme_id, {M('sum(actual_amount)')} AS actual, {M('sum(budget_amount)')} AS budget
FROM variance WHERE fiscal_year = {OPEN_YEAR} GROUP BY programme_id
"""


def _bench_var(actual: DataFrame, ctx: Ctx) -> DataFrame:
    # the sums of a programme are sums of its cells' sides, so neither side needs its cells first
    budget = ctx.L.budget.where(F.col("fiscal_year") == OPEN_YEAR)
    return money_cols(kpis.variance_totals(actual, budget, ["programme_key"]).select(
        F.col("programme_key").alias("programme_id"), "actual", "budget"), "actual", "budget")


@register("bench_budget_variance_one_year", _BENCH_VAR_SQL)
def q_bench_var(ctx: Ctx) -> DataFrame:
    """Benchmark question 3 (open year, by programme) on the base path."""
    return _bench_var(kpis.actual_lines(ctx.vj.where(F.col("fiscal_year") == OPEN_YEAR)), ctx)


@register("bench_budget_variance_one_year_agg", _BENCH_VAR_SQL)
def q_bench_var_agg(ctx: Ctx) -> DataFrame:
    """Benchmark question 3 from the aggregate (year partition pruned on both inputs)."""
    return _bench_var(materialise.actual_rows_from_agg(ctx.agg.where(F.col("fiscal_year") == OPEN_YEAR)), ctx)


@register("variance_by_programme", _VARIANCE_CTE + f"""
SELECT programme_id, {M('sum(actual_amount)')} AS actual, {M('sum(budget_amount)')} AS budget
FROM variance WHERE fiscal_year = {FULL_YEAR} GROUP BY programme_id
""")
def q_variance_by_programme(ctx: Ctx) -> DataFrame:
    """KP9 — variance by programme for one fiscal year."""
    return money_cols(kpis.variance_by_programme(ctx.variance, FULL_YEAR), "actual", "budget")


@register("variance_by_period", _VARIANCE_CTE + f"""
SELECT fiscal_year, fiscal_period, {M('sum(actual_amount)')} AS actual_amount,
       {M('sum(budget_amount)')} AS budget_amount, {M('sum(variance)')} AS variance
FROM variance GROUP BY fiscal_year, fiscal_period
""")
def q_variance_by_period(ctx: Ctx) -> DataFrame:
    """KP9 — dashboard roll-up by fiscal year and period."""
    return money_cols(kpis.variance_by_period(ctx.variance), "actual_amount", "budget_amount", "variance")


@register("actuals_by_period", f"""
SELECT company_code, fiscal_year, reporting_period AS fiscal_period, cost_center, account_group,
       coalesce(programme_id, '(none)') AS programme_key, {M('sum(signed_amount_group)')} AS actual_amount
FROM v_journal WHERE cost_center IS NOT NULL AND fiscal_period <= 12
GROUP BY company_code, fiscal_year, reporting_period, cost_center, account_group, coalesce(programme_id, '(none)')
""")
def q_actuals_by_period(ctx: Ctx) -> DataFrame:
    """KP8 — the actual side of the variance on its own."""
    return money_cols(kpis.actual_cells(ctx.vj), "actual_amount")


@register("budget_phased", f"""
, bud_cells0 AS (
  SELECT company_code, fiscal_year, cost_center, account_group, coalesce(programme_id, '(none)') AS programme_key,
         sum(amount_group_currency) AS amount_annual
  FROM budget GROUP BY company_code, fiscal_year, cost_center, account_group, coalesce(programme_id, '(none)')
)
SELECT company_code, fiscal_year, CAST(p.range AS INTEGER) AS fiscal_period, cost_center, account_group,
       programme_key, {M('amount_annual')} AS amount_annual,
       {M(sql_wide_div('amount_annual', '12'))} AS budget_amount
FROM bud_cells0, range(1, 13) p
""")
def q_budget_phased(ctx: Ctx) -> DataFrame:
    """KP6/JN7 — annual budget phased evenly over twelve periods (published in cents)."""
    return money_cols(ctx.budget_cells, "amount_annual", "budget_amount")


# ============================================================== KPI-05 run-rate
def runrate_cte(year: int, period: int, window: int) -> str:
    """CTEs ending in ``rr`` (one row per programme with run-rate inputs)."""
    return f"""
, rr_monthly AS (
  SELECT programme_id, fiscal_year * 100 + fiscal_period AS period_key, sum(signed_amount_group) AS period_cost
  FROM v_journal
  WHERE programme_id IS NOT NULL AND fiscal_period <= 12 AND fiscal_year * 100 + fiscal_period <= {year * 100 + period}
  GROUP BY programme_id, fiscal_year * 100 + fiscal_period
),
rr_ranked AS (
  SELECT *, row_number() OVER (PARTITION BY programme_id ORDER BY period_key DESC) AS recency FROM rr_monthly
),
rr_agg AS (
  SELECT programme_id, sum(period_cost) AS actuals_to_date,
         sum(CASE WHEN recency <= {window} THEN period_cost END) AS rr_sum,
         sum(CASE WHEN recency <= {window} THEN 1 ELSE 0 END) AS rr_n
  FROM rr_ranked GROUP BY programme_id
),
rr AS (
  SELECT a.programme_id, p.programme_name, p.programme_type, p.lead_company_code, p.status, p.start_date,
         p.end_date, a.actuals_to_date, p.total_budget_eur,
         {sql_wide_div('a.rr_sum', 'a.rr_n')} AS run_rate,
         CAST(greatest(0, (year(p.end_date) - {year}) * 12 + (month(p.end_date) - {period})) AS INTEGER)
           AS remaining_periods
  FROM rr_agg a JOIN programme p ON p.programme_id = a.programme_id
)
"""


EAC_SQL = "(actuals_to_date + run_rate * remaining_periods)"


def _runrate_sql(year: int, period: int, window: int) -> str:
    eac = EAC_SQL
    return runrate_cte(year, period, window) + f"""
SELECT programme_id, programme_name, programme_type, {year} AS as_of_fiscal_year, {period} AS as_of_fiscal_period,
       {M('actuals_to_date')} AS actuals_to_date, {M('run_rate')} AS run_rate, remaining_periods,
       {M(eac)} AS eac, {M('total_budget_eur')} AS total_budget_eur,
       {sql_exact_ratio(eac, 'total_budget_eur', 4)} AS eac_vs_budget_pct
FROM rr
"""


_RUNRATE_COLS = ["programme_id", "programme_name", "programme_type", "as_of_fiscal_year", "as_of_fiscal_period",
                 "actuals_to_date", "run_rate", "remaining_periods", "eac", "total_budget_eur", "eac_vs_budget_pct"]


def _runrate_out(df: DataFrame) -> DataFrame:
    return money_cols(df.select(*_RUNRATE_COLS), "actuals_to_date", "run_rate", "eac", "total_budget_eur")


@register("programme_runrate", _runrate_sql(config.AS_OF_YEAR, config.AS_OF_PERIOD, config.RUNRATE_WINDOW))
def q_runrate(ctx: Ctx) -> DataFrame:
    """KP10 — run-rate and EAC as of 2001/06 with a three-period window (benchmark question 4)."""
    return _runrate_out(ctx.runrate())


@register("programme_runrate_from_agg",
          _runrate_sql(config.AS_OF_YEAR, config.AS_OF_PERIOD, config.RUNRATE_WINDOW))
def q_runrate_agg(ctx: Ctx) -> DataFrame:
    """KP10 served from the monthly aggregate (benchmark question 4, aggregate path)."""
    monthly = materialise.programme_monthly_from_agg(ctx.agg)
    return _runrate_out(kpis.runrate_from_monthly(monthly, ctx.L.programme, config.AS_OF_YEAR,
                                                  config.AS_OF_PERIOD, config.RUNRATE_WINDOW))


@register("programme_runrate_w1", _runrate_sql(config.AS_OF_YEAR, config.AS_OF_PERIOD, 1))
def q_runrate_w1(ctx: Ctx) -> DataFrame:
    """KP11 — same operator, one-period window."""
    return _runrate_out(ctx.runrate(window=1))


@register("programme_runrate_w12", _runrate_sql(config.AS_OF_YEAR, config.AS_OF_PERIOD, 12))
def q_runrate_w12(ctx: Ctx) -> DataFrame:
    """KP11 — same operator, twelve-period window."""
    return _runrate_out(ctx.runrate(window=12))


@register("programme_runrate_finished", _runrate_sql(2000, 12, 3))
def q_runrate_finished(ctx: Ctx) -> DataFrame:
    """KP10 as of 2000/12: the finished programme has remaining = 0 and EAC = actuals."""
    return _runrate_out(ctx.runrate(2000, 12, 3))


# ============================================================== KPI-01 close
_TASKS_H_CTE = """
, tasks_h AS (
  SELECT c.close_task_id, c.company_code, c.fiscal_year, c.fiscal_period, c.task_id, t.task_name,
         t.task_sequence, t.target_working_day, t.is_milestone, c.period_end_date, c.due_date,
         c.actual_completion_date, c.completed_by_user_id, c.delay_working_days,
         c.actual_completion_date IS NULL AS is_open,
         CASE WHEN c.task_id = 'T12' AND c.actual_completion_date IS NOT NULL
              THEN da.working_day_seq - dp.working_day_seq END AS days_to_close
  FROM close_tasks c
  JOIN close_task t ON t.task_id = c.task_id
  LEFT JOIN dim_date dp ON dp.date_id = c.period_end_date
  LEFT JOIN dim_date da ON da.date_id = c.actual_completion_date
),
postings AS (
  SELECT company_code, fiscal_year, reporting_period AS fiscal_period, count(*) AS line_count,
         CAST(sum(CASE WHEN is_manual_posting THEN 1 ELSE 0 END) AS BIGINT) AS manual_line_count,
         CAST(sum(CASE WHEN is_late_posting THEN 1 ELSE 0 END) AS BIGINT) AS late_line_count,
         sum(CASE WHEN is_late_posting THEN abs(amount_group_currency) ELSE 0 END) AS late_value
  FROM v_journal GROUP BY company_code, fiscal_year, reporting_period
),
close_monitor AS (
  SELECT c.company_code, c.fiscal_year, c.fiscal_period, c.task_id, c.task_name, c.task_sequence, c.is_milestone,
         c.period_end_date, c.due_date, c.actual_completion_date, c.delay_working_days, c.is_open, c.days_to_close,
         p.line_count, p.manual_line_count, p.late_line_count, p.late_value,
         CASE WHEN p.line_count > 0 THEN CAST(p.manual_line_count AS DOUBLE) / p.line_count END AS manual_share,
         CASE WHEN p.line_count > 0 THEN CAST(p.late_line_count AS DOUBLE) / p.line_count END AS late_share
  FROM tasks_h c LEFT JOIN postings p
    ON p.company_code = c.company_code AND p.fiscal_year = c.fiscal_year AND p.fiscal_period = c.fiscal_period
)
"""


@register("close_tasks", _TASKS_H_CTE + """
SELECT close_task_id, company_code, fiscal_year, fiscal_period, task_id, task_name, task_sequence,
       target_working_day, is_milestone, period_end_date, due_date, actual_completion_date,
       delay_working_days, is_open, days_to_close
FROM tasks_h
""")
def q_close_tasks(ctx: Ctx) -> DataFrame:
    """KP1 — harmonised close tasks with days to close on the hard close."""
    return ctx.tasks_h.drop("completed_by_user_id")


@register("days_to_close", _TASKS_H_CTE + """
SELECT company_code, fiscal_year, fiscal_period, is_open, days_to_close FROM tasks_h WHERE task_id = 'T12'
""")
def q_days_to_close(ctx: Ctx) -> DataFrame:
    """KP2 — KPI-01 per entity and period; NULL while the period is open."""
    return kpis.days_to_close(ctx.tasks_h)


@register("close_monitor", _TASKS_H_CTE + f"""
SELECT company_code, fiscal_year, fiscal_period, task_id, task_name, task_sequence, is_milestone,
       period_end_date, due_date, actual_completion_date, delay_working_days, is_open, days_to_close,
       line_count, manual_line_count, late_line_count, {M('late_value')} AS late_value, manual_share, late_share
FROM close_monitor
""")
def q_close_monitor(ctx: Ctx) -> DataFrame:
    """KP5 — close monitor: task rows with entity-period posting measures."""
    return money_cols(kpis.close_monitor(ctx.tasks_h, ctx.vj), "late_value")


@register("bench_close_monitor", _TASKS_H_CTE + """
SELECT company_code, avg(days_to_close) AS avg_days FROM close_monitor WHERE task_id = 'T12' GROUP BY company_code
""")
def q_bench_close(ctx: Ctx) -> DataFrame:
    """Benchmark question 5 — average days to close per entity."""
    # avg(days_to_close) over the close monitor only reads task columns: the left join to
    # the entity-period posting measures is pruned by hand (a database prunes it itself).
    t12 = kpis.days_to_close(ctx.tasks_h)
    return t12.groupBy("company_code").agg(F.avg("days_to_close").alias("avg_days"))


@register("days_to_close_by_entity", _TASKS_H_CTE + """
SELECT company_code, avg(days_to_close) AS avg_days_to_close, max(days_to_close) AS max_days_to_close,
       CAST(sum(CASE WHEN days_to_close IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS open_periods, count(*) AS periods
FROM tasks_h WHERE task_id = 'T12' GROUP BY company_code
""")
def q_days_to_close_by_entity(ctx: Ctx) -> DataFrame:
    """AG8 — average and worst days to close per entity, ignoring open periods."""
    return kpis.days_to_close_by_entity(ctx.tasks_h)


@register("manual_share", f"""
SELECT company_code, fiscal_year, reporting_period AS fiscal_period, count(*) AS line_count,
       CAST(sum(CASE WHEN is_manual_posting THEN 1 ELSE 0 END) AS BIGINT) AS manual_line_count,
       {M('sum(abs(amount_group_currency))')} AS total_value,
       {M('sum(CASE WHEN is_manual_posting THEN abs(amount_group_currency) ELSE 0 END)')} AS manual_value,
       {M('sum(CASE WHEN is_manual_posting THEN signed_amount_group ELSE 0 END)')} AS amount_manual,
       CAST(sum(CASE WHEN is_manual_posting THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS manual_share,
       CAST(sum(CASE WHEN is_manual_posting THEN abs(amount_group_currency) ELSE 0 END) AS DOUBLE)
         / CAST(sum(abs(amount_group_currency)) AS DOUBLE) AS manual_value_share
FROM v_journal GROUP BY company_code, fiscal_year, reporting_period
""")
def q_manual_share(ctx: Ctx) -> DataFrame:
    """KP3 — manual share by count and by absolute value per entity and period."""
    return money_cols(kpis.manual_share(ctx.vj), "total_value", "manual_value", "amount_manual")


_MANUAL_DRILL_SQL = f"""
SELECT company_code, fiscal_year, reporting_period AS fiscal_period, {{key}}, count(*) AS line_count,
       CAST(sum(CASE WHEN is_manual_posting THEN 1 ELSE 0 END) AS BIGINT) AS manual_line_count,
       {M('sum(abs(amount_group_currency))')} AS total_value,
       {M('sum(CASE WHEN is_manual_posting THEN abs(amount_group_currency) ELSE 0 END)')} AS manual_value
FROM v_journal GROUP BY company_code, fiscal_year, reporting_period, {{key}}
"""


def _manual_drill(ctx: Ctx, key: str) -> DataFrame:
    x = kpis.manual_share(ctx.vj, [key]).select("company_code", "fiscal_year", "fiscal_period", key, "line_count",
                                                "manual_line_count", "total_value", "manual_value")
    return money_cols(x, "total_value", "manual_value")


@register("manual_share_by_doc_type", _MANUAL_DRILL_SQL.format(key="document_type"))
def q_manual_share_doc(ctx: Ctx) -> DataFrame:
    """KP3 drill-down by document type."""
    return _manual_drill(ctx, "document_type")


@register("manual_share_by_cost_center", _MANUAL_DRILL_SQL.format(key="cost_center"))
def q_manual_share_centre(ctx: Ctx) -> DataFrame:
    """KP3 drill-down by cost centre (lines without one in a group of their own)."""
    return _manual_drill(ctx, "cost_center")


_LATE_SQL = """
SELECT company_code, fiscal_year, reporting_period AS fiscal_period{extra}, count(*) AS line_count,
       CAST(sum(CASE WHEN is_late_posting THEN 1 ELSE 0 END) AS BIGINT) AS late_line_count,
       {late_value} AS late_value,
       CAST(sum(CASE WHEN is_late_posting THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS late_share
FROM v_journal WHERE fiscal_period <= 12
GROUP BY company_code, fiscal_year, reporting_period{extra}
"""


@register("late_postings", _LATE_SQL.format(
    extra="", late_value=M("sum(CASE WHEN is_late_posting THEN abs(amount_group_currency) ELSE 0 END)")))
def q_late_postings(ctx: Ctx) -> DataFrame:
    """KP4 — late postings count, value and share per entity and period."""
    return money_cols(kpis.late_postings(ctx.vj), "late_value")


@register("late_postings_by_doc_type", _LATE_SQL.format(
    extra=", document_type",
    late_value=M("sum(CASE WHEN is_late_posting THEN abs(amount_group_currency) ELSE 0 END)")))
def q_late_postings_doc(ctx: Ctx) -> DataFrame:
    """KP4 drill-down by document type (D23)."""
    return money_cols(kpis.late_postings(ctx.vj, ["document_type"]), "late_value")


@register("late_postings_by_cost_center", _LATE_SQL.format(
    extra=", cost_center",
    late_value=M("sum(CASE WHEN is_late_posting THEN abs(amount_group_currency) ELSE 0 END)")))
def q_late_postings_centre(ctx: Ctx) -> DataFrame:
    """KP4 drill-down by cost centre."""
    return money_cols(kpis.late_postings(ctx.vj, ["cost_center"]), "late_value")


# ============================================================== KPI-06 FX
_FX_SQL = f"""
SELECT company_code, company_name, local_currency, fiscal_year, reporting_period AS fiscal_period, account_group,
       {M('sum(signed_amount_group)')} AS amount_group_booked,
       {M('sum(signed_amount_at_actual_rate)')} AS amount_at_actual_rate,
       {M('sum(signed_amount_at_budget_rate)')} AS amount_at_budget_rate,
       {M('sum(signed_amount_at_actual_rate) - sum(signed_amount_at_budget_rate)')} AS fx_impact,
       {M('sum(amount_local_currency * rate_budget)')} AS gross_at_budget_rate
       {{rates}}
FROM v_journal
GROUP BY company_code, company_name, local_currency, fiscal_year, reporting_period, account_group
"""
_FX_MONEY = ["amount_group_booked", "amount_at_actual_rate", "amount_at_budget_rate", "fx_impact",
             "gross_at_budget_rate"]


@register("fx_impact", _FX_SQL.format(
    rates=", CAST(min(rate_actual) AS DOUBLE) AS rate_actual, CAST(min(rate_budget) AS DOUBLE) AS rate_budget"))
def q_fx_impact(ctx: Ctx) -> DataFrame:
    """FX6/KP13 — FX impact: actual-rate minus budget-rate translation."""
    df = kpis.fx_impact(ctx.vj)
    return money_cols(df, *_FX_MONEY).withColumn("rate_actual", F.col("rate_actual").cast("double")) \
        .withColumn("rate_budget", F.col("rate_budget").cast("double"))


@register("fx_impact_from_agg", _FX_SQL.format(rates=""))
def q_fx_impact_from_agg(ctx: Ctx) -> DataFrame:
    """AG6 — FX impact from the aggregate (rate columns are not carried, D10)."""
    return money_cols(materialise.fx_impact_from_agg(ctx.agg, ctx.L.company), *_FX_MONEY)


_BENCH_FX_SQL = f"""
SELECT company_code, {M('sum(signed_amount_at_actual_rate) - sum(signed_amount_at_budget_rate)')} AS fx
FROM v_journal GROUP BY company_code
"""


@register("bench_fx_impact", _BENCH_FX_SQL)
def q_bench_fx(ctx: Ctx) -> DataFrame:
    """Benchmark question 6 on the base path."""
    return ctx.vj.groupBy("company_code").agg(
        money(F.sum("signed_amount_at_actual_rate") - F.sum("signed_amount_at_budget_rate")).alias("fx"))


@register("bench_fx_impact_agg", _BENCH_FX_SQL)
def q_bench_fx_agg(ctx: Ctx) -> DataFrame:
    """Benchmark question 6 from the aggregate."""
    return ctx.agg.groupBy("company_code").agg(
        money(F.sum("signed_amount_at_actual") - F.sum("signed_amount_at_budget")).alias("fx"))


# ============================================================== KPI-08 IC
_IC_CTE = """
, ic AS (
  SELECT ic_pair, fiscal_year, reporting_period AS fiscal_period, sum(signed_amount_group) AS net_amount,
         count(*) AS line_count, abs(sum(signed_amount_group)) > 1000 AS is_mismatch
  FROM v_journal WHERE is_intercompany GROUP BY ic_pair, fiscal_year, reporting_period
)
"""


@register("ic_reconciliation", _IC_CTE + f"""
SELECT ic_pair, fiscal_year, fiscal_period, {M('net_amount')} AS net_amount, line_count, is_mismatch FROM ic
""")
def q_ic(ctx: Ctx) -> DataFrame:
    """KP17 — intercompany net per unordered pair and period, flagged above 1 000."""
    return money_cols(ctx.ic, "net_amount")


# ============================================================== KPI-07 forecast
_FC_CTE = """
, fc_act AS (
  SELECT company_code, cost_center, coalesce(programme_id, '(none)') AS programme_key, fiscal_year,
         reporting_period AS fiscal_period, sum(signed_amount_group) AS actual
  FROM v_journal WHERE fiscal_period <= 12 AND cost_center IS NOT NULL
  GROUP BY company_code, cost_center, coalesce(programme_id, '(none)'), fiscal_year, reporting_period
),
fc_rows AS (
  SELECT f.company_code, f.cost_center, f.version, f.horizon_periods,
         CAST(abs(a.actual - f.amount_group_currency) AS DOUBLE) / CAST(abs(a.actual) AS DOUBLE) AS abs_pct_error
  FROM forecast f JOIN fc_act a
    ON a.company_code = f.company_code AND a.cost_center = f.cost_center
   AND a.programme_key = coalesce(f.programme_id, '(none)') AND a.fiscal_year = f.fiscal_year
   AND a.fiscal_period = f.fiscal_period
  WHERE a.actual <> 0
),
fc_acc AS (
  SELECT version, horizon_periods, avg(abs_pct_error) AS mape, count(*) AS observations
  FROM fc_rows GROUP BY version, horizon_periods
)
"""


@register("forecast_accuracy", _FC_CTE + """
SELECT version, horizon_periods, round(mape, 9) AS mape, observations FROM fc_acc
""")
def q_forecast_accuracy(ctx: Ctx) -> DataFrame:
    """KP14 — MAPE by forecast version and horizon; zero actuals excluded."""
    acc = kpis.forecast_accuracy(ctx.forecast_rows)
    return acc.withColumn("mape", F.round("mape", 9))


@register("forecast_accuracy_by_horizon", _FC_CTE + """
SELECT horizon_periods, round(avg(mape), 9) AS mean_mape, CAST(sum(observations) AS BIGINT) AS observations
FROM fc_acc GROUP BY horizon_periods
""")
def q_forecast_by_horizon(ctx: Ctx) -> DataFrame:
    """KP15 — mean MAPE and observations per horizon."""
    h = kpis.forecast_accuracy_by_horizon(kpis.forecast_accuracy(ctx.forecast_rows))
    return h.withColumn("mean_mape", F.round("mean_mape", 9))


@register("forecast_accuracy_by_centre", _FC_CTE + """
SELECT cost_center, version, horizon_periods, round(avg(abs_pct_error), 9) AS mape, count(*) AS observations
FROM fc_rows GROUP BY cost_center, version, horizon_periods
""")
def q_forecast_by_centre(ctx: Ctx) -> DataFrame:
    """KP16 — documented grain: cost centre x version x horizon."""
    acc = kpis.forecast_accuracy(ctx.forecast_rows, ["cost_center"])
    return acc.withColumn("mape", F.round("mape", 9))


# ============================================================== aggregate
@register("agg_journal_monthly", f"""
SELECT company_code, fiscal_year, reporting_period AS fiscal_period, account_group, pl_section, programme_id,
       cost_center, fiscal_period > 12 AS is_special_period, local_currency,
       {M('sum(signed_amount_group)')} AS signed_amount_group,
       {M('sum(signed_amount_at_actual_rate)')} AS signed_amount_at_actual,
       {M('sum(signed_amount_at_budget_rate)')} AS signed_amount_at_budget,
       {M('sum(amount_local_currency * rate_budget)')} AS gross_amount_at_budget,
       {M('sum(CASE WHEN is_manual_posting THEN signed_amount_group ELSE 0 END)')} AS amount_manual,
       count(*) AS line_count,
       CAST(sum(CASE WHEN is_manual_posting THEN 1 ELSE 0 END) AS BIGINT) AS line_count_manual,
       CAST(sum(CASE WHEN is_late_posting THEN 1 ELSE 0 END) AS BIGINT) AS line_count_late,
       CAST(sum(CASE WHEN fiscal_period > 12 THEN 1 ELSE 0 END) AS BIGINT) AS line_count_special_period
FROM v_journal
GROUP BY company_code, fiscal_year, reporting_period, account_group, pl_section, programme_id, cost_center,
         fiscal_period > 12, local_currency
""")
def q_agg(ctx: Ctx) -> DataFrame:
    """AG4 — the materialised monthly aggregate."""
    return money_cols(ctx.agg, "signed_amount_group", "signed_amount_at_actual", "signed_amount_at_budget",
                      "gross_amount_at_budget", "amount_manual")
