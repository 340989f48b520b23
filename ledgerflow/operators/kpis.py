"""The eight controlling KPIs and their direct drill-downs (KP1-KP21, AG1/AG2, AG8, AG10, FX6-FX8).

Inputs are the harmonised journal (``ledger.harmonised_journal``) and the
small master/plan tables.  Each KPI is one aggregation of the journal on its
grain: Spark plans it as a partial (map-side) aggregate, one shuffle on the
grouping keys, and a final aggregate; all other inputs are small and joined
by broadcast after the aggregation, so the journal is shuffled exactly once
per KPI, and only as partial aggregates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config
from ..functions.columns import (
    count_if, exact_ratio, period_key, programme_key, ratio, wide, wide_div,
)
from ..functions.hints import dim
from ..session import cut_lineage
from .ordering import exact_median


# ----------------------------------------------------------------- KPI-02/03
def pl_actuals(vj: DataFrame) -> DataFrame:
    """AG1/AG2/KP21: P&L actuals with restricted key figures, special periods clamped to 12."""
    return vj.groupBy(
        "company_code", "company_name", "fiscal_year", F.col("reporting_period").alias("fiscal_period"),
        "pl_section", "account_group", "account_group_name",
    ).agg(
        F.sum("signed_amount_group").alias("amount_group_currency"),
        F.count(F.lit(1)).alias("line_count"),
        F.sum(F.when(F.col("is_manual_posting"), F.col("signed_amount_group")).otherwise(0))
        .alias("amount_manual"),
        count_if(F.col("is_manual_posting")).alias("line_count_manual"),
        count_if(F.col("is_late_posting")).alias("line_count_late"),
        count_if(F.col("fiscal_period") > 12).alias("line_count_year_end_adjustment"),
    )


def manual_share(vj: DataFrame, extra_keys: list[str] | None = None) -> DataFrame:
    """KP3: manual share by count and by absolute value per entity x period (+ drill keys).

    Shares are ratios of sums computed after the aggregation (AG9), never averages of ratios."""
    keys = ["company_code", "fiscal_year", F.col("reporting_period").alias("fiscal_period")] + (extra_keys or [])
    return vj.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("line_count"),
        count_if(F.col("is_manual_posting")).alias("manual_line_count"),
        F.sum(F.abs("amount_group_currency")).alias("total_value"),
        F.sum(F.when(F.col("is_manual_posting"), F.abs("amount_group_currency")).otherwise(0)).alias("manual_value"),
        F.sum(F.when(F.col("is_manual_posting"), F.col("signed_amount_group")).otherwise(0)).alias("amount_manual"),
    ).withColumn("manual_share", ratio("manual_line_count", "line_count")) \
     .withColumn("manual_value_share", ratio("manual_value", "total_value"))


def late_postings(vj: DataFrame, extra_keys: list[str] | None = None) -> DataFrame:
    """KP4: late postings count, value (sum of absolute amounts) and share; drill keys optional."""
    keys = ["company_code", "fiscal_year", F.col("reporting_period").alias("fiscal_period")] + (extra_keys or [])
    return vj.where(F.col("fiscal_period") <= 12).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("line_count"),
        count_if(F.col("is_late_posting")).alias("late_line_count"),
        F.sum(F.when(F.col("is_late_posting"), F.abs("amount_group_currency")).otherwise(0)).alias("late_value"),
    ).withColumn("late_share", ratio("late_line_count", "line_count"))


# ----------------------------------------------------------------- KPI-01
def close_tasks_harmonised(close_tasks: DataFrame, close_task: DataFrame, calendar: DataFrame) -> DataFrame:
    """KP1/JN5: task rows with catalogue attributes, ``is_open`` and ``days_to_close``.

    ``days_to_close`` = working days from period end to completion of the hard
    close (T12); NULL while open, never 0.  The calendar is joined twice
    (role-playing: period end, completion).
    """
    seq = calendar.select("date_id", "working_day_seq")
    pe = dim(seq).select(F.col("date_id").alias("__pe_d"), F.col("working_day_seq").alias("__pe_seq"))
    ac = dim(seq).select(F.col("date_id").alias("__ac_d"), F.col("working_day_seq").alias("__ac_seq"))
    x = (
        close_tasks.join(dim(close_task), "task_id", "inner")
        .join(pe, F.col("period_end_date") == F.col("__pe_d"), "left")
        .join(ac, F.col("actual_completion_date") == F.col("__ac_d"), "left")
    )
    return x.select(
        "close_task_id", "company_code", "fiscal_year", "fiscal_period", "task_id", "task_name",
        "task_sequence", "target_working_day", "is_milestone", "period_end_date", "due_date",
        "actual_completion_date", "completed_by_user_id", "delay_working_days",
        F.col("actual_completion_date").isNull().alias("is_open"),
        F.when((F.col("task_id") == config.HARD_CLOSE_TASK) & F.col("actual_completion_date").isNotNull(),
               F.col("__ac_seq") - F.col("__pe_seq")).alias("days_to_close"),
    )


def days_to_close(tasks_h: DataFrame) -> DataFrame:
    """KP2: days to close per entity x period (NULL if the hard close is open)."""
    return tasks_h.where(F.col("task_id") == config.HARD_CLOSE_TASK).select(
        "company_code", "fiscal_year", "fiscal_period", "is_open", "days_to_close"
    )


def postings_by_entity_period(vj: DataFrame) -> DataFrame:
    """Posting measures on the entity x reporting-period grain (special periods clamped)."""
    return vj.groupBy("company_code", "fiscal_year", F.col("reporting_period").alias("fiscal_period")).agg(
        F.count(F.lit(1)).alias("line_count"),
        count_if(F.col("is_manual_posting")).alias("manual_line_count"),
        count_if(F.col("is_late_posting")).alias("late_line_count"),
        F.sum(F.when(F.col("is_late_posting"), F.abs("amount_group_currency")).otherwise(0)).alias("late_value"),
    )


def close_monitor(tasks_h: DataFrame, vj: DataFrame) -> DataFrame:
    """KP5/JN8: task rows + entity-period posting measures (the measures repeat on every task row;
    never sum them across tasks)."""
    p = postings_by_entity_period(vj)
    return tasks_h.join(p, ["company_code", "fiscal_year", "fiscal_period"], "left").select(
        "company_code", "fiscal_year", "fiscal_period", "task_id", "task_name", "task_sequence",
        "is_milestone", "period_end_date", "due_date", "actual_completion_date", "delay_working_days",
        "is_open", "days_to_close", "line_count", "manual_line_count", "late_line_count", "late_value",
        F.when(F.col("line_count") > 0, ratio("manual_line_count", "line_count")).alias("manual_share"),
        F.when(F.col("line_count") > 0, ratio("late_line_count", "line_count")).alias("late_share"),
    )


def days_to_close_by_entity(tasks_h: DataFrame) -> DataFrame:
    """AG8: average / max days to close per entity ignoring open periods, and open-period count."""
    d = days_to_close(tasks_h)
    return d.groupBy("company_code").agg(
        F.avg("days_to_close").alias("avg_days_to_close"),
        F.max("days_to_close").alias("max_days_to_close"),
        count_if(F.col("days_to_close").isNull()).alias("open_periods"),
        F.count(F.lit(1)).alias("periods"),
    )


# ----------------------------------------------------------------- KPI-04
def budget_cells(budget: DataFrame) -> DataFrame:
    """KP6/ST1 at cell grain: annual budget per entity x FY x centre x group x programme key,
    phased evenly over 12 periods, unrounded (cents are for publishing), so that they sum back.

    Aggregating before the 12-way expansion keeps the expansion on the small
    cell table instead of on every budget row.
    """
    cells = budget.groupBy(
        "company_code", "fiscal_year", "cost_center", "account_group",
        programme_key().alias("programme_key"),
    ).agg(F.sum("amount_group_currency").alias("amount_annual"))
    return cells.select(
        "company_code", "fiscal_year",
        F.explode(F.sequence(F.lit(1), F.lit(12))).alias("fiscal_period"),
        "cost_center", "account_group", "programme_key", "amount_annual",
        wide_div("amount_annual", F.lit(12)).alias("budget_amount"),
    )


def actual_lines(vj: DataFrame) -> DataFrame:
    """Journal lines that count as actuals of the variance (regular periods, cost lines only)."""
    return vj.where(F.col("cost_center").isNotNull() & (F.col("fiscal_period") <= 12)).select(
        "company_code", "fiscal_year", F.col("reporting_period").alias("fiscal_period"), "cost_center",
        "account_group", programme_key().alias("programme_key"), F.col("signed_amount_group").alias("actual_amount"))


def actual_cells(vj: DataFrame) -> DataFrame:
    """KP8: actual side of the variance, summed to cells."""
    return actual_lines(vj).groupBy(*VARIANCE_KEYS).agg(F.sum("actual_amount").alias("actual_amount"))


VARIANCE_KEYS = ["company_code", "fiscal_year", "fiscal_period", "cost_center", "account_group", "programme_key"]


def budget_variance(actual: DataFrame, budget: DataFrame) -> DataFrame:
    """KP7/JN6: actuals and budget by cell; cells of either side alone survive.

    The full outer match is one aggregation: both sides are stacked, each with zero for the other
    measure, and grouped once, so the lines are shuffled once, as partial sums.  ``actual`` may be
    journal lines or cells.  ``variance_pct`` is NULL where the budget is zero or absent.
    """
    zero = F.lit(0).cast("decimal(30,8)")
    a = actual.select(*VARIANCE_KEYS, wide("actual_amount").alias("a"), zero.alias("b"))
    b = budget.select(*VARIANCE_KEYS, zero.alias("a"), wide("budget_amount").alias("b"))
    j = a.unionByName(b).groupBy(*VARIANCE_KEYS).agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    act, bud = F.col("a").cast("decimal(28,2)"), wide("b")
    return j.select(
        "company_code", "fiscal_year", "fiscal_period", "cost_center", "account_group",
        F.col("programme_key").alias("programme_id"),
        act.alias("actual_amount"), bud.alias("budget_amount"), wide(act - bud).alias("variance"),
        F.when(bud != 0, ratio(act - bud, F.abs(bud))).alias("variance_pct"),
    )


def variance_totals(actual: DataFrame, budget: DataFrame, keys: list[str]) -> DataFrame:
    """KP9/JN6: actual and budget by some of the variance keys without the period, in one exchange.

    ``actual`` may be lines, aggregate rows or cells; a budget row counts with its twelve phased shares.
    """
    zero, phased = F.lit(0).cast("decimal(30,8)"), wide_div("amount_group_currency", F.lit(12))
    b = budget.withColumn("programme_key", programme_key()).select(*keys, zero.alias("a"), wide(phased * 12).alias("b"))
    rows = actual.select(*keys, wide("actual_amount").alias("a"), zero.alias("b")).unionByName(b)
    return rows.groupBy(*keys).agg(F.sum("a").alias("actual"), F.sum("b").alias("budget"))


def last_closed_period(close_tasks: DataFrame) -> DataFrame:
    """Per fiscal year, the last period whose hard close completed for every entity."""
    t12 = close_tasks.where(F.col("task_id") == config.HARD_CLOSE_TASK)
    per = t12.groupBy("fiscal_year", "fiscal_period").agg(
        count_if(F.col("actual_completion_date").isNull()).alias("__open"))
    return per.where(F.col("__open") == 0).groupBy("fiscal_year").agg(
        F.max("fiscal_period").alias("last_closed_period"))


def variance_ytd(variance: DataFrame, last_closed: DataFrame) -> DataFrame:
    """PF9: year-to-date variance per entity x FY, bounded by the last closed period so an
    open year is not flattered by budget for periods that have not happened."""
    v = variance.join(dim(last_closed), "fiscal_year", "inner").where(
        F.col("fiscal_period") <= F.col("last_closed_period"))
    return v.groupBy("company_code", "fiscal_year", "last_closed_period").agg(
        F.sum("actual_amount").cast("decimal(28,2)").alias("actual_ytd"), wide(F.sum("budget_amount")).alias("budget_ytd"),
    ).withColumn("variance_ytd", wide(F.col("actual_ytd") - F.col("budget_ytd")))


def variance_by_period(variance: DataFrame) -> DataFrame:
    """KP9: dashboard roll-up by FY x period."""
    return variance.groupBy("fiscal_year", "fiscal_period").agg(
        F.sum("actual_amount").alias("actual_amount"), F.sum("budget_amount").alias("budget_amount"),
        F.sum("variance").alias("variance"),
    )


def variance_by_programme(variance: DataFrame, fiscal_year: int) -> DataFrame:
    """KP9: roll-up by programme for one FY (the benchmark's budget_variance_one_year)."""
    return variance.where(F.col("fiscal_year") == fiscal_year).groupBy("programme_id").agg(
        F.sum("actual_amount").alias("actual"), F.sum("budget_amount").alias("budget"),
    )


def variance_hierarchy_rollup(variance: DataFrame, cost_center: DataFrame) -> DataFrame:
    """AG16: variance on every cost-centre hierarchy node (entity > division > department > centre)."""
    cc = dim(cost_center, "cost_center", "division_id", "department_id")
    v = variance.join(cc, "cost_center", "left")
    return v.rollup("company_code", "division_id", "department_id", "cost_center").agg(
        F.sum("actual_amount").alias("actual_amount"), F.sum("budget_amount").alias("budget_amount"),
        F.sum("variance").alias("variance"),
        F.grouping_id("company_code", "division_id", "department_id", "cost_center").cast("int").alias("node_level"),
    )


# ----------------------------------------------------------------- KPI-05
def programme_runrate(vj: DataFrame, programme: DataFrame, fiscal_year: int, fiscal_period: int,
                      window: int) -> DataFrame:
    """KP10: actuals to date, run-rate = mean cost of the last ``window`` periods that had
    postings (unrounded), remaining periods to the programme end, EAC and EAC / budget.

    Programmes with no cost up to the as-of period do not appear (inner joins, JN9).
    The rank filter is a per-programme ``row_number`` whose window is over the
    small monthly aggregate, not the journal.
    """
    monthly = vj.where(F.col("programme_id").isNotNull() & (F.col("fiscal_period") <= 12)).groupBy(
        "programme_id", period_key().alias("period_key")).agg(F.sum("signed_amount_group").alias("period_cost"))
    return runrate_from_monthly(monthly, programme, fiscal_year, fiscal_period, window)


def runrate_from_monthly(monthly: DataFrame, programme: DataFrame, fiscal_year: int, fiscal_period: int,
                         window: int) -> DataFrame:
    """KP10 from a (programme_id, period_key, period_cost) table (journal- or aggregate-served).

    The last-N filter is ``row_number`` over the small monthly table (WN2); Spark
    plans the rank filter as a ``WindowGroupLimit`` below the window."""
    as_of = fiscal_year * 100 + fiscal_period
    monthly = monthly.where(F.col("period_key") <= F.lit(as_of))
    w = Window.partitionBy("programme_id").orderBy(F.col("period_key").desc())
    ranked = monthly.withColumn("recency", F.row_number().over(w))
    agg = ranked.groupBy("programme_id").agg(
        F.sum("period_cost").alias("actuals_to_date"),
        F.sum(F.when(F.col("recency") <= window, F.col("period_cost"))).alias("__rr_sum"),
        count_if(F.col("recency") <= window).alias("__rr_n"),
    )
    p = dim(programme)
    remaining = F.greatest(
        F.lit(0), (F.year("end_date") - fiscal_year) * 12 + (F.month("end_date") - fiscal_period)
    ).cast("int")
    rr = wide_div("__rr_sum", "__rr_n").cast("decimal(26,8)")
    x = agg.join(p, "programme_id", "inner").select(
        "programme_id", "programme_name", "programme_type",
        F.lit(fiscal_year).alias("as_of_fiscal_year"), F.lit(fiscal_period).alias("as_of_fiscal_period"),
        "actuals_to_date", rr.alias("run_rate"), remaining.alias("remaining_periods"),
        "total_budget_eur", "start_date", "end_date", "lead_company_code", "status",
    )
    x = x.withColumn("eac", wide(F.col("actuals_to_date").cast("decimal(28,2)") + F.col("run_rate") * F.col("remaining_periods").cast("decimal(6,0)")))
    return x.withColumn("eac_vs_budget_pct", exact_ratio("eac", "total_budget_eur", 4))


def programme_burn(runrate: DataFrame, as_of_date) -> DataFrame:
    """KP12: % budget consumed, % schedule elapsed (whole months, clamped to 0..1) and
    the gap between the two (positive = burning ahead of schedule)."""
    elapsed = F.floor(F.months_between(F.lit(as_of_date), F.col("start_date")))
    total = F.floor(F.months_between(F.col("end_date"), F.col("start_date")))
    pct_time = F.greatest(F.lit(0.0), F.least(F.lit(1.0), ratio(elapsed, F.when(total != 0, total))))
    return runrate.select(
        "*",
        exact_ratio("actuals_to_date", "total_budget_eur", 4).alias("pct_budget_consumed"),
        F.round(pct_time, 4).alias("pct_time_elapsed"),
    ).withColumn("burn_ahead", F.round(F.col("pct_budget_consumed") - F.col("pct_time_elapsed"), 4))


# ----------------------------------------------------------------- KPI-06
def fx_impact(vj: DataFrame) -> DataFrame:
    """FX6/KP13: actual-rate minus budget-rate translation of the same local amounts."""
    return vj.groupBy(
        "company_code", "company_name", "local_currency", "fiscal_year",
        F.col("reporting_period").alias("fiscal_period"), "account_group",
    ).agg(
        F.sum("signed_amount_group").alias("amount_group_booked"),
        F.sum("signed_amount_at_actual_rate").alias("amount_at_actual_rate"),
        F.sum("signed_amount_at_budget_rate").alias("amount_at_budget_rate"),
        (F.sum("signed_amount_at_actual_rate") - F.sum("signed_amount_at_budget_rate")).alias("fx_impact"),
        F.sum(F.col("amount_local_currency") * F.col("rate_budget")).alias("gross_at_budget_rate"),
        F.min("rate_actual").alias("rate_actual"),
        F.min("rate_budget").alias("rate_budget"),
    )


def fx_impact_cost_base(vj: DataFrame) -> DataFrame:
    """FX7: FX impact on cost lines only, per entity, with its share of the cost base."""
    cost = vj.where(F.col("account_group") != "REV")
    return cost.groupBy("company_code", "local_currency").agg(
        (F.sum("signed_amount_at_actual_rate") - F.sum("signed_amount_at_budget_rate")).alias("fx_impact"),
        F.sum("signed_amount_at_budget_rate").alias("cost_at_budget_rate"),
    ).withColumn("fx_share_of_cost", ratio("fx_impact", "cost_at_budget_rate"))


def fx_reversal_carryover(vj: DataFrame) -> DataFrame:
    """FX8: booked minus recomputed group amount (to cents, line by line) per entity x period;
    non-zero only where reversals carried the previous period's rate."""
    diff = F.col("signed_amount_group") - F.round("signed_amount_at_actual_rate", 2)
    return vj.groupBy("company_code", "fiscal_year", F.col("reporting_period").alias("fiscal_period")).agg(
        F.sum(diff).alias("carryover"),
        count_if(F.col("is_reversal")).alias("reversal_lines"),
    ).where(F.col("carryover") != 0)


# ----------------------------------------------------------------- KPI-07
def forecast_actuals(vj: DataFrame) -> DataFrame:
    """Actuals at the grain of the forecast: entity x centre x programme x period."""
    return vj.where((F.col("fiscal_period") <= 12) & F.col("cost_center").isNotNull()).groupBy(
        "company_code", "cost_center", programme_key().alias("programme_key"), "fiscal_year", "fiscal_period",
    ).agg(F.sum("signed_amount_group").alias("actual"))


def forecast_accuracy_rows(vj: DataFrame, forecast: DataFrame) -> DataFrame:
    """JN11: forecast cells matched to actuals on 5 keys; zero actuals excluded."""
    act = forecast_actuals(vj)
    f = forecast.select("company_code", "cost_center", programme_key().alias("programme_key"),
                        "fiscal_year", "fiscal_period", "version", "horizon_periods",
                        F.col("amount_group_currency").alias("forecast"))
    m = f.join(act, ["company_code", "cost_center", "programme_key", "fiscal_year", "fiscal_period"], "inner")
    m = m.where(F.col("actual") != 0)
    return m.withColumn(
        "abs_pct_error",
        F.abs(F.col("actual") - F.col("forecast")).cast("double") / F.abs(F.col("actual")).cast("double"),
    )


def forecast_accuracy(rows: DataFrame, extra_keys: list[str] | None = None) -> DataFrame:
    """KP14/KP16: MAPE and observations by version x horizon (x extra keys, e.g. cost centre)."""
    keys = (extra_keys or []) + ["version", "horizon_periods"]
    return rows.groupBy(*keys).agg(
        F.avg("abs_pct_error").alias("mape"), F.count(F.lit(1)).alias("observations"))


def forecast_accuracy_by_horizon(acc: DataFrame) -> DataFrame:
    """KP15: unweighted mean of the version MAPEs and total observations per horizon."""
    return acc.groupBy("horizon_periods").agg(
        F.avg("mape").alias("mean_mape"), F.sum("observations").cast("long").alias("observations"))


# ----------------------------------------------------------------- KPI-08
def ic_reconciliation(vj: DataFrame, materiality: float = config.IC_MATERIALITY_EUR) -> DataFrame:
    """KP17/AG14: net per unordered entity pair x reporting period, flagged above materiality
    (the flag is computed on the aggregate)."""
    return vj.where(F.col("is_intercompany")).groupBy(
        "ic_pair", "fiscal_year", F.col("reporting_period").alias("fiscal_period"),
    ).agg(
        F.sum("signed_amount_group").alias("net_amount"), F.count(F.lit(1)).alias("line_count"),
    ).withColumn("is_mismatch", F.abs("net_amount") > F.lit(materiality))


def ic_open_items(ic: DataFrame) -> DataFrame:
    """KP18: flagged pairs only, newest first, with a display label."""
    return ic.where("is_mismatch").select(
        "*", F.regexp_replace("ic_pair", r"\|", " ↔ ").alias("pair_label"),
    ).orderBy(F.col("fiscal_year").desc(), F.col("fiscal_period").desc(), "ic_pair")


def ic_open_item_stats(ic: DataFrame) -> DataFrame:
    """AG13: pair-periods, flagged count and share, max and median absolute net.

    The median is found by counting value ranges (``ordering.exact_median``), so no task holds all values.
    """
    items = cut_lineage(ic.select("is_mismatch", F.abs("net_amount").alias("size")))
    return items.agg(
        F.count(F.lit(1)).alias("pair_periods"),
        count_if(F.col("is_mismatch")).alias("flagged"),
        F.avg(F.col("is_mismatch").cast("double")).alias("flagged_share"),
        F.max("size").alias("max_abs_net"),
    ).withColumn("median_abs_net", F.lit(exact_median(items, "size")).cast("double"))
