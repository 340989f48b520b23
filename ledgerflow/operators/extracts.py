"""Curated planning extracts (EX1-EX6, ST2, WN5).

Extracts keep special periods as their own rows but clamp ``period_date`` and
the label to December (D22).  The version stack puts actual, budget and the
latest forecast side by side on one ``version`` column with ``unionByName``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import decimal_div_cents, period_label, period_start_date, programme_key
from ..functions.hints import dim
from .kpis import close_tasks_harmonised


def add_period_date(df: DataFrame) -> DataFrame:
    """EX1: first day of the clamped period and a zero-padded ``YYYY-PP`` label."""
    return df.withColumn("period_date", period_start_date()).withColumn(
        "fiscal_period_label", period_label("fiscal_year", F.least(F.col("fiscal_period"), F.lit(12))))


def extract_pl_actuals(vj: DataFrame) -> DataFrame:
    """EX2: P&L by entity x FY x period (special periods separate) x section x group."""
    g = vj.groupBy("company_code", "company_name", "fiscal_year", "fiscal_period", "pl_section",
                   "account_group", "account_group_name").agg(
        F.round(F.sum("signed_amount_group"), 2).alias("amount_group_currency"),
        F.count(F.lit(1)).alias("line_count"),
        F.sum(F.col("is_manual_posting").cast("long")).alias("manual_line_count"),
    )
    return add_period_date(g)


def extract_programme_costs(vj: DataFrame, programme: DataFrame) -> DataFrame:
    """EX3: programme cost by programme x entity x period x group, with the (repeated,
    non-additive) programme budget."""
    g = vj.where(F.col("programme_id").isNotNull()).groupBy(
        "programme_id", "company_code", "fiscal_year", "fiscal_period", "account_group").agg(
        F.round(F.sum("signed_amount_group"), 2).alias("amount_group_currency"))
    p = dim(programme, "programme_id", "programme_name", "programme_type", "total_budget_eur")
    return add_period_date(g.join(p, "programme_id", "left"))


def extract_close_tasks(close_tasks: DataFrame, close_task: DataFrame, company: DataFrame,
                        calendar: DataFrame) -> DataFrame:
    """EX4: task rows with days to close and the period-open flag."""
    t = close_tasks_harmonised(close_tasks, close_task, calendar)
    t = t.join(dim(company, "company_code", "company_name"), "company_code", "left")
    return add_period_date(t.select(
        "close_task_id", "company_code", "company_name", "fiscal_year", "fiscal_period", "task_id",
        "task_name", "task_sequence", "target_working_day", "period_end_date", "due_date",
        "actual_completion_date", "delay_working_days", "days_to_close",
        F.col("is_open").alias("is_period_open"),
    ))


def latest_forecast_rows(forecast: DataFrame) -> DataFrame:
    """WN5: latest snapshot per target cell (entity, programme, FY, period, centre)."""
    w = Window.partitionBy("company_code", "programme_key", "fiscal_year", "fiscal_period", "cost_center") \
        .orderBy("horizon_periods", "version")
    f = forecast.withColumn("programme_key", programme_key())
    return f.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") == 1).drop("__rn")


def version_stack(vj: DataFrame, budget: DataFrame, forecast: DataFrame) -> DataFrame:
    """EX5/ST2: ACTUAL by group, BUDGET phased / 12 to cents, latest FORECAST at group ``(all)``."""
    keys = ["company_code", "programme_key", "account_group", "fiscal_year", "fiscal_period"]
    actual = vj.where(F.col("fiscal_period") <= 12).groupBy(
        "company_code", programme_key().alias("programme_key"), "account_group", "fiscal_year",
        "fiscal_period").agg(F.sum("signed_amount_group").alias("amount_group_currency")) \
        .withColumn("version", F.lit("ACTUAL"))
    annual = budget.groupBy("company_code", programme_key().alias("programme_key"), "account_group",
                            "fiscal_year").agg(F.sum("amount_group_currency").alias("annual"))
    budget_rows = annual.select(
        "company_code", "programme_key", "account_group", "fiscal_year",
        F.explode(F.sequence(F.lit(1), F.lit(12))).alias("fiscal_period"),
        decimal_div_cents("annual", F.lit(12)).alias("amount_group_currency"),
    ).withColumn("version", F.lit("BUDGET"))
    fc = latest_forecast_rows(forecast).groupBy("company_code", "programme_key", "fiscal_year",
                                                "fiscal_period").agg(
        F.sum("amount_group_currency").alias("amount_group_currency")) \
        .withColumn("account_group", F.lit("(all)")).withColumn("version", F.lit("FORECAST"))
    cols = keys + ["version", "amount_group_currency"]
    stacked = actual.select(*cols).unionByName(budget_rows.select(*cols)).unionByName(fc.select(*cols))
    return add_period_date(stacked.withColumn("amount_group_currency", F.round("amount_group_currency", 2))
                           .withColumnRenamed("programme_key", "programme_id"))


def version_pivot(stack: DataFrame, fiscal_year: int) -> DataFrame:
    """EX6: programme x version table for one year with variance (actual - budget) abs and %."""
    s = stack.where(F.col("fiscal_year") == fiscal_year)
    p = s.groupBy("programme_id").pivot("version", ["ACTUAL", "BUDGET", "FORECAST"]).agg(
        F.sum("amount_group_currency"))
    p = p.select("programme_id", F.col("ACTUAL").alias("actual"), F.col("BUDGET").alias("budget"),
                 F.col("FORECAST").alias("forecast"))
    var = F.coalesce(F.col("actual"), F.lit(0)) - F.coalesce(F.col("budget"), F.lit(0))
    return p.withColumn("variance", var).withColumn(
        "variance_pct", F.try_divide(var.cast("double"), F.abs(F.col("budget")).cast("double")))
