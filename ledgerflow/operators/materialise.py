"""Materialised monthly aggregate and the views served from it (AG4-AG7, SC8, SC9).

Catalyst has no materialised-view rewrite, so the aggregate is an explicit
table: built by one aggregation of the harmonised journal (partial aggregation
before the shuffle), written as Parquet partitioned by fiscal year, and read
back by the ``*_from_agg`` functions.  It keeps every distinction a consumer
filters on (special-period flag, local currency, programme, cost centre) and
full decimal scale on the rate-multiplied sums, so re-aggregating it gives the
base views' answers exactly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import count_if, programme_key
from ..functions.hints import dim
from . import kpis

AGG_KEYS = [
    "company_code", "fiscal_year", "fiscal_period", "account_group", "pl_section", "programme_id",
    "cost_center", "is_special_period", "local_currency",
]


def agg_journal_monthly(vj: DataFrame) -> DataFrame:
    """AG4: entity x FY x reporting period x group x section x programme x centre x special flag
    x currency, with nine measures."""
    return vj.groupBy(
        "company_code", "fiscal_year", F.col("reporting_period").alias("fiscal_period"), "account_group",
        "pl_section", "programme_id", "cost_center",
        (F.col("fiscal_period") > 12).alias("is_special_period"), "local_currency",
    ).agg(
        F.sum("signed_amount_group").alias("signed_amount_group"),
        F.sum("signed_amount_at_actual_rate").alias("signed_amount_at_actual"),
        F.sum("signed_amount_at_budget_rate").alias("signed_amount_at_budget"),
        F.sum(F.col("amount_local_currency") * F.col("rate_budget")).alias("gross_amount_at_budget"),
        F.sum(F.when(F.col("is_manual_posting"), F.col("signed_amount_group")).otherwise(0)).alias("amount_manual"),
        F.count(F.lit(1)).alias("line_count"),
        count_if(F.col("is_manual_posting")).alias("line_count_manual"),
        count_if(F.col("is_late_posting")).alias("line_count_late"),
        count_if(F.col("fiscal_period") > 12).alias("line_count_special_period"),
    )


def write_aggregate(agg: DataFrame, path: str) -> None:
    """SC8/SC9: full rebuild, one folder per fiscal year (static/dynamic partition pruning)."""
    agg.write.mode("overwrite").partitionBy("fiscal_year").parquet(path)


def _group_names(gl_account: DataFrame) -> DataFrame:
    return dim(gl_account.select("account_group", "account_group_name").distinct())


def pl_actuals_from_agg(agg: DataFrame, company: DataFrame, gl_account: DataFrame) -> DataFrame:
    """AG5: P&L actuals re-aggregated from the monthly aggregate; descriptions are attached
    to the (small) result, not to the aggregate rows."""
    g = agg.groupBy("company_code", "fiscal_year", "fiscal_period", "pl_section", "account_group").agg(
        F.sum("signed_amount_group").alias("amount_group_currency"),
        F.sum("line_count").cast("long").alias("line_count"),
        F.sum("amount_manual").alias("amount_manual"),
        F.sum("line_count_manual").cast("long").alias("line_count_manual"),
        F.sum("line_count_late").cast("long").alias("line_count_late"),
        F.sum("line_count_special_period").cast("long").alias("line_count_year_end_adjustment"),
    )
    return g.join(dim(company, "company_code", "company_name"), "company_code", "inner") \
        .join(_group_names(gl_account), "account_group", "left")


def fx_impact_from_agg(agg: DataFrame, company: DataFrame) -> DataFrame:
    """AG6: FX impact re-aggregated from the monthly aggregate (no rate columns, D10)."""
    a = agg.join(dim(company, "company_code", "company_name"), "company_code", "inner")
    return a.groupBy("company_code", "company_name", "local_currency", "fiscal_year", "fiscal_period",
                     "account_group").agg(
        F.sum("signed_amount_group").alias("amount_group_booked"),
        F.sum("signed_amount_at_actual").alias("amount_at_actual_rate"),
        F.sum("signed_amount_at_budget").alias("amount_at_budget_rate"),
        (F.sum("signed_amount_at_actual") - F.sum("signed_amount_at_budget")).alias("fx_impact"),
        F.sum("gross_amount_at_budget").alias("gross_at_budget_rate"),
    )


def actual_rows_from_agg(agg: DataFrame) -> DataFrame:
    """AG7 actual side: the aggregate's rows of regular periods and cost lines, in the columns of the variance."""
    return agg.where(~F.col("is_special_period") & F.col("cost_center").isNotNull()).select(
        "company_code", "fiscal_year", "fiscal_period", "cost_center", "account_group",
        programme_key().alias("programme_key"), F.col("signed_amount_group").alias("actual_amount"))


def actual_cells_from_agg(agg: DataFrame) -> DataFrame:
    """AG7 actual side, summed to cells."""
    return actual_rows_from_agg(agg).groupBy(*kpis.VARIANCE_KEYS).agg(F.sum("actual_amount").alias("actual_amount"))


def budget_variance_from_agg(agg: DataFrame, budget_cells: DataFrame) -> DataFrame:
    """AG7: KPI-04 with the actual side served from the aggregate."""
    return kpis.budget_variance(actual_cells_from_agg(agg), budget_cells)


def shares_from_agg(agg: DataFrame) -> DataFrame:
    """Line, manual and late counts per entity and period from the aggregate (the parts of KPI-02 and KPI-03)."""
    return agg.groupBy("company_code", "fiscal_year", "fiscal_period").agg(
        *[F.sum(c).alias(c) for c in ("line_count", "line_count_manual", "amount_manual", "line_count_late")])


def forecast_actuals_from_agg(agg: DataFrame) -> DataFrame:
    """Actuals at the grain of the forecast from the aggregate (KPI-07)."""
    return actual_rows_from_agg(agg).groupBy("company_code", "cost_center", "programme_key", "fiscal_year", "fiscal_period").agg(
        F.sum("actual_amount").alias("actual"))


def programme_monthly_from_agg(agg: DataFrame) -> DataFrame:
    """KPI-05 input from the aggregate: regular-period cost per programme and period key."""
    return agg.where(~F.col("is_special_period") & F.col("programme_id").isNotNull()).groupBy(
        "programme_id", (F.col("fiscal_year") * 100 + F.col("fiscal_period")).alias("period_key")
    ).agg(F.sum("signed_amount_group").alias("period_cost"))
