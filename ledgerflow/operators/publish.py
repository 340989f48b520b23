"""Published interface views (PB1-PB8, PF2, PF10, PF11, LG6, QC20).

The published layer renames to the contract, adds a ``YYYY-PP`` label and the
currency, rounds money to cents and ratios to four decimals, and adds traffic-
light criticality codes.  Description lookups are broadcast joins after the
KPI's aggregation, so they never touch the journal.  No published view
exposes a pseudonymous user column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions.columns import criticality, exact_ratio, period_label, ratio, wide
from ..functions.hints import dim, to_one


def drop_user_columns(df: DataFrame) -> DataFrame:
    """PF10: remove pseudonymous user columns."""
    return df.drop(*[c for c in config.PSEUDONYM_COLUMNS if c in df.columns])


def exposed_user_columns(views: dict[str, DataFrame]) -> list[tuple[str, str]]:
    """QC20 helper: (view, column) pairs that expose a pseudonymous user column."""
    return [(name, c) for name, df in views.items() for c in df.columns if c in config.PSEUDONYM_COLUMNS]


def _group_names(gl_account: DataFrame) -> DataFrame:
    """AG15/JN10: distinct (group, name) pairs, broadcast onto the result."""
    return dim(gl_account.select("account_group", "account_group_name").distinct())


def api_budget_variance(variance: DataFrame, company: DataFrame, cost_center: DataFrame,
                        programme: DataFrame, gl_account: DataFrame) -> DataFrame:
    """PB1: published budget variance with descriptions and criticality
    (NULL -> 0, > 10 % -> 1, > 5 % -> 2, else 3)."""
    v = (
        variance.join(dim(company, "company_code", "company_name"), "company_code", "left")
        .join(dim(cost_center, "cost_center", "cost_center_name", "division_name"), "cost_center", "left")
        .join(dim(programme, "programme_id", "programme_name"), "programme_id", "left")
        .join(_group_names(gl_account), "account_group", "left")
    )
    return v.select(
        "company_code", "company_name", "fiscal_year", "fiscal_period",
        period_label().alias("fiscal_period_label"),
        "cost_center", "cost_center_name", "division_name", "programme_id",
        F.coalesce("programme_name", F.lit("Not programme-related")).alias("programme_name"),
        "account_group", "account_group_name",
        F.round("actual_amount", 2).alias("actual_amount"),
        F.round("budget_amount", 2).alias("budget_amount"),
        F.round("variance", 2).alias("variance"),
        exact_ratio("variance", "budget_amount", 4).alias("variance_pct"),
        F.lit(config.GROUP_CURRENCY).alias("currency"),
        criticality("variance_pct", config.VARIANCE_CRITICAL_PCT, config.VARIANCE_WARNING_PCT)
        .alias("variance_criticality"),
    )


def api_programme_burn(burn: DataFrame) -> DataFrame:
    """PB2/JN17: published programme burn (run-rate result joined to the programme) with EAC
    criticality (> 110 % -> 1, > 100 % -> 2, else 3)."""
    return burn.select(
        "programme_id", "programme_name", "programme_type", "lead_company_code", "status",
        "start_date", "end_date",
        F.round("actuals_to_date", 2).alias("actuals_to_date"), F.round("run_rate", 2).alias("run_rate"),
        "remaining_periods", F.round("eac", 2).alias("eac"),
        F.round("total_budget_eur", 2).alias("total_budget"), "eac_vs_budget_pct",
        F.lit(config.GROUP_CURRENCY).alias("currency"),
        "pct_budget_consumed", "pct_time_elapsed",
        F.when(F.col("eac_vs_budget_pct") > config.EAC_CRITICAL_PCT, 1)
        .when(F.col("eac_vs_budget_pct") > config.EAC_WARNING_PCT, 2).otherwise(3).alias("eac_criticality"),
    )


def api_close_monitor(monitor: DataFrame, company: DataFrame) -> DataFrame:
    """PB3: published close monitor with close criticality (NULL 0, > 7 days 1, > 5 days 2, else 3)."""
    m = monitor.join(dim(company, "company_code", "company_name"), "company_code", "left")
    return m.select(
        "company_code", "company_name", "fiscal_year", "fiscal_period",
        period_label().alias("fiscal_period_label"), "task_id", "task_name", "task_sequence",
        "is_milestone", "period_end_date", "due_date", "actual_completion_date", "delay_working_days",
        "is_open", "days_to_close", "line_count", "manual_line_count", "late_line_count",
        F.round("late_value", 2).alias("late_value"),
        exact_ratio("manual_line_count", "line_count", 4).alias("manual_share"),
        exact_ratio("late_line_count", "line_count", 4).alias("late_share"),
        criticality("days_to_close", config.CLOSE_CRITICAL_DAYS, config.CLOSE_WARNING_DAYS)
        .alias("close_criticality"),
    )


def api_pl_actuals(pl: DataFrame) -> DataFrame:
    """PB4: published P&L actuals."""
    return pl.select(
        "company_code", "company_name", "fiscal_year", "fiscal_period",
        period_label().alias("fiscal_period_label"), "pl_section", "account_group", "account_group_name",
        F.round("amount_group_currency", 2).alias("amount"), F.round("amount_manual", 2).alias("amount_manual"),
        "line_count", "line_count_manual", "line_count_late", F.lit(config.GROUP_CURRENCY).alias("currency"),
    )


def api_ic_reconciliation(ic: DataFrame) -> DataFrame:
    """PB5: published intercompany reconciliation."""
    return ic.select("ic_pair", "fiscal_year", "fiscal_period", F.round("net_amount", 2).alias("net_amount"),
                     "line_count", "is_mismatch", F.lit(config.GROUP_CURRENCY).alias("currency"))


def _band(value, green: float, amber: float):
    v = F.col(value)
    return F.when(v.isNull(), F.lit(None)).when(v <= green, "GREEN").when(v <= amber, "AMBER").otherwise("RED")


def kpi_status_bands(manual: DataFrame, late: DataFrame) -> DataFrame:
    """PB6: documented status bands (manual share 12 / 20 %, late share 2 / 5 %) per entity x period."""
    m = manual.select("company_code", "fiscal_year", "fiscal_period", "manual_share")
    lt = late.select("company_code", "fiscal_year", "fiscal_period", "late_share")
    j = m.join(lt, ["company_code", "fiscal_year", "fiscal_period"], "full_outer")
    return j.select(
        "company_code", "fiscal_year", "fiscal_period", "manual_share",
        _band("manual_share", *config.MANUAL_SHARE_BANDS).alias("manual_status"),
        "late_share", _band("late_share", *config.LATE_SHARE_BANDS).alias("late_status"),
    )


def mape_status(acc: DataFrame) -> DataFrame:
    """PB6: MAPE limit check (10 % at horizon 1, 20 % at horizon 3)."""
    limit = F.lit(None).cast("double")
    for h, lim in sorted(config.MAPE_LIMITS.items(), reverse=True):
        limit = F.when(F.col("horizon_periods") == h, F.lit(lim)).otherwise(limit)
    return acc.withColumn("mape_limit", limit).withColumn(
        "mape_status", F.when(F.col("mape_limit").isNull(), F.lit(None))
        .when(F.col("mape") <= F.col("mape_limit"), "GREEN").otherwise("RED"))


def retention_tiers(journal: DataFrame, as_of, full_months: int = 24, keep_years: int = 7) -> dict[str, DataFrame]:
    """PB7: lines up to ``full_months`` old keep the user id; up to ``keep_years`` old drop it;
    older lines survive only as an aggregate by entity x period x account."""
    cut_full = F.add_months(F.lit(as_of), -full_months)
    cut_keep = F.add_months(F.lit(as_of), -12 * keep_years)
    recent = journal.where(F.col("posting_date") > cut_full)
    middle = drop_user_columns(journal.where((F.col("posting_date") <= cut_full) & (F.col("posting_date") > cut_keep)))
    old = journal.where(F.col("posting_date") <= cut_keep).groupBy(
        "company_code", "fiscal_year", "fiscal_period", "gl_account").agg(
        F.sum(F.when(F.col("debit_credit_ind") == "S", F.col("amount_group_currency"))
              .otherwise(-F.col("amount_group_currency"))).alias("signed_amount_group"),
        F.count(F.lit(1)).alias("line_count"))
    return {"full": recent, "pseudonymised": middle, "aggregate_only": old}


def analytical_query(variance: DataFrame, fiscal_year: int = config.AS_OF_YEAR,
                     fiscal_period: int = config.AS_OF_PERIOD,
                     group_by: tuple[str, ...] = ("company_code", "programme_id")) -> DataFrame:
    """PB8: default-sum analytical query: year-to-date sums up to the parameter period."""
    v = variance.where((F.col("fiscal_year") == fiscal_year) & (F.col("fiscal_period") <= fiscal_period))
    return v.groupBy(*group_by).agg(
        F.sum("actual_amount").alias("actual_amount"), F.sum("budget_amount").alias("budget_amount"),
        F.sum("variance").alias("variance"),
    ).withColumn("variance_pct", ratio("variance", F.abs(F.col("budget_amount"))))


def analytical_runrate(runrate: DataFrame, group_by: tuple[str, ...] = ("lead_company_code", "programme_type")) -> DataFrame:
    """PB8: default-sum analytical query over run-rate; the ratio is taken of the sums."""
    x = runrate.groupBy(*group_by).agg(
        F.sum("actuals_to_date").alias("actuals_to_date"), F.sum("run_rate").alias("run_rate"),
        wide(F.sum("eac")).alias("eac"), F.sum("total_budget_eur").alias("total_budget_eur"))
    return x.withColumn("eac_vs_budget_pct", exact_ratio("eac", "total_budget_eur", 4))


def journal_interface(journal: DataFrame, company: DataFrame, gl_account: DataFrame,
                      cost_center: DataFrame, programme: DataFrame) -> DataFrame:
    """LG6/JN16: journal interface without FX and late flag; lookups behave as to-one associations
    (left joins to sides made unique on their key, so the optimizer drops those that are not used)."""
    co = to_one(company, ["company_code"], "company_name")
    acc = to_one(gl_account, ["gl_account"], "account_group", "pl_section")
    cc = to_one(cost_center, ["cost_center"], "cost_center_name")
    pg = to_one(programme, ["programme_id"], "programme_name")
    j = (journal.join(co, "company_code", "left").join(acc, "gl_account", "left")
         .join(cc, "cost_center", "left").join(pg, "programme_id", "left"))
    sign = F.when(F.col("debit_credit_ind") == "S", F.lit(1)).otherwise(F.lit(-1))
    return drop_user_columns(j.select(
        "journal_id", "company_code", "company_name", "document_number", "document_line", "document_type",
        "posting_date", "fiscal_year", "fiscal_period",
        F.least(F.col("fiscal_period"), F.lit(12)).alias("reporting_period"),
        "gl_account", "account_group", "pl_section", "cost_center", "cost_center_name",
        "programme_id", "programme_name", "debit_credit_ind",
        (F.col("amount_group_currency") * sign).alias("signed_amount_group"),
        (F.col("amount_local_currency") * sign).alias("signed_amount_local"),
        F.col("document_type").isin(config.MANUAL_DOCUMENT_TYPES).alias("is_manual_posting"),
        "is_intercompany", "ic_partner_company", "is_reversal", "reversed_document",
    ))


def master_data_interface(cost_center: DataFrame, gl_account: DataFrame, programme: DataFrame,
                          calendar: DataFrame) -> dict[str, DataFrame]:
    """PF11: master-data projections without user columns, and the distinct regular periods."""
    return {
        "cost_center": drop_user_columns(cost_center),
        "gl_account": gl_account,
        "programme": programme,
        "fiscal_periods": calendar.select("fiscal_year", "fiscal_period").distinct()
        .where(F.col("fiscal_period") <= 12),
    }
