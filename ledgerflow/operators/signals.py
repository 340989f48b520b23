"""Signal detectors (SG1-SG11, WN8): the data stories a close team looks for.

Each detector aggregates the journal (or a KPI) to a small result first; the
ranking windows run over those few rows (one per entity or programme), never
over the journal.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import count_if, period_key, ratio
from ..functions.hints import dim
from . import calendar as cal
from .kpis import days_to_close


def slow_closer(tasks_h: DataFrame, company: DataFrame) -> DataFrame:
    """SG1/WN8: entities by average days to close, gap to the next slowest, share of closed
    periods that missed the hard-close target working day."""
    d = days_to_close(tasks_h).join(dim(company, "company_code", "hard_close_target_wd"), "company_code")
    e = d.where(F.col("days_to_close").isNotNull()).groupBy("company_code").agg(
        F.avg("days_to_close").alias("avg_days_to_close"),
        F.avg((F.col("days_to_close") > F.col("hard_close_target_wd")).cast("double")).alias("miss_share"),
        F.count(F.lit(1)).alias("closed_periods"),
    )
    w = Window.orderBy(F.col("avg_days_to_close").desc(), "company_code")  # bounded: one row per entity
    return e.withColumn("rank", F.row_number().over(w)).withColumn(
        "gap_to_next", F.col("avg_days_to_close") - F.lead("avg_days_to_close").over(w))


def _programme_monthly(vj: DataFrame) -> DataFrame:
    return vj.where(F.col("programme_id").isNotNull() & (F.col("fiscal_period") <= 12)).groupBy(
        "programme_id", "fiscal_year", "fiscal_period").agg(F.sum("signed_amount_group").alias("cost"))


def burn_acceleration(vj: DataFrame, year_a: int, year_b: int) -> DataFrame:
    """SG2: mean monthly burn in year B over year A per programme."""
    m = _programme_monthly(vj)
    g = m.groupBy("programme_id").agg(
        F.sum(F.when(F.col("fiscal_year") == year_a, F.col("cost"))).alias("cost_a"),
        count_if(F.col("fiscal_year") == year_a).alias("n_a"),
        F.sum(F.when(F.col("fiscal_year") == year_b, F.col("cost"))).alias("cost_b"),
        count_if(F.col("fiscal_year") == year_b).alias("n_b"),
    )
    mean_a = ratio("cost_a", "n_a")
    mean_b = ratio("cost_b", "n_b")
    return g.select("programme_id", mean_a.alias("mean_burn_a"), mean_b.alias("mean_burn_b"),
                    F.try_divide(mean_b, mean_a).alias("acceleration"))


def before_after_burn(vj: DataFrame, split_period_key: int) -> DataFrame:
    """SG3: mean monthly burn before and from a period on, per programme."""
    m = _programme_monthly(vj).withColumn("pk", period_key())
    before = F.col("pk") < split_period_key
    g = m.groupBy("programme_id").agg(
        F.sum(F.when(before, F.col("cost"))).alias("cost_before"), count_if(before).alias("n_before"),
        F.sum(F.when(~before, F.col("cost"))).alias("cost_after"), count_if(~before).alias("n_after"),
    )
    return g.select("programme_id", ratio("cost_before", "n_before").alias("mean_burn_before"),
                    ratio("cost_after", "n_after").alias("mean_burn_after"))


def programme_over_annual_budget(vj: DataFrame, budget: DataFrame, fiscal_year: int) -> DataFrame:
    """SG4: FY actual (regular periods, cost lines) against FY budget per programme."""
    a = vj.where((F.col("fiscal_year") == fiscal_year) & (F.col("fiscal_period") <= 12)
                 & F.col("programme_id").isNotNull() & F.col("cost_center").isNotNull()) \
        .groupBy("programme_id").agg(F.sum("signed_amount_group").alias("actual"))
    b = budget.where((F.col("fiscal_year") == fiscal_year) & F.col("programme_id").isNotNull()) \
        .groupBy("programme_id").agg(F.sum("amount_group_currency").alias("budget"))
    j = a.join(b, "programme_id", "full_outer")
    return j.withColumn("actual_over_budget", ratio("actual", "budget"))


def rate_movement(rates: DataFrame) -> DataFrame:
    """SG6: max / min actual rate per currency and the relative move."""
    g = rates.where(F.col("rate_type") == "M").groupBy("from_currency").agg(
        F.max("exchange_rate").alias("max_rate"), F.min("exchange_rate").alias("min_rate"))
    return g.withColumn("relative_move", ratio(F.col("max_rate") - F.col("min_rate"), "min_rate"))


def manual_close_window(vj: DataFrame, calendar: DataFrame, first_wd: int = 1, last_wd: int = 5) -> DataFrame:
    """SG7: share of manual regular-period entries, reversals left out, entered on working day 1..5
    after period end."""
    m = vj.where(F.col("is_manual_posting") & ~F.col("is_reversal") & (F.col("fiscal_period") <= 12)).select(
        "company_code", "entry_date", F.last_day(F.make_date("fiscal_year", "fiscal_period", F.lit(1))).alias("pe"))
    m = cal.working_days_between(m, "pe", "entry_date", calendar, "wd_after")
    inside = (F.col("wd_after") >= first_wd) & (F.col("wd_after") <= last_wd)
    return m.groupBy("company_code").agg(
        F.count(F.lit(1)).alias("manual_lines"), count_if(inside).alias("in_close_window"),
    ).withColumn("close_window_share", ratio("in_close_window", "manual_lines"))


def concentration(vj: DataFrame, flag: str, regular_only: bool) -> DataFrame:
    """SG8: an entity's flag share against the highest share among the other entities."""
    src = vj.where(F.col("fiscal_period") <= 12) if regular_only else vj
    e = src.groupBy("company_code").agg(F.count(F.lit(1)).alias("lines"), count_if(F.col(flag)).alias("flagged"))
    e = e.withColumn("share", ratio("flagged", "lines"))
    w = Window.orderBy("company_code")  # bounded: one row per entity
    before = F.max("share").over(w.rowsBetween(Window.unboundedPreceding, -1))
    after = F.max("share").over(w.rowsBetween(1, Window.unboundedFollowing))
    others = F.greatest(F.coalesce(before, F.lit(None)), F.coalesce(after, F.lit(None)))
    return e.withColumn("max_share_others", others).withColumn(
        "share_over_others", F.try_divide(F.col("share"), F.col("max_share_others")))


def punctuality(vj: DataFrame, account_group: str = "PER") -> DataFrame:
    """SG9: distinct entry dates per entity x period for automatic postings of one account group."""
    p = vj.where((F.col("account_group") == account_group) & ~F.col("is_manual_posting")
                 & (F.col("fiscal_period") <= 12))
    return p.groupBy("company_code", "fiscal_year", "fiscal_period").agg(
        F.countDistinct("entry_date").alias("distinct_entry_dates"), F.count(F.lit(1)).alias("lines"))


def year_end_adjustments(vj: DataFrame) -> DataFrame:
    """SG10: special-period lines per year: manual, dated 31 December, entered next year, share of year."""
    y = vj.groupBy("fiscal_year").agg(
        F.count(F.lit(1)).alias("year_lines"),
        count_if(F.col("fiscal_period") > 12).alias("special_lines"),
        count_if((F.col("fiscal_period") > 12) & F.col("is_manual_posting")).alias("special_manual"),
        count_if((F.col("fiscal_period") > 12) & (F.month("posting_date") == 12)
                 & (F.dayofmonth("posting_date") == 31)).alias("special_dated_dec31"),
        count_if((F.col("fiscal_period") > 12) & (F.year("entry_date") > F.col("fiscal_year")))
        .alias("special_entered_next_year"),
    )
    return y.withColumn("special_share", ratio("special_lines", "year_lines"))


def open_year_flattery(variance: DataFrame, fiscal_year: int, last_closed_period: int) -> DataFrame:
    """SG11: actual / full-year budget against actual / year-to-date budget, per entity."""
    v = variance.where(F.col("fiscal_year") == fiscal_year)
    g = v.groupBy("company_code").agg(
        F.sum(F.when(F.col("fiscal_period") <= last_closed_period, F.col("actual_amount"))).alias("actual_ytd"),
        F.sum("budget_amount").alias("budget_full_year"),
        F.sum(F.when(F.col("fiscal_period") <= last_closed_period, F.col("budget_amount"))).alias("budget_ytd"),
    )
    return g.withColumn("vs_full_year", ratio("actual_ytd", "budget_full_year")) \
        .withColumn("vs_ytd", ratio("actual_ytd", "budget_ytd"))
