"""Planning operators (PL1-PL9, KP6 phasing helpers).

Plans are built from actuals by aggregation (one shuffle on the plan grain,
with map-side partial sums) followed by row-wise expansion with
``explode(sequence(...))`` — never a join against a generated grid.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config
from ..functions.columns import (
    cents, cents_to_decimal, count_if, div_half_up, period_end_date, period_key, programme_key, signed,
)
from ..functions.hints import dim
from . import calendar as cal


def _regular_cost_lines(journal: DataFrame) -> DataFrame:
    return journal.where((F.col("fiscal_period") <= 12) & F.col("cost_center").isNotNull())


def plan_actuals(journal: DataFrame, gl_account: DataFrame) -> DataFrame:
    """PL1/KP8: signed regular actuals at plan grain; NULL programme -> sentinel."""
    acc = dim(gl_account, "gl_account", "account_group")
    return (
        _regular_cost_lines(journal).join(acc, "gl_account")
        .groupBy("company_code", "fiscal_year", "fiscal_period", "cost_center", "account_group",
                 programme_key().alias("programme_key"))
        .agg(F.sum(signed("amount_group_currency")).alias("actual_amount"))
    )


def programme_budget_derive(journal: DataFrame, programme_master: DataFrame,
                            factor: str = config.PROGRAMME_BUDGET_FACTOR,
                            baseline: dict[str, int] | None = None) -> DataFrame:
    """PL4: total budget = mean monthly burn x duration in months x factor, in cents.

    ``baseline`` names the last period key (``YYYYPP``) that counts for a programme, so that an
    overrun after it does not raise the programme's own budget.
    """
    lines = journal.where((F.col("fiscal_period") <= 12) & F.col("programme_id").isNotNull())
    for programme, last in (baseline or {}).items():
        lines = lines.where((F.col("programme_id") != programme) | (period_key() <= F.lit(last)))
    monthly = lines.groupBy("programme_id", "fiscal_year", "fiscal_period").agg(
        F.sum(signed("amount_group_currency")).alias("period_cost"))
    per = monthly.groupBy("programme_id").agg(
        F.sum("period_cost").alias("__total"), F.count(F.lit(1)).alias("__n")
    )
    pm = dim(programme_master, "programme_id", "start_date", "end_date")
    months = (F.year("end_date") - F.year("start_date")) * 12 + F.month("end_date") - F.month("start_date") + 1
    hundredths = int(Decimal(factor) * 100)
    budget = div_half_up(cents("__total").cast("decimal(28,0)") * (months * hundredths).cast("decimal(9,0)"),
                         F.col("__n") * 100)
    return per.join(pm, "programme_id").select("programme_id", cents_to_decimal(budget).alias("total_budget_eur"))


def close_schedule(company: DataFrame, periods: DataFrame, calendar: DataFrame) -> DataFrame:
    """PL5, plan side: entity x covered period x task with its due date.

    due = n-th working day after period end (n = the task's target working day).
    """
    tasks = F.array(*[F.struct(F.lit(t[0]).alias("task_id"), F.lit(t[2]).alias("task_sequence"),
                               F.lit(t[3]).alias("target_working_day")) for t in config.CLOSE_TASKS])
    entity_no = F.regexp_extract(F.col("company_code"), r"(\d+)$", 1).cast("int")
    every = periods.agg(F.collect_list(F.struct("fiscal_year", "fiscal_period")).alias("p"))  # one row a month
    grid = (
        company.select("company_code", entity_no.alias("entity_no")).join(F.broadcast(every))
        .select("company_code", "entity_no", F.explode("p").alias("p"))
        .select("company_code", "entity_no", "p.*", F.explode(tasks).alias("t"))
        .select("company_code", "entity_no", "fiscal_year", "fiscal_period", "t.*")
        .withColumn("period_end_date", period_end_date())
    )
    return cal.nth_working_day(grid, "period_end_date", "target_working_day", calendar, "due_date")


def close_calendar(schedule: DataFrame, lines: DataFrame, calendar: DataFrame, as_of) -> DataFrame:
    """PL5: the schedule with completion dates read off the postings.

    A task is done on the first working day after the period's end by which its share of the
    period's lines has been entered: the task of sequence s waits for (88 + s) percent, so the
    last one for all lines.  Tasks not done by ``as_of`` (a one-row frame) are open.
    """
    entered = lines.where(F.col("fiscal_period") <= 12).groupBy(
        "company_code", "fiscal_year", "fiscal_period", "entry_date").agg(F.count(F.lit(1)).alias("n"))
    period = Window.partitionBy("company_code", "fiscal_year", "fiscal_period")
    upto = period.orderBy("entry_date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    entered = entered.withColumn("done", F.sum("n").over(upto)).withColumn("total", F.sum("n").over(period))
    sequences = F.explode(F.sequence(F.lit(1), F.lit(len(config.CLOSE_TASKS)))).alias("task_sequence")
    reached = entered.select("*", sequences).where(F.col("done") * 100 >= F.col("total") * (F.col("task_sequence") + 88))
    reached = reached.groupBy("company_code", "fiscal_year", "fiscal_period", "task_sequence").agg(
        F.min("entry_date").alias("__entered"))
    g = schedule.join(reached, ["company_code", "fiscal_year", "fiscal_period", "task_sequence"], "left")
    g = g.withColumn("__ready", F.greatest("__entered", F.date_add("period_end_date", 1)))
    g = g.withColumn("__ready", F.when(F.col("__entered").isNotNull(), F.col("__ready")))
    g = cal.next_working_day(g, "__ready", calendar, "__done")
    g = g.join(F.broadcast(as_of.select(F.col("as_of").alias("__as_of"))))
    g = g.withColumn("__done", F.when(F.col("__done") <= F.col("__as_of"), F.col("__done")))
    g = cal.working_days_between(g, "due_date", "__done", calendar, "delay_working_days")
    done = F.col("__done").isNotNull()
    return g.select(
        (((F.col("entity_no").cast("long") * 10000 + F.col("fiscal_year")) * 100
          + F.col("fiscal_period")) * 100 + F.col("task_sequence")).alias("close_task_id"),
        "company_code", "fiscal_year", "fiscal_period", "task_id",
        "period_end_date", "due_date", F.col("__done").alias("actual_completion_date"),
        F.when(done, F.format_string(
            "USR-%06X", (F.col("entity_no") + 1) * F.lit(1048576)
            + ((F.col("fiscal_period") * 12 + F.col("task_sequence")) * 7919) % 1048576))
        .alias("completed_by_user_id"),
        "delay_working_days",
    )


def budget_build(journal: DataFrame, gl_account: DataFrame, span: cal.FiscalSpan,
                 growth: str = config.BUDGET_GROWTH_RATE,
                 min_annual: int = config.BUDGET_MIN_ANNUAL_EUR) -> DataFrame:
    """PL2: annual budget = prior complete year's actual x growth.

    The first year anchors on itself (x 1.00); the open year never
    anchors.  Cells whose absolute budget is below ``min_annual`` are dropped.
    """
    annual = (
        plan_actuals(journal, gl_account)
        .groupBy("company_code", "fiscal_year", "cost_center", "account_group", "programme_key")
        .agg(F.sum("actual_amount").cast("decimal(24,2)").alias("actual_annual"))
    )
    self_anchor = annual.where(F.col("fiscal_year") == span.first_year).select(
        "company_code", "fiscal_year", "cost_center", "account_group", "programme_key",
        F.round(F.col("actual_annual") * F.lit(Decimal("1.00")), 2).alias("amount"),
    )
    prior = annual.where(
        (F.col("fiscal_year") >= span.first_year) & (F.col("fiscal_year") < span.open_year)
    ).select(
        "company_code", (F.col("fiscal_year") + 1).alias("fiscal_year"), "cost_center", "account_group",
        "programme_key", F.round(F.col("actual_annual") * F.lit(Decimal(growth)), 2).alias("amount"),
    )
    b = self_anchor.unionByName(prior).where(F.abs("amount") >= min_annual)
    return b.select(
        F.xxhash64("company_code", "fiscal_year", "cost_center", "account_group", "programme_key")
        .alias("budget_id"),
        "company_code", "fiscal_year", "cost_center", "account_group",
        F.when(F.col("programme_key") != config.NO_PROGRAMME, F.col("programme_key")).alias("programme_id"),
        F.lit(config.BUDGET_VERSION).alias("version"),
        F.col("amount").cast("decimal(28,2)").alias("amount_group_currency"),
    )


def forecast_build(journal: DataFrame, calendar: DataFrame, span: cal.FiscalSpan,
                   min_annual: int = config.FORECAST_MIN_ANNUAL_EUR) -> DataFrame:
    """PL3/JN12: quarterly rolling forecast snapshots at entity x cost centre x programme.

    Every combination whose annual total reaches ``min_annual`` is forecast for each later period
    of the year, once the snapshot's period has closed.  The base is the target period's actual
    where there is one, else the year's mean period.  What the snapshot could not know shows as
    an error that grows with the horizon h: the forecast lies h twelfths of the way from the base
    to the mean of the periods up to the snapshot (the year's mean, if there were none).
    Snapshot date = 5th working day after the snapshot period's end.
    """
    keys = ["company_code", "fiscal_year", "cost_center", "programme_key"]
    per = (
        _regular_cost_lines(journal)
        .groupBy("company_code", "fiscal_year", "fiscal_period", "cost_center",
                 programme_key().alias("programme_key"))
        .agg(cents(F.sum(signed("amount_group_currency"))).cast("decimal(28,0)").alias("c"))
    )
    aggs = [F.sum("c").alias("total"), F.count(F.lit(1)).alias("n")]
    for after in config.FORECAST_SNAPSHOT_AFTER_PERIOD.values():
        aggs.append(F.sum(F.when(F.col("fiscal_period") <= after, F.col("c")).otherwise(0)).alias(f"s{after}"))
        aggs.append(count_if(F.col("fiscal_period") <= after).alias(f"n{after}"))
    combos = per.groupBy(*keys).agg(*aggs).where(F.abs("total") >= F.lit(min_annual * 100)) \
        .withColumn("mean_c", div_half_up("total", "n"))
    versions = F.array(*[
        F.struct(F.lit(v).alias("version"), F.lit(a).alias("after"),
                 F.when(F.col(f"n{a}") > 0, div_half_up(f"s{a}", F.greatest(F.col(f"n{a}"), F.lit(1))))
                 .otherwise(F.col("mean_c")).alias("pull_c"))
        for v, a in config.FORECAST_SNAPSHOT_AFTER_PERIOD.items()
    ])
    last_closed = F.when(F.col("fiscal_year") == span.open_year, F.lit(span.last_closed)).otherwise(F.lit(12))
    snaps = (
        combos.select(*keys, "mean_c", F.explode(versions).alias("v")).select(*keys, "mean_c", "v.*")
        .where(F.col("after") <= last_closed)
        .withColumn("__snap_end", period_end_date("fiscal_year", "after"))
    )
    snaps = cal.nth_working_day(snaps, "__snap_end", config.FORECAST_SNAPSHOT_WORKING_DAY, calendar,
                                "snapshot_date")
    rows = snaps.select("*", F.explode(F.sequence(F.col("after") + 1, F.lit(12))).alias("fiscal_period"))
    rows = rows.join(per, [*keys, "fiscal_period"], "left")
    wide = "decimal(24,0)"
    base, h = F.coalesce("c", "mean_c").cast(wide), F.col("fiscal_period") - F.col("after")
    amount = div_half_up(base * 12 + (F.col("pull_c").cast(wide) - base) * h, F.lit(12))
    return rows.select(
        F.xxhash64("company_code", "fiscal_year", "cost_center", "programme_key", "version",
                   "fiscal_period").alias("forecast_id"),
        "company_code", "cost_center",
        F.when(F.col("programme_key") != config.NO_PROGRAMME, F.col("programme_key")).alias("programme_id"),
        "fiscal_year", "fiscal_period", "version", "snapshot_date",
        h.cast("int").alias("horizon_periods"), cents_to_decimal(amount).alias("amount_group_currency"),
    )


def plan_combos(actuals: DataFrame, keys: list[str], value_col: str, threshold) -> DataFrame:
    """PL6: keep rows of combinations whose absolute annual total reaches ``threshold``."""
    big = actuals.groupBy(*keys).agg(F.sum(value_col).alias("__tot")).where(F.abs("__tot") >= threshold)
    return actuals.join(big.select(*keys), keys, "left_semi")


def plan_spread(df: DataFrame, value_col: str, weights: list[float] | None = None,
                out: str = "amount_period") -> DataFrame:
    """PL7: distribute an annual value over 12 periods, equally or by weights (sum to 1)."""
    if weights is None:
        return df.select("*", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("fiscal_period")) \
            .withColumn(out, F.col(value_col) / F.lit(12))
    if len(weights) != 12:
        raise ValueError("weights must have 12 entries")
    arr = F.array(*[F.struct(F.lit(i + 1).alias("p"), F.lit(float(w)).alias("w")) for i, w in enumerate(weights)])
    return df.select("*", F.explode(arr).alias("__pw")).withColumn("fiscal_period", F.col("__pw.p")) \
        .withColumn(out, F.col(value_col).cast("double") * F.col("__pw.w")).drop("__pw")


def plan_copy_actual(actuals: DataFrame, closed_through_key: int, version: str = "FORECAST") -> DataFrame:
    """PL8: copy closed-period actuals into a plan version."""
    return actuals.where(period_key() <= F.lit(closed_through_key)).withColumn("version", F.lit(version))


def plan_uplift(df: DataFrame, version: str, programme_id: str, pct: float,
                value_col: str = "amount_group_currency") -> DataFrame:
    """PL9: data action raising one version of one programme by ``pct`` percent."""
    hit = (F.col("version") == version) & (F.col("programme_id") == programme_id)
    return df.withColumn(
        value_col,
        F.when(hit, F.round(F.col(value_col) * F.lit(Decimal(str(1 + pct / 100))), 2)
               .cast(df.schema[value_col].dataType)).otherwise(F.col(value_col)),
    )
