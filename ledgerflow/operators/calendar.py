"""Working-day calendar operators (CA1-CA8, WN1, WN3, WN6, WN7).

The calendar is a bounded table: one row per day of the years with postings, so it is
broadcast into every join that needs it and the running working-day counter
(an unpartitioned window) only ever runs over these few thousand rows, never
over a fact table.  Working-day distance becomes one subtraction of two
counters, and "n-th working day after" an equi-join on the counter.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import config
from ..functions.columns import easter_sunday, period_end_date


def calendar_years(postings: DataFrame, date_col: str) -> DataFrame:
    """The calendar years that postings fall in, and the one after (late completions), as ``year``."""
    span = postings.agg(F.year(F.min(date_col)).alias("lo"), F.year(F.max(date_col)).alias("hi"))
    return span.select(F.explode(F.sequence("lo", F.col("hi") + 1)).alias("year"))


def year_range(spark: SparkSession, first_year: int, last_year: int) -> DataFrame:
    return spark.range(first_year, last_year + 1).select(F.col("id").cast("int").alias("year"))


def holidays(years: DataFrame) -> DataFrame:
    """CA1: fixed holidays plus Easter-relative ones for every ``year``."""
    fixed_days = F.array(*[F.struct(F.lit(m).alias("m"), F.lit(d).alias("d")) for m, d in config.FIXED_HOLIDAYS])
    fixed = years.select("year", F.explode(fixed_days).alias("md")).select(
        F.make_date("year", "md.m", "md.d").alias("holiday_date"))
    offsets = F.array(*[F.lit(o) for o in config.EASTER_HOLIDAY_OFFSETS])
    easter = years.select(easter_sunday("year").alias("easter"), F.explode(offsets).alias("offset")).select(
        F.date_add("easter", F.col("offset")).alias("holiday_date"))
    return fixed.unionByName(easter).distinct()


def dim_date(years: DataFrame) -> DataFrame:
    """CA2 + WN1 + WN3: daily calendar of the given ``year`` rows with fiscal attributes and
    working-day counters.

    ``working_day_seq`` counts working days from the start of the window up to
    and including the day, so ``seq(to) - seq(from)`` is the number of working
    days in the half-open interval (from, to].
    """
    hol = holidays(years).withColumn("is_holiday", F.lit(True))
    days = years.select(F.explode(F.sequence(
        F.make_date("year", F.lit(1), F.lit(1)), F.make_date("year", F.lit(12), F.lit(31)))).alias("date_id"))
    d = (
        days.join(hol, F.col("date_id") == F.col("holiday_date"), "left")
        .select(
            "date_id",
            F.year("date_id").alias("calendar_year"),
            F.quarter("date_id").alias("calendar_quarter"),
            F.month("date_id").alias("calendar_month"),
            F.dayofmonth("date_id").alias("day_of_month"),
            (F.weekday("date_id") + 1).alias("day_of_week"),
            F.date_format("date_id", "EEEE").alias("day_name"),
            (F.weekday("date_id") >= 5).alias("is_weekend"),
            ((F.weekday("date_id") < 5) & F.col("is_holiday").isNull()).alias("is_working_day"),
        )
        .withColumn("fiscal_year", F.col("calendar_year"))
        .withColumn("fiscal_period", F.col("calendar_month"))
        .withColumn("period_end_date", period_end_date())
    )
    wd = F.when(F.col("is_working_day"), F.lit(1)).otherwise(F.lit(0))
    # Bounded window: one row a day of the years that hold postings.
    running = Window.orderBy("date_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    in_period = (
        Window.partitionBy("fiscal_year", "fiscal_period")
        .orderBy("date_id")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        d.withColumn("working_days_after_period_end", F.sum(wd).over(in_period).cast("int"))
        .withColumn(
            "working_day_of_period",
            F.when(F.col("is_working_day"), F.col("working_days_after_period_end")).otherwise(0),
        )
        .withColumn("working_day_seq", F.sum(wd).over(running).cast("int"))
    )


def working_day_index(calendar: DataFrame) -> DataFrame:
    """Working days only, keyed by their running sequence number (unique)."""
    return calendar.where("is_working_day").select(
        F.col("date_id").alias("working_date"), F.col("working_day_seq").alias("wd_seq")
    )


def with_working_day_seq(df: DataFrame, date_col: str, calendar: DataFrame, out: str) -> DataFrame:
    """Attach ``working_day_seq`` of ``date_col`` (left join; NULL outside the window)."""
    cal = F.broadcast(calendar.select(F.col("date_id").alias(f"__d_{out}"),
                                      F.col("working_day_seq").alias(out)))
    return df.join(cal, F.col(date_col) == F.col(f"__d_{out}"), "left").drop(f"__d_{out}")


def working_days_between(df: DataFrame, from_col: str, to_col: str, calendar: DataFrame,
                         out: str = "working_days") -> DataFrame:
    """CA3: working days in the half-open interval (from, to]; same day -> 0."""
    x = with_working_day_seq(df, from_col, calendar, "__seq_from")
    x = with_working_day_seq(x, to_col, calendar, "__seq_to")
    return x.withColumn(out, (F.col("__seq_to") - F.col("__seq_from")).cast("int")).drop(
        "__seq_from", "__seq_to"
    )


def nth_working_day(df: DataFrame, ref_col: str, n, calendar: DataFrame,
                    out: str = "nth_working_day") -> DataFrame:
    """CA4/WN6: the n-th working day strictly after ``ref_col`` (n >= 1).

    ``n`` is a column name or an int.  Rows with n < 1 get NULL, as do rows whose
    answer falls outside the calendar window.
    """
    n_col = F.col(n) if isinstance(n, str) else F.lit(int(n))
    x = with_working_day_seq(df, ref_col, calendar, "__ref_seq")
    x = x.withColumn("__target_seq", F.when(n_col >= 1, F.col("__ref_seq") + n_col))
    idx = F.broadcast(working_day_index(calendar))
    return (
        x.join(idx, F.col("__target_seq") == idx.wd_seq, "left")
        .withColumnRenamed("working_date", out)
        .drop("__ref_seq", "__target_seq", "wd_seq")
    )


def next_working_day(df: DataFrame, date_col: str, calendar: DataFrame,
                     out: str = "next_working_day") -> DataFrame:
    """CA7: first working day on or after ``date_col`` = 1st working day after the previous day."""
    x = df.withColumn("__prev_day", F.date_sub(F.col(date_col), 1))
    return nth_working_day(x, "__prev_day", 1, calendar, out).drop("__prev_day")


def working_days_in_period(calendar: DataFrame) -> DataFrame:
    """CA5: working days per fiscal period."""
    return calendar.groupBy("fiscal_year", "fiscal_period").agg(
        F.sum(F.col("is_working_day").cast("int")).cast("long").alias("working_days")
    )


def covered_periods(postings: DataFrame, date_col: str) -> DataFrame:
    """CA6: the closed regular periods: every month from the first posting's to the last one that
    is over by the last posting's date."""
    span = postings.agg(F.trunc(F.min(date_col), "month").alias("lo"),
                        F.add_months(F.trunc(F.date_add(F.max(date_col), 1), "month"), -1).alias("hi"))
    months = span.where("lo <= hi").select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 MONTH"))).alias("m"))
    return months.select(F.year("m").alias("fiscal_year"), F.month("m").alias("fiscal_period"))


@dataclass(frozen=True)
class FiscalSpan:
    """First fiscal year, the year that is still open, its last closed period, and the last closed period's key."""

    first_year: int
    open_year: int
    last_closed: int
    last_key: int


def fiscal_span(periods: DataFrame) -> FiscalSpan:
    """Read off the covered periods (one row to the driver); without any, a span that holds no year."""
    row = periods.agg(F.min("fiscal_year").alias("lo"), F.max(F.col("fiscal_year") * 100 + F.col("fiscal_period")).alias("hi")).first()
    if row["hi"] is None:
        return FiscalSpan(0, 0, 0, 0)
    year, period = divmod(row["hi"], 100)
    return FiscalSpan(row["lo"], year + 1 if period == 12 else year, 0 if period == 12 else period, row["hi"])


def next_period_map(periods: DataFrame) -> DataFrame:
    """WN7: each covered period mapped to the next covered one (the last has none).

    ``periods`` is the bounded covered-period list, so an ordered window is fine.
    """
    w = Window.orderBy("fiscal_year", "fiscal_period")
    return periods.select(
        "fiscal_year",
        "fiscal_period",
        F.lead("fiscal_year").over(w).alias("next_fiscal_year"),
        F.lead("fiscal_period").over(w).alias("next_fiscal_period"),
    )


def first_working_day_of_period(calendar: DataFrame) -> DataFrame:
    """First working day of every calendar month in the window."""
    return calendar.where("is_working_day").groupBy("fiscal_year", "fiscal_period").agg(
        F.min("date_id").alias("first_working_day")
    )


def add_working_day_seq(calendar: DataFrame) -> DataFrame:
    """L2 calendar view: add the running working-day counter if a stored calendar lacks it."""
    if "working_day_seq" in calendar.columns:
        return calendar
    wd = F.when(F.col("is_working_day"), F.lit(1)).otherwise(F.lit(0))
    running = Window.orderBy("date_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return calendar.withColumn("working_day_seq", F.sum(wd).over(running).cast("int"))
