"""Hand-checkable calendar cases (Easter, holidays, period ends, working-day arithmetic)."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerflow.functions.columns import easter_sunday, period_end_date
from ledgerflow.operators import calendar as cal

D = dt.date


@pytest.mark.parametrize("year,expected", [
    (2023, D(2023, 4, 9)), (2024, D(2024, 3, 31)), (2025, D(2025, 4, 20)),
    (2026, D(2026, 4, 5)), (2027, D(2027, 3, 28)),
])
def test_easter(spark, year, expected):
    row = spark.createDataFrame([(year,)], "y int").select(easter_sunday("y").alias("e")).first()
    assert row.e == expected


def test_holidays_2025_include_good_friday_and_easter_monday(spark):
    days = {r.holiday_date for r in cal.holidays(cal.year_range(spark, 2025, 2025)).collect()}
    assert D(2025, 4, 18) in days and D(2025, 4, 21) in days
    assert {D(2025, 1, 1), D(2025, 5, 1), D(2025, 12, 25), D(2025, 12, 26)} <= days
    assert len(days) == 6


@pytest.mark.parametrize("fy,fp,expected", [
    (2024, 2, D(2024, 2, 29)), (2023, 2, D(2023, 2, 28)), (2025, 12, D(2025, 12, 31)),
    (2025, 13, D(2025, 12, 31)), (2025, 14, D(2025, 12, 31)),
])
def test_period_end(spark, fy, fp, expected):
    row = spark.createDataFrame([(fy, fp)], "fiscal_year int, fiscal_period int").select(
        period_end_date().alias("pe")).first()
    assert row.pe == expected


@pytest.fixture(scope="module")
def cal2025(spark):
    return cal.dim_date(cal.year_range(spark, 2025, 2025))


@pytest.mark.parametrize("ref,n,expected", [
    (D(2025, 1, 31), 1, D(2025, 2, 3)), (D(2025, 1, 31), 2, D(2025, 2, 4)),
    (D(2025, 1, 31), 5, D(2025, 2, 7)), (D(2025, 4, 30), 1, D(2025, 5, 2)),
])
def test_nth_working_day(spark, cal2025, ref, n, expected):
    df = spark.createDataFrame([(ref,)], "ref date")
    assert cal.nth_working_day(df, "ref", n, cal2025).first().nth_working_day == expected


def test_nth_working_day_rejects_n_below_one(spark, cal2025):
    df = spark.createDataFrame([(D(2025, 1, 31),)], "ref date")
    assert cal.nth_working_day(df, "ref", 0, cal2025).first().nth_working_day is None


def test_working_days_between_is_inverse_of_nth(spark, cal2025):
    df = spark.createDataFrame([(D(2025, 1, 31), D(2025, 1, 31)), (D(2025, 1, 31), D(2025, 2, 7)),
                                (D(2025, 4, 30), D(2025, 5, 2))], "a date, b date")
    got = [r.working_days for r in cal.working_days_between(df, "a", "b", cal2025).orderBy("b").collect()]
    assert got == [0, 5, 1]


def test_calendar_counters(spark, cal2025):
    c = {r.date_id: r for r in cal2025.collect()}
    assert c[D(2025, 1, 1)].is_working_day is False           # New Year
    assert c[D(2025, 1, 4)].is_weekend and c[D(2025, 1, 4)].working_day_of_period == 0
    assert c[D(2025, 1, 2)].working_day_of_period == 1
    assert c[D(2025, 1, 6)].day_of_week == 1 and c[D(2025, 1, 6)].day_name == "Monday"
    assert c[D(2025, 12, 31)].working_day_seq == sum(1 for r in c.values() if r.is_working_day)


def test_covered_periods_stop_at_last_closed(spark):
    def last(*days):
        df = spark.createDataFrame([(d,) for d in days], "d date")
        return [(r.fiscal_year, r.fiscal_period) for r in cal.covered_periods(df, "d").orderBy("fiscal_year", "fiscal_period").collect()]

    assert last(D(2024, 11, 20), D(2025, 2, 10)) == [(2024, 11), (2024, 12), (2025, 1)]
    assert last(D(2025, 1, 5), D(2025, 2, 28)) == [(2025, 1), (2025, 2)]  # the month is over
    assert last(D(2025, 1, 5)) == [] and last() == []


def test_calendar_covers_the_years_of_the_postings_and_one_more(spark):
    df = spark.createDataFrame([(D(2010, 5, 1),), (D(2012, 1, 1),)], "d date")
    assert [r.year for r in cal.calendar_years(df, "d").orderBy("year").collect()] == [2010, 2011, 2012, 2013]
