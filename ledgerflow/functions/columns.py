"""Column expressions shared by the operators.

All of these are built-in Spark expressions (no Python UDFs), so they stay
inside whole-stage code generation.

Scalar-function inventory (SURVEY 2.8) and where it lives:
SF1 CASE sign flip / flags / bands -> ``signed``, ``criticality``; SF2 LEAST(fp,12)
-> ``reporting_period``; SF3 GREATEST(0, ...) -> run-rate ``remaining_periods``;
SF4 COALESCE across an outer join -> ``kpis.budget_variance``; SF5 NULLIF-guarded
division -> ``ratio`` (``try_divide``); SF6 ABS -> ``exact_ratio`` / late value;
SF7 decimal cast and half-up rounding -> ``money``, ``div_half_up``; SF8 YEAR/MONTH
-> run-rate and programme budget; SF9 whole-month MONTHS_BETWEEN ->
``kpis.programme_burn``; SF10 ``YYYY-PP`` label -> ``period_label``; SF11 unordered
pair key -> ``pair_key``; SF12 period end -> ``period_end_date``; SF13 period date
-> ``period_start_date``; SF14 Easter -> ``easter_sunday``; SF15 calendar parts ->
``operators.calendar.dim_date``; SF16 token regex -> ``quality.journal_row_rules``;
SF17 period key -> ``period_key``; SF18 fixed-scale division -> ``exact_ratio``;
SF19 date comparison -> ``ledger.late_posting_flag``; SF20 separator replace ->
``kpis.ic_open_items``.  Shapes PF3 (regular periods), PF4 (cost lines), PF5
(as-of cut), PF6 (IN list: ``is_manual``) and PF7 (NULL sentinel:
``programme_key``) are used by the KPI operators.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config


def c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def signed(amount, debit_credit="debit_credit_ind") -> Column:
    """Expenses positive, revenue negative: ``S`` keeps the sign, anything else flips it."""
    return F.when(c(debit_credit) == F.lit("S"), c(amount)).otherwise(-c(amount))


def reporting_period(fiscal_period="fiscal_period") -> Column:
    """Special periods 13-16 report in period 12."""
    return F.least(c(fiscal_period), F.lit(12))


def period_key(fiscal_year="fiscal_year", fiscal_period="fiscal_period") -> Column:
    return c(fiscal_year) * F.lit(100) + c(fiscal_period)


def period_start_date(fiscal_year="fiscal_year", fiscal_period="fiscal_period") -> Column:
    """First day of the (clamped) month."""
    return F.make_date(c(fiscal_year), reporting_period(fiscal_period), F.lit(1))


def period_end_date(fiscal_year="fiscal_year", fiscal_period="fiscal_period") -> Column:
    """Last calendar day of a fiscal period; 31 December for special periods."""
    return F.last_day(period_start_date(fiscal_year, fiscal_period))


def period_label(fiscal_year="fiscal_year", fiscal_period="fiscal_period") -> Column:
    """``YYYY-PP`` label."""
    return F.format_string("%d-%02d", c(fiscal_year), c(fiscal_period))


def pair_key(a, b) -> Column:
    """Unordered pair key ``min|max``."""
    return F.concat_ws("|", F.least(c(a), c(b)), F.greatest(c(a), c(b)))


def is_manual(document_type="document_type") -> Column:
    return c(document_type).isin(config.MANUAL_DOCUMENT_TYPES)


def programme_key(programme_id="programme_id") -> Column:
    return F.coalesce(c(programme_id), F.lit(config.NO_PROGRAMME))


def ratio(numerator, denominator) -> Column:
    """Double ratio, NULL when the denominator is zero or NULL (ANSI-safe)."""
    return F.try_divide(c(numerator).cast("double"), c(denominator).cast("double"))


def money(x) -> Column:
    """Round a decimal amount to cents while still decimal, then publish as double."""
    return F.round(c(x), 2).cast("double")


def count_if(cond) -> Column:
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast("long")


def intdiv(a, b) -> Column:
    """Integral division truncating toward zero; operands up to 38 digits, quotient a ``long``."""
    wide = "decimal(38,0)"
    return F.call_function("div", c(a).cast(wide), c(b).cast(wide))


def div_half_up(numerator, denominator) -> Column:
    """Integer division rounded half away from zero, exact up to 37 digits (positive denominator)."""
    n = c(numerator).cast("decimal(37,0)")
    d = c(denominator).cast("decimal(37,0)")
    return F.when(n >= 0, intdiv(n * 2 + d, d * 2)).otherwise(-intdiv(-n * 2 + d, d * 2))


def cents(x) -> Column:
    """Exact decimal amount -> whole cents (38 digits)."""
    return (c(x).cast("decimal(36,2)") * F.lit(100)).cast("decimal(38,0)")


#: Digits behind the point that amounts keep between operators (cents are for publishing).
WIDE_SCALE = 8


def wide(x) -> Column:
    """Amount with WIDE_SCALE digits, so that sums and differences lose none."""
    return c(x).cast("decimal(30,8)")


def wide_div(amount, divisor) -> Column:
    """Amount / positive integer to WIDE_SCALE digits, for shares that are rounded later."""
    return F.round(c(amount).cast("decimal(30,8)") / c(divisor).cast("decimal(8,0)"), WIDE_SCALE).cast("decimal(30,8)")


def easter_sunday(year) -> Column:
    """Easter Sunday of a Gregorian year as a date column (Gauss's rule with its two exceptions).

    The Paschal full moon falls ``moon`` days after 21 March; Easter is the next Sunday.
    """
    y = c(year).cast("int")

    def part(x, n):
        return F.floor(x / F.lit(n)).cast("int")

    century, golden = part(y, 100), y % 19
    epact_shift = (century - part(century, 4) - part(century * 8 + 13, 25) + 15) % 30
    moon = (golden * 19 + epact_shift) % 30
    moon = moon - F.when((moon == 29) | ((moon == 28) & (golden > 10)), F.lit(1)).otherwise(F.lit(0))
    full_moon = F.date_add(F.make_date(y, F.lit(3), F.lit(21)), moon)
    return F.date_add(full_moon, F.lit(7) - (F.weekday(full_moon) + 1) % 7)


def criticality(value, high, warn, null_value: int = 0) -> Column:
    """Traffic-light code: NULL -> ``null_value``, > high -> 1, > warn -> 2, else 3."""
    v = c(value)
    return (
        F.when(v.isNull(), F.lit(null_value))
        .when(v > F.lit(high), F.lit(1))
        .when(v > F.lit(warn), F.lit(2))
        .otherwise(F.lit(3))
    )


def cents_to_decimal(cents_col) -> Column:
    """Whole cents -> exact DECIMAL(28,2)."""
    from decimal import Decimal

    return (c(cents_col).cast("decimal(30,0)") * F.lit(Decimal("0.01"))).cast("decimal(28,2)")


def decimal_div_cents(amount, divisor) -> Column:
    """Exact decimal amount / positive integer, rounded half away from zero to cents."""
    return cents_to_decimal(div_half_up(cents(amount), c(divisor)))


def exact_ratio(numerator, denominator, dp: int = 4) -> Column:
    """num / |den| of two amounts of up to WIDE_SCALE digits, rounded half away from zero to
    ``dp`` decimals, returned as double; NULL when the denominator is zero or NULL."""
    def units(x):
        return (c(x).cast("decimal(30,8)") * F.lit(10 ** WIDE_SCALE)).cast("decimal(34,0)")

    scale = 10 ** dp
    den = F.abs(units(denominator))
    # the division is guarded as well: ANSI mode evaluates it for zero denominators otherwise
    q = div_half_up(units(numerator).cast("decimal(32,0)") * F.lit(scale), F.when(den != 0, den))
    return F.when(den != 0, q.cast("double") / F.lit(float(scale)))
