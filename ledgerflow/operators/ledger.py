"""Ledger harmonisation operators (LG1-LG9, FX1-FX5, JN1-JN4).

``harmonised_journal`` is the one wide journal every KPI reads: signed amounts,
manual and late flags, re-translation at the actual and the frozen budget
rate, master-data attributes and the unordered intercompany pair key.  All
lookups are broadcast hash joins against bounded master data, so the journal
itself is scanned once and never shuffled here; the first shuffle is the
KPI's own aggregation (with map-side partial aggregation, so a hot entity or
period only costs one partial row per task).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config
from ..functions.columns import (
    cents, cents_to_decimal, div_half_up, is_manual, pair_key, reporting_period, signed,
)
from ..functions.hints import bounded, dim, in_one_place, no_larger, to_one
from . import calendar as cal
from .ordering import heavy_keys, number_rows


def fx_rate_pair(rates: DataFrame) -> DataFrame:
    """FX1/AG3: actual (M) and budget (B) rate side by side, one row per pair and period."""
    return rates.groupBy("from_currency", "to_currency", "fiscal_year", "fiscal_period").agg(
        F.max(F.when(F.col("rate_type") == "M", F.col("exchange_rate"))).alias("rate_actual"),
        F.max(F.when(F.col("rate_type") == "B", F.col("exchange_rate"))).alias("rate_budget"),
    )


def rate_lookup(df: DataFrame, rates: DataFrame, currency_col: str, rate_type: str = "M",
                out: str = "rate", year_col: str = "fiscal_year",
                period_col: str = "fiscal_period") -> DataFrame:
    """FX2: rate for currency / FY / period / type; special periods use period 12."""
    r = dim(rates.where(F.col("rate_type") == rate_type)).select(
        F.col("from_currency").alias("__rl_ccy"), F.col("fiscal_year").alias("__rl_fy"),
        F.col("fiscal_period").alias("__rl_fp"), F.col("exchange_rate").alias(out),
    )
    return df.join(
        r,
        (F.col(currency_col) == F.col("__rl_ccy"))
        & (F.col(year_col) == F.col("__rl_fy"))
        & (reporting_period(period_col) == F.col("__rl_fp")),
        "left",
    ).drop("__rl_ccy", "__rl_fy", "__rl_fp")


def translate_amounts(df: DataFrame, rates: DataFrame, eur_col: str, doc_ccy_col: str,
                      local_ccy_col: str) -> DataFrame:
    """FX4: EUR -> document -> local -> group currency, rounded to cents at every hop.

    doc = round(eur / r_doc, 2); local = round(doc * r_doc / r_local, 2);
    group = round(local * r_local, 2).  Divisions are done exactly in integer
    cents and micro-units of the rate, rounded half away from zero.
    """
    x = rate_lookup(df, rates, doc_ccy_col, out="__r_doc")
    x = rate_lookup(x, rates, local_ccy_col, out="__r_local")
    micro = lambda r: (F.col(r) * F.lit(1000000)).cast("decimal(20,0)")
    whole = "decimal(26,0)"
    doc_cents = div_half_up(cents(eur_col).cast(whole) * F.lit(1000000), micro("__r_doc"))
    local_cents = div_half_up(doc_cents.cast("decimal(18,0)") * micro("__r_doc"), micro("__r_local"))
    return (
        x.withColumn("amount_doc_currency", cents_to_decimal(doc_cents))
        .withColumn("amount_local_currency", cents_to_decimal(local_cents))
        .withColumn("amount_group_currency",
                    F.round(F.col("amount_local_currency") * F.col("__r_local"), 2).cast("decimal(28,2)"))
        .drop("__r_doc", "__r_local")
    )


def flip(dc="debit_credit_ind"):
    return F.when(F.col(dc) == "S", F.lit("H")).otherwise(F.lit("S"))


JOURNAL_FIELDS = [
    "company_code", "document_number", "document_line", "document_type",
    "posting_date", "document_date", "entry_date", "fiscal_year", "fiscal_period",
    "gl_account", "cost_center", "programme_id", "debit_credit_ind",
    "amount_doc_currency", "doc_currency", "amount_local_currency", "local_currency",
    "amount_group_currency", "group_currency", "is_intercompany", "ic_partner_company",
    "posting_user_id", "is_reversal", "reversed_document",
]


def prepare_derivations(lines: DataFrame, rates: DataFrame, company: DataFrame, calendar) -> DataFrame:
    """Attach what the derived postings need, by broadcast lookups only (no shuffle):
    the partner's currency and its actual rate in the receipt period (LG8) and the
    first working day of the next period (LG7)."""
    partner = dim(company, F.col("company_code").alias("__p_code"), F.col("local_currency").alias("__p_ccy"))
    x = lines.join(partner, F.col("ic_partner_company") == F.col("__p_code"), "left")
    receipt = F.col("receipt_date") if "receipt_date" in lines.columns else F.col("posting_date")
    x = x.withColumn("__m_date", receipt).withColumn("__m_fy", F.year("__m_date")) \
        .withColumn("__m_fp", F.month("__m_date"))
    x = rate_lookup(x, rates, "__p_ccy", out="__p_rate", year_col="__m_fy", period_col="__m_fp")
    x = x.withColumn("__n_fy", F.col("fiscal_year") + F.when(F.col("fiscal_period") == 12, 1).otherwise(0)) \
        .withColumn("__n_fp", F.col("fiscal_period") % 12 + 1)
    first = dim(cal.first_working_day_of_period(calendar)).select(
        F.col("fiscal_year").alias("__f_fy"), F.col("fiscal_period").alias("__f_fp"), "first_working_day")
    return x.join(first, (F.col("__n_fy") == F.col("__f_fy")) & (F.col("__n_fp") == F.col("__f_fp")), "left")


def _fields(changed: dict) -> list:
    """The journal's columns, those of ``changed`` in its place."""
    return [changed.get(c, F.col(c)).alias(c) for c in JOURNAL_FIELDS]


def mirror_condition() -> F.Column:
    return F.col("is_intercompany") & F.col("__p_code").isNotNull()


def mirror_fields() -> dict:
    """LG8: the columns of the partner-side line of an intercompany posting that differ from the original's.

    The partner books the mirror document on receipt (``receipt_date`` when the
    lines carry one, else the original posting date), with entity and partner
    swapped, no cost centre or programme, the opposite side, and the original
    group amount translated into the partner's local currency at the partner's
    rate of its own period (exact cents).  Month-end timing and rate differences
    are what the reconciliation later surfaces.
    """
    micro = (F.col("__p_rate") * F.lit(1000000)).cast("decimal(20,0)")
    local_cents = div_half_up(cents("amount_group_currency").cast("decimal(26,0)") * F.lit(1000000), micro)
    local = cents_to_decimal(local_cents).cast("decimal(15,2)")
    return {
        "company_code": F.col("ic_partner_company"),
        "document_number": F.concat(F.lit("M"), F.col("document_number")),
        "document_type": F.lit("IC"),
        "posting_date": F.col("__m_date"),
        "entry_date": F.col("__m_date"),
        "fiscal_year": F.col("__m_fy"),
        "fiscal_period": F.col("__m_fp"),
        "cost_center": F.lit(None).cast("string"),
        "programme_id": F.lit(None).cast("string"),
        "debit_credit_ind": flip(),
        "amount_local_currency": local,
        "local_currency": F.col("__p_ccy"),
        "amount_group_currency": F.round(local * F.col("__p_rate"), 2).cast("decimal(15,2)"),
        "is_intercompany": F.lit(True),
        "ic_partner_company": F.col("company_code"),
        "posting_user_id": F.format_string("USR-%06X", (F.col("partner_region") + 1) * F.lit(1048576)
                                           + (F.col("document_line") * 7919) % 1048576),
        "is_reversal": F.lit(False),
        "reversed_document": F.lit(None).cast("string"),
    }


def reversal_condition(last_covered: int) -> F.Column:
    return ((F.col("document_type") == "SB") & (F.col("fiscal_period") <= 12)
            & (F.col("__n_fy") * 100 + F.col("__n_fp") <= F.lit(last_covered))
            & F.col("first_working_day").isNotNull())


def reversal_fields() -> dict:
    """LG7: the columns of the next-period reversal of an accrual (SB) line that differ from the original's.

    The reversal flips the side, carries all three amounts unchanged (so its
    group amount reflects the original period's rate), gets a new document
    number and posts on the first working day of the target period.  Lines of
    the final covered period have no next period and are not reversed.
    """
    return {
        "document_number": F.concat(F.lit("R"), F.col("document_number")),
        "posting_date": F.col("first_working_day"),
        "document_date": F.col("first_working_day"),
        "entry_date": F.col("first_working_day"),
        "fiscal_year": F.col("__n_fy"),
        "fiscal_period": F.col("__n_fp"),
        "debit_credit_ind": flip(),
        "is_reversal": F.lit(True),
        "reversed_document": F.col("document_number"),
    }


def intercompany_mirrors(lines: DataFrame, rates: DataFrame, company: DataFrame, calendar) -> DataFrame:
    """LG8: the partner-side mirror lines on their own (see ``mirror_fields``)."""
    x = prepare_derivations(lines.where("is_intercompany"), rates, company, calendar)
    return x.where(mirror_condition()).select(*_fields(mirror_fields()))


def accrual_reversals(lines: DataFrame, rates: DataFrame, company: DataFrame, calendar,
                      last_covered: int) -> DataFrame:
    """LG7: the next-period reversals on their own (see ``reversal_fields``)."""
    x = prepare_derivations(lines.where(F.col("document_type") == "SB"), rates, company, calendar)
    return x.where(reversal_condition(last_covered)).select(*_fields(reversal_fields()))


def journal_with_derived(lines: DataFrame, rates: DataFrame, company: DataFrame, calendar,
                         last_covered: int) -> DataFrame:
    """ST3: originals + mirrors + reversals in ONE pass over the original lines.

    Each original line is repeated once for each of its kinds (0 the original, 1 its mirror, 2 its reversal), so the
    (expensive) derivation of the original lines is computed once instead of once per union branch.  The kinds are
    exploded and the columns chosen afterwards, which keeps the pass in generated code; a column has a case for the kinds
    that change it alone, for the JVM compiles no method of over 8000 bytes.
    ``journal_id`` names the line by its natural key, document number and line: a mirror's or a
    reversal's document number carries its own prefix, so the key is unique without packed digits.
    """
    x = prepare_derivations(lines, rates, company, calendar)
    mirrored, reversed_ = mirror_condition(), reversal_condition(last_covered)
    kinds = (F.when(mirrored & reversed_, F.array(F.lit(0), F.lit(1), F.lit(2)))
             .when(mirrored, F.array(F.lit(0), F.lit(1))).when(reversed_, F.array(F.lit(0), F.lit(2))).otherwise(F.array(F.lit(0))))
    kind, mirror, reversal = F.col("__kind"), mirror_fields(), reversal_fields()
    fields = {c: F.when(kind == 2, e).otherwise(F.col(c)) for c, e in reversal.items()}
    fields |= {c: F.when(kind == 1, e).otherwise(fields.get(c, F.col(c))) for c, e in mirror.items()}
    out = x.withColumn("__kind", F.explode(kinds)).select(*_fields(fields))
    return with_journal_id(out)


def with_journal_id(journal: DataFrame) -> DataFrame:
    """The journal's columns with the key of each line in front."""
    return journal.select(F.concat_ws("/", "document_number", "document_line").alias("journal_id"), *JOURNAL_FIELDS)


def late_posting_flag(entry_date="entry_date", due_date="due_date", fiscal_period="fiscal_period"):
    """LG3: regular period and entered after the soft-close due date; no due date -> false."""
    return F.coalesce(
        (F.col(fiscal_period) <= 12) & (F.col(entry_date) > F.col(due_date)), F.lit(False)
    )


def soft_close_due(close_tasks: DataFrame) -> DataFrame:
    """Due date of the soft-close task per entity and period (JN4)."""
    return no_larger(close_tasks.where(F.col("task_id") == config.SOFT_CLOSE_TASK).select(
        F.col("company_code").alias("__sc_co"), F.col("fiscal_year").alias("__sc_fy"),
        F.col("fiscal_period").alias("__sc_fp"), "due_date",
    ), close_tasks)


def harmonised_journal(journal: DataFrame, company: DataFrame, gl_account: DataFrame,
                       cost_center: DataFrame, programme: DataFrame, rates: DataFrame,
                       close_tasks: DataFrame) -> DataFrame:
    """LG5: the harmonised journal (inner joins to entity and account; left joins otherwise)."""
    j = journal.withColumn("reporting_period", reporting_period())
    co = dim(company, "company_code", "company_name", "country_key")
    acc = dim(gl_account, "gl_account", "gl_account_name", "account_group", "account_group_name",
              "pl_section")
    # the sides of the left joins are unique on their keys, so a question pays for those it uses
    cc = to_one(cost_center, ["cost_center"], "cost_center_name", "division_id", "division_name",
                "department_id", "department_name", "is_overhead")
    pg = to_one(programme, ["programme_id"], "programme_name", "programme_type")
    fx = fx_rate_pair(in_one_place(rates)).select(
        F.col("from_currency").alias("__fx_from"), F.col("to_currency").alias("__fx_to"),
        F.col("fiscal_year").alias("__fx_fy"), F.col("fiscal_period").alias("__fx_fp"),
        "rate_actual", "rate_budget",
    )
    due = to_one(soft_close_due(close_tasks), ["__sc_co", "__sc_fy", "__sc_fp"], "due_date")
    x = (
        j.join(co, "company_code", "inner")
        .join(acc, "gl_account", "inner")
        .join(cc, "cost_center", "left")
        .join(pg, "programme_id", "left")
        .join(
            fx,
            (F.col("local_currency") == F.col("__fx_from"))
            & (F.col("group_currency") == F.col("__fx_to"))
            & (F.col("fiscal_year") == F.col("__fx_fy"))
            & (F.col("reporting_period") == F.col("__fx_fp")),
            "left",
        )
        .join(
            due,
            (F.col("company_code") == F.col("__sc_co"))
            & (F.col("fiscal_year") == F.col("__sc_fy"))
            & (F.col("reporting_period") == F.col("__sc_fp")),
            "left",
        )
    )
    signed_local = signed("amount_local_currency")
    return x.select(
        "journal_id", "company_code", "company_name", "country_key",
        "document_number", "document_line", "document_type",
        "posting_date", "document_date", "entry_date",
        "fiscal_year", "fiscal_period", "reporting_period",
        "gl_account", "gl_account_name", "account_group", "account_group_name", "pl_section",
        "cost_center", "cost_center_name", "division_id", "division_name",
        "department_id", "department_name", "is_overhead",
        "programme_id", "programme_name", "programme_type",
        "debit_credit_ind", "doc_currency", "amount_doc_currency",
        "local_currency", "amount_local_currency", "group_currency", "amount_group_currency",
        signed("amount_group_currency").alias("signed_amount_group"),
        signed_local.alias("signed_amount_local"),
        (signed_local * F.col("rate_actual")).alias("signed_amount_at_actual_rate"),
        (signed_local * F.col("rate_budget")).alias("signed_amount_at_budget_rate"),
        "rate_actual", "rate_budget",
        is_manual().alias("is_manual_posting"),
        late_posting_flag().alias("is_late_posting"),
        "is_intercompany", "ic_partner_company",
        F.when(F.col("is_intercompany"), pair_key("company_code", "ic_partner_company")).alias("ic_pair"),
        "posting_user_id", "is_reversal", "reversed_document",
    )


def active_programme_window(df: DataFrame, programme: DataFrame,
                            start_col: str = "period_start", end_col: str = "period_end") -> DataFrame:
    """LG9: is the programme running in the period (interval overlap)."""
    p = dim(programme, F.col("programme_id").alias("__ap_id"), F.col("start_date").alias("__ap_s"),
            F.col("end_date").alias("__ap_e"))
    return df.join(p, F.col("programme_id") == F.col("__ap_id"), "left").withColumn(
        "is_programme_active",
        (F.col("__ap_s") <= F.col(end_col)) & (F.col("__ap_e") >= F.col(start_col)),
    ).drop("__ap_id", "__ap_s", "__ap_e")


def number_lines(lines: DataFrame, key: str, build: Callable[[DataFrame], DataFrame], keys: DataFrame,
                 group_cols: list[str], order_cols: list[str], out: str = "document_line") -> DataFrame:
    """WN4: ``row_number()`` within each document of ``build(lines)`` by ``order_cols``.

    All rows of a document share ``key``, by which ``build`` joins last, so documents are numbered where that join
    left them and nothing is shuffled for it.  The documents of a key that occurs more than ``ordering.HOT_ROWS``
    times in ``keys`` would be too much for a task: their lines are dealt to slices (``ordering.number_rows``).
    """
    number = F.row_number().over(Window.partitionBy(*group_cols).orderBy(*order_cols))
    hot = heavy_keys(keys, key)
    if hot is None:
        return build(lines).withColumn(out, number)
    light = build(lines.join(bounded(hot), key, "left_anti")).withColumn(out, number)
    heavy = number_rows(build(lines.join(bounded(hot), key, "left_semi")), group_cols, order_cols, out)
    return light.unionByName(heavy)
