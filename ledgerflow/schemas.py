"""Declared contracts of the eleven finance tables (SC2): types, nullability, primary keys.

Schemas are fixed and never inferred; keys stay strings (leading zeros).
"""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType, DateType, DecimalType, IntegerType, LongType, StringType, StructField, StructType,
)

S, I, L, B, D = StringType(), IntegerType(), LongType(), BooleanType(), DateType()
MONEY = DecimalType(15, 2)
RATE = DecimalType(15, 6)


def _st(*fields) -> StructType:
    return StructType([StructField(n, t, nullable) for n, t, nullable in fields])


SCHEMAS: dict[str, StructType] = {
    "company": _st(
        ("company_code", S, False), ("company_name", S, False), ("country_key", S, False),
        ("local_currency", S, False), ("group_currency", S, False),
        ("soft_close_working_day", I, False), ("hard_close_target_wd", I, False)),
    "cost_center": _st(
        ("cost_center", S, False), ("cost_center_name", S, False), ("company_code", S, False),
        ("division_id", S, False), ("division_name", S, False), ("department_id", S, False),
        ("department_name", S, False), ("parent_id", S, False), ("hierarchy_level", I, False),
        ("is_overhead", B, False), ("valid_from", D, False), ("valid_to", D, False),
        ("manager_user_id", S, False)),
    "programme": _st(
        ("programme_id", S, False), ("programme_name", S, False), ("programme_type", S, False),
        ("lead_company_code", S, False), ("start_date", D, False), ("end_date", D, False),
        ("total_budget_eur", MONEY, False), ("status", S, False)),
    "gl_account": _st(
        ("gl_account", S, False), ("gl_account_name", S, False), ("account_group", S, False),
        ("account_group_name", S, False), ("pl_section", S, False), ("is_pl_account", B, False),
        ("normal_balance", S, False)),
    "dim_date": _st(
        ("date_id", D, False), ("calendar_year", I, False), ("calendar_quarter", I, False),
        ("calendar_month", I, False), ("day_of_month", I, False), ("day_of_week", I, False),
        ("day_name", S, False), ("is_weekend", B, False), ("is_working_day", B, False),
        ("fiscal_year", I, False), ("fiscal_period", I, False), ("period_end_date", D, False),
        ("working_days_after_period_end", I, False), ("working_day_of_period", I, False)),
    "close_task": _st(
        ("task_id", S, False), ("task_name", S, False), ("task_sequence", I, False),
        ("target_working_day", I, False), ("is_milestone", B, False)),
    "rates": _st(
        ("from_currency", S, False), ("to_currency", S, False), ("fiscal_year", I, False),
        ("fiscal_period", I, False), ("rate_type", S, False), ("exchange_rate", RATE, False)),
    "journal": _st(
        ("journal_id", S, False), ("company_code", S, False), ("document_number", S, False),
        ("document_line", I, False), ("document_type", S, False), ("posting_date", D, False),
        ("document_date", D, False), ("entry_date", D, False), ("fiscal_year", I, False),
        ("fiscal_period", I, False), ("gl_account", S, False), ("cost_center", S, True),
        ("programme_id", S, True), ("debit_credit_ind", S, False), ("amount_doc_currency", MONEY, False),
        ("doc_currency", S, False), ("amount_local_currency", MONEY, False), ("local_currency", S, False),
        ("amount_group_currency", MONEY, False), ("group_currency", S, False),
        ("is_intercompany", B, False), ("ic_partner_company", S, True), ("posting_user_id", S, False),
        ("is_reversal", B, False), ("reversed_document", S, True)),
    "budget": _st(
        ("budget_id", L, False), ("company_code", S, False), ("fiscal_year", I, False),
        ("cost_center", S, False), ("account_group", S, False), ("programme_id", S, True),
        ("version", S, False), ("amount_group_currency", MONEY, False)),
    "forecast": _st(
        ("forecast_id", L, False), ("company_code", S, False), ("cost_center", S, False),
        ("programme_id", S, True), ("fiscal_year", I, False), ("fiscal_period", I, False),
        ("version", S, False), ("snapshot_date", D, False), ("horizon_periods", I, False),
        ("amount_group_currency", MONEY, False)),
    "close_tasks": _st(
        ("close_task_id", L, False), ("company_code", S, False), ("fiscal_year", I, False),
        ("fiscal_period", I, False), ("task_id", S, False), ("period_end_date", D, False),
        ("due_date", D, False), ("actual_completion_date", D, True), ("completed_by_user_id", S, True),
        ("delay_working_days", I, True)),
}

PRIMARY_KEYS: dict[str, list[str]] = {
    "company": ["company_code"],
    "cost_center": ["cost_center"],
    "programme": ["programme_id"],
    "gl_account": ["gl_account"],
    "dim_date": ["date_id"],
    "close_task": ["task_id"],
    "rates": ["from_currency", "to_currency", "fiscal_year", "fiscal_period", "rate_type"],
    "journal": ["journal_id"],
    "budget": ["budget_id"],
    "forecast": ["forecast_id"],
    "close_tasks": ["close_task_id"],
}

#: L1 contract projections (SC10) = the declared columns of each table.
CONTRACT_COLUMNS: dict[str, list[str]] = {t: [f.name for f in s.fields] for t, s in SCHEMAS.items()}

#: Dimension tables that are joined by broadcast after a size check.
DIMENSIONS = ["company", "cost_center", "programme", "gl_account", "dim_date", "close_task", "rates",
              "close_tasks"]
