"""Registered queries: data quality, signal detectors, reconciliation, profiling, slicing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions.columns import period_key, money, ratio
from ..operators import (
    hierarchy, kpis, lineage, materialise, publish, quality, reconcile, signals, slicing, sql_functions,
)
from .catalog import (
    EAC_SQL, FULL_YEAR, M, _PL_SQL, _TASKS_H_CTE, _VARIANCE_CTE, _runrate_out, _runrate_sql, money_cols, register, runrate_cte,
)
from .oracle_preamble import sql_exact_ratio
from .context import Ctx

# ======================================================================== quality
_JOURNAL_RULES = [
    ("fk_company", "co.company_code IS NULL"),
    ("fk_gl_account", "a.gl_account IS NULL"),
    ("fk_cost_center", "j.cost_center IS NOT NULL AND cc.cost_center IS NULL"),
    ("fk_programme", "j.programme_id IS NOT NULL AND p.programme_id IS NULL"),
    ("programme_empty_string", "j.programme_id = ''"),
    ("centre_ownership", "cc.cost_center IS NOT NULL AND cc.company_code <> j.company_code"),
    ("revenue_no_centre", "a.account_group = 'REV' AND j.cost_center IS NOT NULL"),
    ("programme_window_non_reversal",
     "p.programme_id IS NOT NULL AND NOT j.is_reversal AND (j.posting_date < p.start_date OR j.posting_date > p.end_date)"),
    ("programme_window_reversal",
     "p.programme_id IS NOT NULL AND j.is_reversal AND (j.posting_date < p.start_date OR j.posting_date > p.end_date)"),
    ("date_order", "j.document_date > j.posting_date OR j.posting_date > j.entry_date"),
    ("period_range", "j.fiscal_period < 1 OR j.fiscal_period > 16"),
    ("special_in_incomplete_year", "j.fiscal_period > 12 AND j.fiscal_year >= (SELECT open_year FROM span)"),
    ("posting_outside_period",
     "j.fiscal_period <= 12 AND (year(j.posting_date) <> j.fiscal_year OR month(j.posting_date) <> j.fiscal_period)"),
    ("unsigned_amounts", "j.amount_doc_currency < 0 OR j.amount_local_currency < 0 OR j.amount_group_currency < 0"),
    ("group_reconciles",
     "NOT j.is_reversal AND (r.exchange_rate IS NULL "
     "OR abs(j.amount_group_currency - round(j.amount_local_currency * r.exchange_rate, 2)) > 0.01)"),
    ("same_currency_identity",
     "j.local_currency = j.group_currency AND j.amount_local_currency <> j.amount_group_currency"),
    ("normal_balance", "NOT j.is_reversal AND NOT j.is_intercompany AND j.debit_credit_ind <> a.normal_balance"),
    ("intercompany_partner",
     "(j.is_intercompany AND (j.ic_partner_company IS NULL OR j.ic_partner_company = j.company_code)) "
     "OR (NOT j.is_intercompany AND j.ic_partner_company IS NOT NULL)"),
    ("user_token_pattern", "NOT regexp_matches(j.posting_user_id, '^USR-[0-9A-F]{6}$')"),
]

_QC_JOURNAL_CTE = """
, qj AS (
  SELECT count(*) AS n, {cols}
  FROM journal j
  LEFT JOIN company co ON co.company_code = j.company_code
  LEFT JOIN gl_account a ON a.gl_account = j.gl_account
  LEFT JOIN cost_center cc ON cc.cost_center = j.cost_center
  LEFT JOIN programme p ON p.programme_id = j.programme_id
  LEFT JOIN rates_m r ON r.from_currency = j.local_currency AND r.fiscal_year = j.fiscal_year
                     AND r.fiscal_period = least(j.fiscal_period, 12)
)
""".format(cols=", ".join(
    f"CAST(sum(CASE WHEN coalesce({cond}, FALSE) THEN 1 ELSE 0 END) AS BIGINT) AS v_{name}"
    for name, cond in _JOURNAL_RULES))


def _rows(cte: str, table: str, rules: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{r}' AS rule, '{table}' AS table_name, CAST(n AS BIGINT) AS rows_checked, "
        f"CAST(v_{r} AS BIGINT) AS violations FROM {cte}" for r in rules)


_QC_DOC_CTE = """
, qd0 AS (
  SELECT document_number, min(document_line) AS lo, max(document_line) AS hi, count(*) AS c,
         (min(company_code) <> max(company_code) OR min(fiscal_year) <> max(fiscal_year)
          OR min(fiscal_period) <> max(fiscal_period) OR min(document_type) <> max(document_type)) AS header_bad
  FROM journal GROUP BY document_number
),
qd AS (
  SELECT count(*) AS n, sum(CASE WHEN lo <> 1 OR hi <> c THEN 1 ELSE 0 END) AS v_line_numbering,
         sum(CASE WHEN header_bad THEN 1 ELSE 0 END) AS v_header_consistency
  FROM qd0
),
qu AS (
  SELECT count(*) AS n, sum(CASE WHEN multi THEN 1 ELSE 0 END) AS v_user_single_entity
  FROM (SELECT posting_user_id, min(company_code) <> max(company_code) AS multi FROM journal GROUP BY posting_user_id)
),
qr AS (
  SELECT count(*) AS n,
         sum(CASE WHEN o.document_number IS NULL OR r.debit_credit_ind = o.debit_credit_ind
                       OR r.posting_date <= o.posting_date OR r.amount_doc_currency <> o.amount_doc_currency
                       OR r.amount_local_currency <> o.amount_local_currency
                       OR r.amount_group_currency <> o.amount_group_currency THEN 1 ELSE 0 END) AS v_reversal_match
  FROM journal r LEFT JOIN journal o ON o.document_number = r.reversed_document AND o.document_line = r.document_line
  WHERE r.is_reversal
)
"""

_QC_PLAN_CTE = """
, qb AS (
  SELECT count(*) AS n,
         sum(CASE WHEN co.company_code IS NULL OR cc.cost_center IS NULL OR g.account_group IS NULL THEN 1 ELSE 0 END)
           AS v_budget_keys,
         sum(CASE WHEN b.version <> 'BUDGET' THEN 1 ELSE 0 END) AS v_budget_version
  FROM budget b
  LEFT JOIN company co ON co.company_code = b.company_code
  LEFT JOIN cost_center cc ON cc.cost_center = b.cost_center
  LEFT JOIN (SELECT DISTINCT account_group FROM gl_account) g ON g.account_group = b.account_group
),
qf AS (
  SELECT count(*) AS n,
         sum(CASE WHEN co.company_code IS NULL OR cc.cost_center IS NULL THEN 1 ELSE 0 END) AS v_forecast_keys,
         sum(CASE WHEN f.version NOT IN ('FC-Q1', 'FC-Q2', 'FC-Q3') THEN 1 ELSE 0 END) AS v_forecast_version,
         sum(CASE WHEN f.horizon_periods < 1 OR f.horizon_periods <> f.fiscal_period - (month(f.snapshot_date) - 1)
                  THEN 1 ELSE 0 END) AS v_forecast_horizon
  FROM forecast f
  LEFT JOIN company co ON co.company_code = f.company_code
  LEFT JOIN cost_center cc ON cc.cost_center = f.cost_center
),
qc AS (
  SELECT count(*) AS n,
         sum(CASE WHEN coalesce(d.is_working_day, FALSE) THEN 0 ELSE 1 END) AS v_due_on_working_day,
         sum(CASE WHEN t.actual_completion_date IS NULL
                   AND (t.delay_working_days IS NOT NULL OR t.completed_by_user_id IS NOT NULL) THEN 1 ELSE 0 END)
           AS v_open_rows_clean,
         count(*) - count(DISTINCT (t.company_code, t.fiscal_year, t.fiscal_period, t.task_id)) AS v_coverage_duplicates
  FROM close_tasks t LEFT JOIN dim_date d ON d.date_id = t.due_date
),
qc_expected AS (
  SELECT co.company_code, c.fiscal_year, c.fiscal_period, t.task_id FROM company co, covered c, close_task t
),
qcov AS (
  SELECT count(*) AS n, sum(CASE WHEN x.task_id IS NULL THEN 1 ELSE 0 END) AS v_coverage_missing
  FROM qc_expected e LEFT JOIN (SELECT DISTINCT company_code, fiscal_year, fiscal_period, task_id FROM close_tasks) x
    ON x.company_code = e.company_code AND x.fiscal_year = e.fiscal_year AND x.fiscal_period = e.fiscal_period
   AND x.task_id = e.task_id
),
qrate AS (
  SELECT count(*) AS n, sum(CASE WHEN r.exchange_rate IS NULL THEN 1 ELSE 0 END) AS v_rate_coverage
  FROM (SELECT DISTINCT local_currency, fiscal_year, least(fiscal_period, 12) AS rp FROM journal) need
  LEFT JOIN rates_m r ON r.from_currency = need.local_currency AND r.fiscal_year = need.fiscal_year
                     AND r.fiscal_period = need.rp
),
qbrate AS (
  SELECT count(*) AS n, sum(CASE WHEN moving THEN 1 ELSE 0 END) AS v_budget_rate_frozen
  FROM (SELECT from_currency, fiscal_year, min(exchange_rate) <> max(exchange_rate) AS moving
        FROM rates WHERE rate_type = 'B' GROUP BY from_currency, fiscal_year)
)
"""


def _pk_sql(table: str, keys: str, rule: str = "primary_key") -> str:
    return (f"SELECT '{rule}' AS rule, '{table}' AS table_name, CAST(coalesce(sum(c), 0) AS BIGINT) AS rows_checked, "
            f"CAST(coalesce(sum(c - 1), 0) AS BIGINT) AS violations "
            f"FROM (SELECT count(*) AS c FROM {table} GROUP BY {keys})")


_QC_ALL_SQL = _QC_JOURNAL_CTE + _QC_DOC_CTE + _QC_PLAN_CTE + "\n" + " UNION ALL ".join([
    _pk_sql("journal", "journal_id"),
    _pk_sql("journal", "document_number, document_line", "document_line_unique"),
    _rows("qj", "journal", [r for r, _ in _JOURNAL_RULES]),
    _rows("qd", "journal_documents", ["line_numbering", "header_consistency"]),
    _rows("qu", "journal_users", ["user_single_entity"]),
    _rows("qr", "journal_reversals", ["reversal_match"]),
    _rows("qb", "budget", ["budget_keys", "budget_version"]),
    _rows("qf", "forecast", ["forecast_keys", "forecast_version", "forecast_horizon"]),
    _rows("qc", "close_tasks", ["due_on_working_day", "open_rows_clean", "coverage_duplicates"]),
    _rows("qcov", "close_tasks", ["coverage_missing"]),
    _rows("qrate", "rates", ["rate_coverage"]),
    _rows("qbrate", "rates", ["budget_rate_frozen"]),
    _pk_sql("company", "company_code"),
    _pk_sql("cost_center", "cost_center"),
    _pk_sql("programme", "programme_id"),
    _pk_sql("gl_account", "gl_account"),
    _pk_sql("close_tasks", "close_task_id"),
])


@register("qc_summary", _QC_ALL_SQL)
def q_qc_summary(ctx: Ctx) -> DataFrame:
    """QC1-QC19 — every data-quality rule on the adapted ledger: (rule, table, rows checked, violations)."""
    return quality.qc_summary(ctx.L)


_QC_GROUPS = {
    # key: (journal row rules, extra (cte, table, rules) parts, spark parts)
    "qc_foreign_keys": ["fk_company", "fk_gl_account", "fk_cost_center", "fk_programme", "programme_empty_string"],
    "qc_centre_ownership": ["centre_ownership"],
    "qc_revenue_no_centre": ["revenue_no_centre"],
    "qc_programme_window": ["programme_window_non_reversal", "programme_window_reversal"],
    "qc_date_order": ["date_order"],
    "qc_period_range": ["period_range", "special_in_incomplete_year", "posting_outside_period"],
    "qc_unsigned_amounts": ["unsigned_amounts"],
    "qc_group_reconciles": ["group_reconciles"],
    "qc_same_currency_identity": ["same_currency_identity"],
    "qc_normal_balance": ["normal_balance"],
    "qc_intercompany": ["intercompany_partner"],
}


_QC_IDS = {"qc_foreign_keys": "QC4/JN14", "qc_centre_ownership": "QC5", "qc_revenue_no_centre": "QC6",
           "qc_programme_window": "QC7/LG9", "qc_date_order": "QC8", "qc_period_range": "QC9",
           "qc_unsigned_amounts": "QC10", "qc_group_reconciles": "QC11/FX9", "qc_same_currency_identity": "QC13",
           "qc_normal_balance": "QC14", "qc_intercompany": "QC15"}


def _register_row_group(key: str, rules: list[str]):
    def q(ctx: Ctx) -> DataFrame:
        L = ctx.L
        return quality.journal_row_rules(L.journal, L.company, L.gl_account, L.cost_center, L.programme_master, L.rates,
                                         L.fiscal_span.open_year, rules)

    q.__doc__ = (f"{_QC_IDS[key]} — {key[3:].replace('_', ' ')}: {', '.join(rules)} "
                 f"(row rules on the journal, one scan).")
    return register(key, _QC_JOURNAL_CTE + _rows("qj", "journal", rules))(q)


for _k, _rules in _QC_GROUPS.items():
    _register_row_group(_k, _rules)


@register("qc_primary_keys", " UNION ALL ".join([
    _pk_sql("journal", "journal_id"), _pk_sql("journal", "document_number, document_line", "document_line_unique"),
    _pk_sql("company", "company_code"), _pk_sql("cost_center", "cost_center"), _pk_sql("programme", "programme_id"),
    _pk_sql("gl_account", "gl_account"), _pk_sql("close_tasks", "close_task_id")]))
def q_qc_pk(ctx: Ctx) -> DataFrame:
    """QC1 — primary keys unique; (document, line) unique."""
    L = ctx.L
    from .. import schemas

    parts = [quality.primary_key_rule(L.journal, "journal", ["journal_id"]),
             quality.primary_key_rule(L.journal, "journal", ["document_number", "document_line"],
                                      "document_line_unique")]
    parts += [quality.primary_key_rule(getattr(L, t), t, schemas.PRIMARY_KEYS[t])
              for t in ("company", "cost_center", "programme", "gl_account", "close_tasks")]
    return reduce(DataFrame.unionByName, parts)


@register("qc_line_numbering", _QC_DOC_CTE + _rows("qd", "journal_documents", ["line_numbering", "header_consistency"]))
def q_qc_docs(ctx: Ctx) -> DataFrame:
    """QC2/QC3/AG11/AG12 — lines 1..n per document and one header per document (one grouping)."""
    return quality.document_rules(ctx.L.journal_by_document)


@register("qc_reversal_match", _QC_DOC_CTE + _rows("qr", "journal_reversals", ["reversal_match"]))
def q_qc_rev(ctx: Ctx) -> DataFrame:
    """QC12/JN15 — every reversal matches its original line (a window over document and line)."""
    return quality.reversal_rules(ctx.L.journal_by_document)


@register("qc_user_tokens", _QC_JOURNAL_CTE + _QC_DOC_CTE + _rows("qj", "journal", ["user_token_pattern"])
          + " UNION ALL " + _rows("qu", "journal_users", ["user_single_entity"]))
def q_qc_users(ctx: Ctx) -> DataFrame:
    """QC16/SF16 — user token pattern and one entity per user."""
    L = ctx.L
    rows = quality.journal_row_rules(L.journal, L.company, L.gl_account, L.cost_center, L.programme_master, L.rates,
                                     rules=["user_token_pattern"])
    return rows.unionByName(quality.user_rules(L.journal))


@register("qc_plan", _QC_PLAN_CTE + _rows("qb", "budget", ["budget_keys", "budget_version"]) + " UNION ALL "
          + _rows("qf", "forecast", ["forecast_keys", "forecast_version", "forecast_horizon"]))
def q_qc_plan(ctx: Ctx) -> DataFrame:
    """QC17 — plan keys, versions and forecast horizons."""
    L = ctx.L
    return quality.plan_rules(L.budget, L.forecast, L.company, L.cost_center, L.gl_account)


@register("qc_programme_window_limit", """
, pw AS (
  SELECT j.programme_id, j.is_reversal,
         NOT coalesce(p.start_date <= last_day(make_date(j.fiscal_year, least(j.fiscal_period, 12), 1))
                      AND p.end_date >= make_date(j.fiscal_year, least(j.fiscal_period, 12), 1), FALSE) AS outside
  FROM journal j LEFT JOIN prog_master p ON p.programme_id = j.programme_id WHERE j.programme_id IS NOT NULL
)
SELECT programme_id, count(*) AS line_count, count(*) FILTER (WHERE outside) AS outside,
       count(*) FILTER (WHERE outside AND NOT is_reversal) AS outside_not_reversal,
       CAST(count(*) FILTER (WHERE outside) AS DOUBLE) / count(*) AS outside_share,
       CAST(count(*) FILTER (WHERE outside) AS DOUBLE) / count(*) < 0.01
         AND count(*) FILTER (WHERE outside AND NOT is_reversal) = 0 AS passed
FROM pw GROUP BY programme_id
""")
def q_qc_programme_limit(ctx: Ctx) -> DataFrame:
    """QC7 — share of each programme's lines outside its dates against the 1 % limit."""
    return quality.programme_window_share(ctx.L.journal, ctx.L.programme_master)


@register("qc_close_coverage", _QC_PLAN_CTE + _rows("qc", "close_tasks",
                                                    ["due_on_working_day", "open_rows_clean", "coverage_duplicates"])
          + " UNION ALL " + _rows("qcov", "close_tasks", ["coverage_missing"]))
def q_qc_close(ctx: Ctx) -> DataFrame:
    """QC18 — close coverage, due dates on working days, clean open rows."""
    L = ctx.L
    return quality.close_rules(L.close_tasks, L.company, L.dim_date, L.periods)


@register("qc_rate_coverage", _QC_PLAN_CTE + _rows("qrate", "rates", ["rate_coverage"]) + " UNION ALL "
          + _rows("qbrate", "rates", ["budget_rate_frozen"]))
def q_qc_rates(ctx: Ctx) -> DataFrame:
    """QC19 — every needed rate exists; budget rate constant per fiscal year."""
    return quality.rate_rules(ctx.L.journal, ctx.L.rates)


@register("qc_journal_rules", _QC_JOURNAL_CTE + _rows("qj", "journal", [r for r, _ in _JOURNAL_RULES]))
def q_qc_journal(ctx: Ctx) -> DataFrame:
    """QC4-QC11, QC13-QC16 — row-level journal rules in one scan."""
    L = ctx.L
    return quality.journal_row_rules(L.journal, L.company, L.gl_account, L.cost_center, L.programme_master, L.rates,
                                     L.fiscal_span.open_year)


@register("qc_driver_tables", f"""
SELECT 'primary_key' AS rule, 'lineitem' AS table_name, CAST(sum(c) AS BIGINT) AS rows_checked,
       CAST(sum(c - 1) AS BIGINT) AS violations
FROM (SELECT count(*) AS c FROM lineitem GROUP BY l_orderkey, l_linenumber)
UNION ALL
SELECT 'orders_without_lines', 'orders', count(*),
       CAST(sum(CASE WHEN l.k IS NULL THEN 1 ELSE 0 END) AS BIGINT)
FROM orders o LEFT JOIN (SELECT DISTINCT l_orderkey AS k FROM lineitem) l ON l.k = o.o_orderkey
UNION ALL
SELECT 'lines_without_order', 'lineitem', count(*), CAST(sum(CASE WHEN o.o_orderdate IS NULL THEN 1 ELSE 0 END) AS BIGINT)
FROM lineitem l LEFT JOIN orders o ON o.o_orderkey = l.l_orderkey
UNION ALL
SELECT 'ship_before_order', 'lineitem', count(*),
       CAST(sum(CASE WHEN l.l_shipdate < o.o_orderdate THEN 1 ELSE 0 END) AS BIGINT)
FROM lineitem l LEFT JOIN orders o ON o.o_orderkey = l.l_orderkey
""")
def q_qc_driver(ctx: Ctx) -> DataFrame:
    """QC1/QC4/QC8 on the raw driver tables, where real violations exist."""
    L = ctx.L
    return quality.driver_table_rules(L.spark, L.sf_dir)


@register("qc_domain_values", """
SELECT 'document_type' AS domain, count(DISTINCT document_type) FILTER (
         WHERE document_type NOT IN ('SA', 'SB', 'KR', 'IC', 'RE', 'WA')) AS unexpected_values FROM journal
UNION ALL
SELECT 'budget_version', count(DISTINCT version) FILTER (WHERE version NOT IN ('BUDGET')) FROM budget
UNION ALL
SELECT 'forecast_version', count(DISTINCT version) FILTER (WHERE version NOT IN ('FC-Q1', 'FC-Q2', 'FC-Q3'))
FROM forecast
UNION ALL
SELECT 'special_period', count(DISTINCT fiscal_period) FILTER (WHERE fiscal_period > 12 AND fiscal_period NOT IN (13, 14, 15, 16))
FROM journal
""")
def q_qc_domain(ctx: Ctx) -> DataFrame:
    """ST5 — observed values outside their allowed sets (left anti join against the allowed values)."""
    L = ctx.L
    spark = L.spark

    def unexpected(domain, df, col, allowed, where=None):
        obs = (df.where(where) if where is not None else df).select(F.col(col).alias("v")).distinct()
        ok = spark.createDataFrame([(a,) for a in allowed], obs.schema)
        return obs.join(F.broadcast(ok), "v", "left_anti").agg(
            F.lit(domain).alias("domain"), F.count(F.lit(1)).alias("unexpected_values"))

    parts = [
        unexpected("document_type", L.journal, "document_type", ["SA", "SB", "KR", "IC", "RE", "WA"]),
        unexpected("budget_version", L.budget, "version", [config.BUDGET_VERSION]),
        unexpected("forecast_version", L.forecast, "version", list(config.FORECAST_SNAPSHOT_AFTER_PERIOD)),
        unexpected("special_period", L.journal, "fiscal_period", [13, 14, 15, 16], F.col("fiscal_period") > 12),
    ]
    return reduce(DataFrame.unionByName, parts)


# ======================================================================== signals
@register("slow_closer", _TASKS_H_CTE + """
, sc_d AS (
  SELECT t.company_code, t.days_to_close, co.hard_close_target_wd
  FROM tasks_h t JOIN company co ON co.company_code = t.company_code
  WHERE t.task_id = 'T12' AND t.days_to_close IS NOT NULL
),
sc_e AS (
  SELECT company_code, avg(days_to_close) AS avg_days_to_close,
         avg(CASE WHEN days_to_close > hard_close_target_wd THEN 1.0 ELSE 0.0 END) AS miss_share,
         count(*) AS closed_periods
  FROM sc_d GROUP BY company_code
)
SELECT *, row_number() OVER (ORDER BY avg_days_to_close DESC, company_code) AS rank,
       avg_days_to_close - lead(avg_days_to_close) OVER (ORDER BY avg_days_to_close DESC, company_code) AS gap_to_next
FROM sc_e
""")
def q_slow_closer(ctx: Ctx) -> DataFrame:
    """SG1/WN8 — entity close ranking: average days, gap to the next slowest, target-miss share."""
    return signals.slow_closer(ctx.tasks_h, ctx.L.company)


_PM_CTE = """
, pm AS (
  SELECT programme_id, fiscal_year, fiscal_period, fiscal_year * 100 + fiscal_period AS pk,
         sum(signed_amount_group) AS cost
  FROM v_journal WHERE programme_id IS NOT NULL AND fiscal_period <= 12
  GROUP BY programme_id, fiscal_year, fiscal_period
)
"""


@register("burn_acceleration", _PM_CTE + """
, g AS (
  SELECT programme_id,
         sum(CASE WHEN fiscal_year = 1999 THEN cost END) AS cost_a, sum(CASE WHEN fiscal_year = 1999 THEN 1 ELSE 0 END) AS n_a,
         sum(CASE WHEN fiscal_year = 2000 THEN cost END) AS cost_b, sum(CASE WHEN fiscal_year = 2000 THEN 1 ELSE 0 END) AS n_b
  FROM pm GROUP BY programme_id
)
SELECT programme_id, CAST(cost_a AS DOUBLE) / nullif(n_a, 0) AS mean_burn_a,
       CAST(cost_b AS DOUBLE) / nullif(n_b, 0) AS mean_burn_b,
       (CAST(cost_b AS DOUBLE) / nullif(n_b, 0)) / nullif(CAST(cost_a AS DOUBLE) / nullif(n_a, 0), 0) AS acceleration
FROM g
""")
def q_burn_acceleration(ctx: Ctx) -> DataFrame:
    """SG2 — mean monthly burn 2000 over 1999 per programme."""
    return signals.burn_acceleration(ctx.vj, 1999, 2000)


@register("before_after_burn", _PM_CTE + """
SELECT programme_id,
       CAST(sum(CASE WHEN pk < 200001 THEN cost END) AS DOUBLE)
         / nullif(sum(CASE WHEN pk < 200001 THEN 1 ELSE 0 END), 0) AS mean_burn_before,
       CAST(sum(CASE WHEN pk >= 200001 THEN cost END) AS DOUBLE)
         / nullif(sum(CASE WHEN pk >= 200001 THEN 1 ELSE 0 END), 0) AS mean_burn_after
FROM pm GROUP BY programme_id
""")
def q_before_after(ctx: Ctx) -> DataFrame:
    """SG3 — mean monthly burn before and from 2000/01 per programme."""
    return signals.before_after_burn(ctx.vj, 200001)


@register("programme_over_annual_budget", f"""
, a AS (
  SELECT programme_id, sum(signed_amount_group) AS actual FROM v_journal
  WHERE fiscal_year = {FULL_YEAR} AND fiscal_period <= 12 AND programme_id IS NOT NULL AND cost_center IS NOT NULL
  GROUP BY programme_id
),
b AS (
  SELECT programme_id, sum(amount_group_currency) AS budget FROM budget
  WHERE fiscal_year = {FULL_YEAR} AND programme_id IS NOT NULL GROUP BY programme_id
)
SELECT coalesce(a.programme_id, b.programme_id) AS programme_id, {M('a.actual')} AS actual, {M('b.budget')} AS budget,
       CAST(a.actual AS DOUBLE) / nullif(CAST(b.budget AS DOUBLE), 0) AS actual_over_budget
FROM a FULL OUTER JOIN b ON a.programme_id = b.programme_id
""")
def q_over_budget(ctx: Ctx) -> DataFrame:
    """SG4 — FY actual against FY budget per programme."""
    return money_cols(signals.programme_over_annual_budget(ctx.vj, ctx.L.budget, FULL_YEAR), "actual", "budget")


@register("fx_net_vs_gross", f"""
, fxc AS (
  SELECT company_code, sum(signed_amount_at_actual_rate) - sum(signed_amount_at_budget_rate) AS fx_impact,
         sum(amount_local_currency * rate_budget) AS gross
  FROM v_journal
  GROUP BY company_code, company_name, local_currency, fiscal_year, reporting_period, account_group
),
fxe AS (SELECT company_code, round(sum(fx_impact), 2) AS fx, round(sum(abs(gross)), 2) AS gross FROM fxc GROUP BY 1)
SELECT company_code, CAST(fx AS DOUBLE) AS fx_impact, CAST(gross AS DOUBLE) AS gross_exposure,
       CAST(abs(fx) AS DOUBLE) / nullif(CAST(gross AS DOUBLE), 0) AS net_over_gross
FROM fxe
""")
def q_fx_net_vs_gross(ctx: Ctx) -> DataFrame:
    """SG5 — |net FX impact| over gross exposure per entity."""
    g = kpis.fx_impact(ctx.vj).groupBy("company_code").agg(
        F.round(F.sum("fx_impact"), 2).alias("fx"), F.round(F.sum(F.abs("gross_at_budget_rate")), 2).alias("gross"))
    return g.select("company_code", F.col("fx").cast("double").alias("fx_impact"),
                    F.col("gross").cast("double").alias("gross_exposure"),
                    ratio(F.abs("fx"), "gross").alias("net_over_gross"))


@register("fx_impact_cost_base", """
, fxc AS (
  SELECT company_code, local_currency,
         round(sum(signed_amount_at_actual_rate) - sum(signed_amount_at_budget_rate), 2) AS fx,
         round(sum(signed_amount_at_budget_rate), 2) AS cost
  FROM v_journal WHERE account_group <> 'REV' GROUP BY company_code, local_currency
)
SELECT company_code, local_currency, CAST(fx AS DOUBLE) AS fx_impact, CAST(cost AS DOUBLE) AS cost_at_budget_rate,
       CAST(fx AS DOUBLE) / nullif(CAST(cost AS DOUBLE), 0) AS fx_share_of_cost
FROM fxc
""")
def q_fx_cost_base(ctx: Ctx) -> DataFrame:
    """FX7 — FX impact on cost lines with its share of the cost base."""
    f = kpis.fx_impact_cost_base(ctx.vj)
    fx, cost = F.round("fx_impact", 2), F.round("cost_at_budget_rate", 2)
    return f.select("company_code", "local_currency", fx.cast("double").alias("fx_impact"),
                    cost.cast("double").alias("cost_at_budget_rate"), ratio(fx, cost).alias("fx_share_of_cost"))


@register("rate_movement", """
SELECT from_currency, CAST(max(exchange_rate) AS DOUBLE) AS max_rate, CAST(min(exchange_rate) AS DOUBLE) AS min_rate,
       CAST(max(exchange_rate) - min(exchange_rate) AS DOUBLE) / CAST(min(exchange_rate) AS DOUBLE) AS relative_move
FROM rates WHERE rate_type = 'M' GROUP BY from_currency
""")
def q_rate_movement(ctx: Ctx) -> DataFrame:
    """SG6 — max / min actual rate per currency."""
    r = signals.rate_movement(ctx.L.rates)
    return r.withColumn("max_rate", F.col("max_rate").cast("double")).withColumn(
        "min_rate", F.col("min_rate").cast("double"))


@register("manual_close_window", """
, mc AS (
  SELECT j.company_code, de.working_day_seq - dp.working_day_seq AS wd_after
  FROM v_journal j
  LEFT JOIN dim_date dp ON dp.date_id = last_day(make_date(j.fiscal_year, j.fiscal_period, 1))
  LEFT JOIN dim_date de ON de.date_id = j.entry_date
  WHERE j.is_manual_posting AND NOT j.is_reversal AND j.fiscal_period <= 12
)
SELECT company_code, count(*) AS manual_lines,
       CAST(sum(CASE WHEN wd_after BETWEEN 1 AND 5 THEN 1 ELSE 0 END) AS BIGINT) AS in_close_window,
       CAST(sum(CASE WHEN wd_after BETWEEN 1 AND 5 THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS close_window_share
FROM mc GROUP BY company_code
""")
def q_manual_close_window(ctx: Ctx) -> DataFrame:
    """SG7 — share of manual entries entered on working days 1-5 after period end."""
    return signals.manual_close_window(ctx.vj, ctx.L.dim_date)


def _concentration_sql(flag: str, where: str) -> str:
    return f"""
, ce AS (
  SELECT company_code, count(*) AS lines, CAST(sum(CASE WHEN {flag} THEN 1 ELSE 0 END) AS BIGINT) AS flagged,
         CAST(sum(CASE WHEN {flag} THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS share
  FROM v_journal {where} GROUP BY company_code
),
co2 AS (
  SELECT a.*, (SELECT max(b.share) FROM ce b WHERE b.company_code <> a.company_code) AS max_share_others FROM ce a
)
SELECT *, CASE WHEN max_share_others <> 0 THEN share / max_share_others END AS share_over_others FROM co2
"""


@register("manual_concentration", _concentration_sql("is_manual_posting", ""))
def q_manual_conc(ctx: Ctx) -> DataFrame:
    """SG8 — manual share per entity against the highest among the others."""
    return signals.concentration(ctx.vj, "is_manual_posting", regular_only=False)


@register("late_concentration", _concentration_sql("is_late_posting", "WHERE fiscal_period <= 12"))
def q_late_conc(ctx: Ctx) -> DataFrame:
    """SG8 — late share per entity against the highest among the others."""
    return signals.concentration(ctx.vj, "is_late_posting", regular_only=True)


@register("punctuality", """
SELECT company_code, fiscal_year, fiscal_period, count(DISTINCT entry_date) AS distinct_entry_dates, count(*) AS lines
FROM v_journal WHERE account_group = 'PER' AND NOT is_manual_posting AND fiscal_period <= 12
GROUP BY company_code, fiscal_year, fiscal_period
""")
def q_punctuality(ctx: Ctx) -> DataFrame:
    """SG9 — distinct entry dates per entity and period for automatic personnel postings."""
    return signals.punctuality(ctx.vj)


@register("year_end_adjustments", """
SELECT fiscal_year, count(*) AS year_lines,
       CAST(sum(CASE WHEN fiscal_period > 12 THEN 1 ELSE 0 END) AS BIGINT) AS special_lines,
       CAST(sum(CASE WHEN fiscal_period > 12 AND is_manual_posting THEN 1 ELSE 0 END) AS BIGINT) AS special_manual,
       CAST(sum(CASE WHEN fiscal_period > 12 AND month(posting_date) = 12 AND day(posting_date) = 31 THEN 1 ELSE 0 END)
            AS BIGINT) AS special_dated_dec31,
       CAST(sum(CASE WHEN fiscal_period > 12 AND year(entry_date) > fiscal_year THEN 1 ELSE 0 END) AS BIGINT)
         AS special_entered_next_year,
       CAST(sum(CASE WHEN fiscal_period > 12 THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS special_share
FROM v_journal GROUP BY fiscal_year
""")
def q_year_end(ctx: Ctx) -> DataFrame:
    """SG10 — year-end adjustments per fiscal year."""
    return signals.year_end_adjustments(ctx.vj)


@register("open_year_flattery", _VARIANCE_CTE + f"""
, oy AS (
  SELECT company_code,
         sum(CASE WHEN fiscal_period <= {config.AS_OF_PERIOD} THEN actual_amount END) AS actual_ytd,
         sum(budget_amount) AS budget_full_year,
         sum(CASE WHEN fiscal_period <= {config.AS_OF_PERIOD} THEN budget_amount END) AS budget_ytd
  FROM variance WHERE fiscal_year = {config.AS_OF_YEAR} GROUP BY company_code
)
SELECT company_code, {M('actual_ytd')} AS actual_ytd, {M('budget_full_year')} AS budget_full_year,
       {M('budget_ytd')} AS budget_ytd,
       CAST(actual_ytd AS DOUBLE) / nullif(CAST(budget_full_year AS DOUBLE), 0) AS vs_full_year,
       CAST(actual_ytd AS DOUBLE) / nullif(CAST(budget_ytd AS DOUBLE), 0) AS vs_ytd
FROM oy
""")
def q_open_year(ctx: Ctx) -> DataFrame:
    """SG11 — open-year flattery: actual against full-year versus year-to-date budget."""
    df = signals.open_year_flattery(ctx.variance, config.AS_OF_YEAR, config.AS_OF_PERIOD)
    return money_cols(df, "actual_ytd", "budget_full_year", "budget_ytd")


@register("variance_ytd", _VARIANCE_CTE + f"""
, lc AS (
  SELECT fiscal_year, max(fiscal_period) AS last_closed_period
  FROM (SELECT fiscal_year, fiscal_period,
               sum(CASE WHEN actual_completion_date IS NULL THEN 1 ELSE 0 END) AS open_rows
        FROM close_tasks WHERE task_id = 'T12' GROUP BY fiscal_year, fiscal_period)
  WHERE open_rows = 0 GROUP BY fiscal_year
)
SELECT v.company_code, v.fiscal_year, lc.last_closed_period, {M('sum(v.actual_amount)')} AS actual_ytd,
       {M('sum(v.budget_amount)')} AS budget_ytd, {M('sum(v.actual_amount) - sum(v.budget_amount)')} AS variance_ytd
FROM variance v JOIN lc ON lc.fiscal_year = v.fiscal_year
WHERE v.fiscal_period <= lc.last_closed_period
GROUP BY v.company_code, v.fiscal_year, lc.last_closed_period
""")
def q_variance_ytd(ctx: Ctx) -> DataFrame:
    """PF9 — year-to-date variance bounded by the last period closed by every entity."""
    v = kpis.variance_ytd(ctx.variance, kpis.last_closed_period(ctx.L.close_tasks))
    return money_cols(v, "actual_ytd", "budget_ytd", "variance_ytd")


@register("variance_hierarchy_rollup", _VARIANCE_CTE + f"""
SELECT v.company_code, cc.division_id, cc.department_id, v.cost_center,
       {M('sum(v.actual_amount)')} AS actual_amount, {M('sum(v.budget_amount)')} AS budget_amount,
       {M('sum(v.variance)')} AS variance,
       CAST(GROUPING(v.company_code, cc.division_id, cc.department_id, v.cost_center) AS INTEGER) AS node_level
FROM variance v LEFT JOIN cost_center cc ON cc.cost_center = v.cost_center
GROUP BY ROLLUP (v.company_code, cc.division_id, cc.department_id, v.cost_center)
""")
def q_rollup(ctx: Ctx) -> DataFrame:
    """AG16 — variance on every cost-centre hierarchy node."""
    return money_cols(kpis.variance_hierarchy_rollup(ctx.variance, ctx.L.cost_center),
                      "actual_amount", "budget_amount", "variance")


def _node_levels(facts: str, measures: list[str], levels: list[tuple[str, str, int]]) -> str:
    """Oracle of node sums: one grouping a level.  ``levels``: (node column, parent expression, depth)."""
    sums = ", ".join(f"{M(f'sum(f.{m})')} AS {m}" for m in measures)
    return " UNION ALL ".join(f"""SELECT n.node AS node_id, n.parent AS parent_id, {depth} AS depth, {str(depth == len(levels) - 1).upper()} AS is_leaf, {sums}
      FROM (SELECT DISTINCT {node} AS node, {parent} AS parent FROM h) n LEFT JOIN ({facts}) f ON f.{node} = n.node GROUP BY n.node, n.parent"""
                              for node, parent, depth in levels)


@register("variance_node_rollup", _VARIANCE_CTE + """
, h AS (SELECT company_code AS n0, division_id AS n1, department_id AS n2, cost_center AS n3 FROM cost_center),
f AS (SELECT h.*, v.actual_amount, v.budget_amount, v.variance FROM variance v JOIN h ON h.n3 = v.cost_center)
""" + _node_levels("SELECT * FROM f", ["actual_amount", "budget_amount", "variance"],
                   [("n0", "CAST(NULL AS VARCHAR)", 0), ("n1", "n0", 1), ("n2", "n1", 2), ("n3", "n2", 3)]))
def q_node_rollup(ctx: Ctx) -> DataFrame:
    """AG16 — variance on every node of the parent-child table of cost centres, walked along its parent ids."""
    tree = hierarchy.walk(hierarchy.cost_center_nodes(ctx.L.cost_center))
    measures = ["actual_amount", "budget_amount", "variance"]
    return money_cols(hierarchy.node_sums(ctx.variance, "cost_center", measures, tree), *measures)


@register("pl_node_rollup", """
, h AS (SELECT 'P&L' AS n0, pl_section AS n1, account_group AS n2, gl_account AS n3 FROM gl_account),
f AS (SELECT h.*, j.signed_amount_group FROM v_journal j JOIN h ON h.n3 = j.gl_account)
""" + _node_levels("SELECT * FROM f", ["signed_amount_group"],
                   [("n0", "CAST(NULL AS VARCHAR)", 0), ("n1", "n0", 1), ("n2", "n1", 2), ("n3", "n2", 3)]))
def q_pl_nodes(ctx: Ctx) -> DataFrame:
    """AG16 — the P&L on every node of the account hierarchy (account, group, section, total)."""
    tree = hierarchy.walk(hierarchy.account_nodes(ctx.L.gl_account))
    return money_cols(hierarchy.node_sums(ctx.vj, "gl_account", ["signed_amount_group"], tree), "signed_amount_group")


@register("qc_hierarchy", """
, n AS (SELECT DISTINCT cost_center AS node, parent_id AS parent FROM cost_center
        UNION SELECT department_id, division_id FROM cost_center UNION SELECT division_id, company_code FROM cost_center
        UNION SELECT company_code, NULL FROM cost_center),
reached AS (SELECT DISTINCT a.node FROM n a LEFT JOIN n b ON b.node = a.parent LEFT JOIN n c ON c.node = b.parent
            LEFT JOIN n d ON d.node = c.parent WHERE a.parent IS NULL OR b.parent IS NULL OR c.parent IS NULL OR d.parent IS NULL)
SELECT 'hierarchy_' || fault AS rule, 'cost_center' AS table_name, (SELECT count(DISTINCT node) FROM n) AS rows_checked, CAST(v AS BIGINT) AS violations
FROM (SELECT 'two_parents' AS fault, (SELECT count(*) FROM (SELECT node FROM n GROUP BY node HAVING count(DISTINCT parent) > 1)) AS v
      UNION ALL SELECT 'missing_parent', (SELECT count(DISTINCT node) FROM n WHERE parent IS NOT NULL AND parent NOT IN (SELECT node FROM n))
      UNION ALL SELECT 'cycle', (SELECT count(DISTINCT node) FROM n WHERE node NOT IN (SELECT node FROM reached))
      UNION ALL SELECT 'below_cycle', 0)
""")
def q_qc_hierarchy(ctx: Ctx) -> DataFrame:
    """AG16 — nodes on or below a cycle, with two parents or with a parent that does not exist."""
    nodes = hierarchy.cost_center_nodes(ctx.L.cost_center)
    faults = hierarchy.hierarchy_faults(nodes, hierarchy.walk(nodes))
    return quality.hierarchy_rules(nodes, faults)


@register("qc_pseudonym_exposure", _VARIANCE_CTE + _TASKS_H_CTE + f"""
, counted AS (
  SELECT 'api_budget_variance' AS view_name, count(*) AS n FROM variance
  UNION ALL SELECT 'api_close_monitor', count(*) FROM close_monitor
  UNION ALL SELECT 'api_pl_actuals', count(*) FROM ({_PL_SQL})
  UNION ALL SELECT 'api_ic_reconciliation', count(*) FROM (SELECT 1 FROM v_journal WHERE is_intercompany GROUP BY ic_pair, fiscal_year, reporting_period)
  UNION ALL SELECT 'api_programme_burn', count(*)
            FROM (SELECT DISTINCT programme_id FROM v_journal WHERE programme_id IS NOT NULL AND fiscal_period <= 12
                  AND fiscal_year * 100 + fiscal_period <= {config.AS_OF_YEAR * 100 + config.AS_OF_PERIOD})
  UNION ALL SELECT 'journal_interface', count(*) FROM journal
  UNION ALL SELECT 'md_cost_center', count(*) FROM cost_center
  UNION ALL SELECT 'planted_clerk', count(*) FROM journal
), leaks AS (
  SELECT count(*) FILTER (WHERE regexp_matches(posting_user_id, '^USR-[0-9A-F]{{6}}$')) > 0 AS shown FROM journal
)
SELECT c.view_name, c.n AS rows_checked, c.view_name LIKE 'planted%' AS planted,
       CASE WHEN c.view_name LIKE 'planted%' THEN 2 ELSE 0 END AS columns_by_lineage,
       CAST(CASE WHEN c.view_name LIKE 'planted%' AND l.shown THEN 1 ELSE 0 END AS BIGINT) AS columns_with_tokens,
       c.view_name NOT LIKE 'planted%' AS passed
FROM counted c, leaks l
""")
def q_exposure(ctx: Ctx) -> DataFrame:
    """QC20/PF10 — user columns that a published view shows by lineage or by value, over all views and one with a planted leak."""
    L = ctx.L
    planted = L.journal.select("company_code", F.col("posting_user_id").alias("clerk"), "amount_group_currency",
                               F.concat(F.lit("by "), F.col("posting_user_id")).alias("remark"))
    views = {
        "api_budget_variance": publish.api_budget_variance(ctx.variance, L.company, L.cost_center, L.programme_master, L.gl_account),
        "api_close_monitor": publish.api_close_monitor(kpis.close_monitor(ctx.tasks_h, ctx.vj), L.company),
        "api_pl_actuals": publish.api_pl_actuals(kpis.pl_actuals(ctx.vj)),
        "api_ic_reconciliation": publish.api_ic_reconciliation(ctx.ic),
        "api_programme_burn": publish.api_programme_burn(kpis.programme_burn(ctx.runrate(), config.AS_OF_DATE)),
        "journal_interface": publish.journal_interface(L.journal, L.company, L.gl_account, L.cost_center, L.programme_master),
        "md_cost_center": publish.drop_user_columns(L.cost_center),
        "planted_clerk": planted,
    }
    return lineage.exposure(views).select(
        "view_name", "rows_checked", F.col("view_name").startswith("planted").alias("planted"),
        F.col("columns_by_lineage").cast("int").alias("columns_by_lineage"), "columns_with_tokens", "passed")


@register("qc_raw_lines", """
, raw AS (
  SELECT s.s_suppkey IS NULL AS no_s, p.p_partkey IS NULL AS no_p, o.o_orderkey IS NULL AS no_o, o.o_orderkey IS NOT NULL AND c.c_custkey IS NULL AS no_c
  FROM lineitem l
  LEFT JOIN (SELECT DISTINCT s_suppkey FROM supplier WHERE s_nationkey IN (SELECT n_nationkey FROM nation)) s ON s.s_suppkey = l.l_suppkey
  LEFT JOIN (SELECT DISTINCT p_partkey FROM part) p ON p.p_partkey = l.l_partkey
  LEFT JOIN (SELECT o_orderkey, max(o_custkey) AS o_custkey FROM orders GROUP BY o_orderkey) o ON o.o_orderkey = l.l_orderkey
  LEFT JOIN (SELECT DISTINCT c_custkey FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM nation)) c ON c.c_custkey = o.o_custkey
)
SELECT unnest(['raw_line_supplier', 'raw_line_part', 'raw_line_order', 'raw_line_customer', 'raw_line_dropped']) AS rule, 'lineitem' AS table_name,
       count(*) AS rows_checked,
       unnest([count(*) FILTER (WHERE no_s), count(*) FILTER (WHERE no_p), count(*) FILTER (WHERE no_o), count(*) FILTER (WHERE no_c),
               count(*) FILTER (WHERE no_s OR no_p OR no_o OR no_c)]) AS violations
FROM raw
""")
def q_qc_raw(ctx: Ctx) -> DataFrame:
    """QC4/JN14 — orphans among the raw lines, before the journal's inner joins drop them."""
    L = ctx.L
    return quality.raw_line_rules(*[L.driver_table(t) for t in ("lineitem", "orders", "customer", "supplier", "part", "nation")])


@register("programme_runrate_function", _runrate_sql(config.AS_OF_YEAR, config.AS_OF_PERIOD, config.RUNRATE_WINDOW))
def q_runrate_function(ctx: Ctx) -> DataFrame:
    """KP10, SURVEY 2.20 — the run-rate as an SQL table function of year, period and window."""
    import uuid

    name = sql_functions.register_runrate(ctx.spark, ctx.vj, ctx.L.programme, f"tf_programme_runrate_{uuid.uuid4().hex[:8]}")
    return _runrate_out(sql_functions.runrate(ctx.spark, name))


@register("close_slippage_alerts", """
, ev AS (SELECT greatest(max(period_end_date), max(actual_completion_date)) AS hi FROM close_tasks),
late AS (
  SELECT t.*, t.due_date + 1 AS due_end FROM close_tasks t, ev
  WHERE t.actual_completion_date >= t.due_date + 1 OR (t.actual_completion_date IS NULL AND t.due_date + 1 < ev.hi)
)
SELECT close_task_id, company_code, fiscal_year, fiscal_period, task_id, 'overdue' AS alert, due_date, CAST(due_end AS TIMESTAMP) AS alert_time, 0 AS days_late
FROM late
UNION ALL
SELECT close_task_id, company_code, fiscal_year, fiscal_period, task_id, 'completed_late', due_date, CAST(actual_completion_date AS TIMESTAMP),
       CAST(actual_completion_date - due_date AS INTEGER)
FROM late WHERE actual_completion_date IS NOT NULL
""")
def q_alerts(ctx: Ctx) -> DataFrame:
    """SURVEY 2.21 — alerts of a stateful stream over the events of all close tasks."""
    import uuid

    from ..session import ensure_checkpoint_dir
    from ..streaming import alerts

    root = f"{ensure_checkpoint_dir(ctx.spark).rstrip('/')}/alerts-{uuid.uuid4().hex}"
    alerts.close_events(ctx.L.close_tasks).write.parquet(f"{root}/events")
    stream = ctx.spark.readStream.schema(alerts.EVENTS).parquet(f"{root}/events")
    alerts.start_alerts(stream, f"{root}/alerts", f"{root}/checkpoint", "0 seconds").awaitTermination()
    return ctx.spark.read.parquet(f"{root}/alerts")


# ======================================================================== KPI digests
@register("kpi_entity_summary", _TASKS_H_CTE + """
, per AS (
  SELECT m.company_code, m.fiscal_year, m.fiscal_period, m.manual_share, m.late_share, m.days_to_close
  FROM close_monitor m WHERE m.task_id = 'T12' AND m.days_to_close IS NOT NULL
)
SELECT company_code, avg(days_to_close) AS avg_days_to_close, round(avg(manual_share), 9) AS mean_manual_share,
       round(avg(late_share), 9) AS mean_late_share, count(*) AS closed_periods
FROM per GROUP BY company_code
""")
def q_entity_summary(ctx: Ctx) -> DataFrame:
    """AG10 — unweighted mean of per-period shares over closed periods, per entity (D7)."""
    m = kpis.close_monitor(ctx.tasks_h, ctx.vj).where(
        (F.col("task_id") == config.HARD_CLOSE_TASK) & F.col("days_to_close").isNotNull())
    out = m.groupBy("company_code").agg(
        F.avg("days_to_close").alias("avg_days_to_close"), F.avg("manual_share").alias("mean_manual_share"),
        F.avg("late_share").alias("mean_late_share"), F.count(F.lit(1)).alias("closed_periods"))
    return out.withColumn("mean_manual_share", F.round("mean_manual_share", 9)) \
        .withColumn("mean_late_share", F.round("mean_late_share", 9))


@register("kpi_tiles", _TASKS_H_CTE + runrate_cte(config.AS_OF_YEAR, config.AS_OF_PERIOD, config.RUNRATE_WINDOW) + f"""
, rr2 AS (SELECT programme_id, programme_name, {sql_exact_ratio(EAC_SQL, 'total_budget_eur', 4)} AS eac_pct, {M(EAC_SQL)} AS eac
         FROM rr),
closed AS (
  SELECT CAST(sum(CASE WHEN j.is_manual_posting THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS share
  FROM tasks_h t JOIN v_journal j ON j.company_code = t.company_code AND j.fiscal_year = t.fiscal_year
                                 AND j.reporting_period = t.fiscal_period
  WHERE t.task_id = 'T12' AND t.days_to_close IS NOT NULL
  GROUP BY t.company_code, t.fiscal_year, t.fiscal_period
),
ent AS (SELECT company_code, avg(days_to_close) AS d FROM tasks_h WHERE task_id = 'T12' GROUP BY company_code),
ic AS (SELECT sum(signed_amount_group) AS net FROM v_journal WHERE is_intercompany
       GROUP BY ic_pair, fiscal_year, reporting_period)
SELECT 'avg_days_to_close' AS tile, avg(days_to_close) AS value, CAST(NULL AS VARCHAR) AS label
FROM tasks_h WHERE task_id = 'T12'
UNION ALL
SELECT 'slowest_entity', max(d), arg_max(company_code, d) FROM ent
UNION ALL
SELECT 'manual_share', CAST(sum(CASE WHEN is_manual_posting THEN 1 ELSE 0 END) AS DOUBLE) / count(*), NULL
FROM v_journal WHERE fiscal_period <= 12
UNION ALL
SELECT 'late_share', CAST(sum(CASE WHEN is_late_posting THEN 1 ELSE 0 END) AS DOUBLE) / count(*), NULL
FROM v_journal WHERE fiscal_period <= 12
UNION ALL
SELECT 'programmes_over_budget', CAST(sum(CASE WHEN eac_pct > 1 THEN 1 ELSE 0 END) AS DOUBLE), NULL FROM rr2
UNION ALL
SELECT 'programmes', CAST(count(*) AS DOUBLE), NULL FROM rr2
UNION ALL
SELECT 'worst_programme', max(eac_pct), arg_max(programme_name, eac_pct) FROM rr2
UNION ALL
SELECT 'worst_programme_eac', arg_max(eac, eac_pct), arg_max(programme_id, eac_pct) FROM rr2
UNION ALL
SELECT 'mean_period_manual_share', round(avg(share), 9), NULL FROM closed
UNION ALL
SELECT 'open_ic_items', CAST(sum(CASE WHEN abs(net) > 1000 THEN 1 ELSE 0 END) AS DOUBLE), NULL FROM ic
UNION ALL
SELECT 'open_periods', CAST(sum(CASE WHEN is_open THEN 1 ELSE 0 END) AS DOUBLE), NULL FROM tasks_h WHERE task_id = 'T12'
""")
def q_kpi_tiles(ctx: Ctx) -> DataFrame:
    """KP20 — one tile per headline figure (average days, slowest entity, worst programme, shares, counts); one pass a source."""
    hard = kpis.days_to_close(ctx.tasks_h)
    ent = hard.groupBy("company_code").agg(F.avg("days_to_close").alias("d"), F.sum("days_to_close").alias("days"),
                                           F.count("days_to_close").alias("n"), F.sum(F.col("is_open").cast("long")).alias("open"))
    close = ent.agg(ratio(F.sum("days"), F.sum("n")).alias("v0"), F.max("d").alias("v1"), F.max_by("company_code", "d").alias("l1"),
                    F.sum("open").cast("double").alias("v2"))
    eac = "eac_vs_budget_pct"
    rr = ctx.runrate().agg(
        F.sum((F.col(eac) > 1).cast("long")).cast("double").alias("v0"), F.count(F.lit(1)).cast("double").alias("v1"),
        F.max(eac).alias("v2"), F.max_by("programme_name", eac).alias("l2"),
        money(F.max_by("eac", eac)).alias("v3"), F.max_by("programme_id", eac).alias("l3"))
    period = ["company_code", "fiscal_year", "fiscal_period"]
    regular = (F.col("__fp") <= 12).cast("long")
    lines = ctx.vj.withColumn("__fp", F.col("fiscal_period")).groupBy("company_code", "fiscal_year", F.col("reporting_period").alias("fiscal_period")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("is_manual_posting").cast("long")).alias("manual"), F.sum(regular).alias("reg"),
        F.sum(F.col("is_manual_posting").cast("long") * regular).alias("reg_manual"),
        F.sum(F.col("is_late_posting").cast("long") * regular).alias("reg_late"))
    shares = lines.join(hard, period, "left").agg(
        ratio(F.sum("reg_manual"), F.sum("reg")).alias("v0"), ratio(F.sum("reg_late"), F.sum("reg")).alias("v1"),
        F.round(F.avg(F.when(F.col("days_to_close").isNotNull(), ratio("manual", "n"))), 9).alias("v2"))
    items = ctx.ic.agg(F.sum(F.col("is_mismatch").cast("long")).cast("double").alias("v0"))
    return reduce(DataFrame.unionByName, [
        _tiles(close, [("avg_days_to_close", "v0", None), ("slowest_entity", "v1", "l1"), ("open_periods", "v2", None)]),
        _tiles(shares, [("manual_share", "v0", None), ("late_share", "v1", None), ("mean_period_manual_share", "v2", None)]),
        _tiles(rr, [("programmes_over_budget", "v0", None), ("programmes", "v1", None), ("worst_programme", "v2", "l2"),
                    ("worst_programme_eac", "v3", "l3")]),
        _tiles(items, [("open_ic_items", "v0", None)])])


def _tiles(row: DataFrame, tiles: list[tuple[str, str, str | None]]) -> DataFrame:
    """One aggregated row as (tile, value, label) rows."""
    each = [F.struct(F.lit(name).alias("tile"), F.col(value).cast("double").alias("value"),
                     (F.col(label) if label else F.lit(None)).cast("string").alias("label")) for name, value, label in tiles]
    return row.select(F.explode(F.array(*each)).alias("t")).select("t.*")


@register("group_financials", """
SELECT {rev} AS revenue, {cost} AS cost, {rev_m} AS margin,
       CAST(round(-sum(CASE WHEN account_group = 'REV' THEN signed_amount_group ELSE 0 END), 2) AS DOUBLE)
         / count(DISTINCT fiscal_year) AS revenue_per_year,
       CAST(count(*) AS DOUBLE) / count(DISTINCT fiscal_year * 100 + fiscal_period) AS lines_per_month
FROM v_journal WHERE fiscal_period <= 12
""".format(
    rev=M("-sum(CASE WHEN account_group = 'REV' THEN signed_amount_group ELSE 0 END)"),
    cost=M("sum(CASE WHEN account_group <> 'REV' THEN signed_amount_group ELSE 0 END)"),
    rev_m=M("-sum(signed_amount_group)")))
def q_group_financials(ctx: Ctx) -> DataFrame:
    """AG18 — revenue, cost, margin, revenue per year and lines per month (regular periods)."""
    signed = F.col("signed_amount_group")
    periods = ctx.vj.where(F.col("fiscal_period") <= 12).groupBy("fiscal_year", "fiscal_period").agg(
        F.sum(F.when(F.col("account_group") == "REV", -signed).otherwise(0)).alias("rev"),
        F.sum(F.when(F.col("account_group") != "REV", signed).otherwise(0)).alias("cost"), F.sum(-signed).alias("margin"),
        F.count(F.lit(1)).alias("n"))
    # one row a period from here on, so the distinct counts are counts of few rows
    years = periods.groupBy("fiscal_year").agg(*[F.sum(c).alias(c) for c in ("rev", "cost", "margin", "n")], F.count(F.lit(1)).alias("periods"))
    return years.agg(
        money(F.sum("rev")).alias("revenue"), money(F.sum("cost")).alias("cost"), money(F.sum("margin")).alias("margin"),
        (F.round(F.sum("rev"), 2).cast("double") / F.count(F.lit(1))).alias("revenue_per_year"),
        (F.sum("n").cast("double") / F.sum("periods")).alias("lines_per_month"))


@register("special_period_profile", """
SELECT count(*) FILTER (WHERE fiscal_period > 12) AS special_lines,
       CAST(count(*) FILTER (WHERE fiscal_period > 12) AS DOUBLE) / count(*) AS special_share,
       string_agg(DISTINCT CAST(fiscal_year AS VARCHAR), ',' ORDER BY CAST(fiscal_year AS VARCHAR))
         FILTER (WHERE fiscal_period > 12) AS special_years,
       string_agg(DISTINCT document_type, ',' ORDER BY document_type) FILTER (WHERE fiscal_period > 12) AS document_types
FROM journal
""")
def q_special_profile(ctx: Ctx) -> DataFrame:
    """AG19 — special-period line count, share, years and document types."""
    j = ctx.L.journal
    sp = F.col("fiscal_period") > 12
    return j.agg(
        F.sum(sp.cast("long")).alias("special_lines"),
        (F.sum(sp.cast("long")).cast("double") / F.count(F.lit(1))).alias("special_share"),
        F.array_join(F.array_sort(F.collect_set(F.when(sp, F.col("fiscal_year").cast("string")))), ",")
        .alias("special_years"),
        F.array_join(F.array_sort(F.collect_set(F.when(sp, F.col("document_type")))), ",").alias("document_types"),
    )


# ======================================================================== reconciliation
# The oracle builds the aggregate itself, serves each view from it and computes what differs.
_RC_VIEWS = {
    # view: (base, from the aggregate, keys, {check: column})
    "pl": ("""SELECT company_code, company_name, fiscal_year, reporting_period AS fiscal_period, pl_section, account_group, account_group_name,
                     sum(signed_amount_group) AS amount, sum(CASE WHEN is_manual_posting THEN signed_amount_group ELSE 0 END) AS manual,
                     count(*) AS lines, count(*) FILTER (WHERE is_manual_posting) AS manual_lines,
                     count(*) FILTER (WHERE is_late_posting) AS late_lines, count(*) FILTER (WHERE fiscal_period > 12) AS special_lines
              FROM v_journal GROUP BY ALL""",
           """SELECT a.company_code, co.company_name, a.fiscal_year, a.fiscal_period, a.pl_section, a.account_group, g.account_group_name,
                     sum(a.amount) AS amount, sum(a.manual) AS manual, sum(a.lines) AS lines, sum(a.manual_lines) AS manual_lines,
                     sum(a.late_lines) AS late_lines, sum(CASE WHEN a.is_special THEN a.lines ELSE 0 END) AS special_lines
              FROM agg0 a JOIN company co ON co.company_code = a.company_code
              LEFT JOIN (SELECT DISTINCT account_group, account_group_name FROM gl_account) g ON g.account_group = a.account_group GROUP BY ALL""",
           ["company_code", "company_name", "fiscal_year", "fiscal_period", "pl_section", "account_group", "account_group_name"],
           {"pl_actuals": "amount", "pl_amount_manual": "manual", "pl_line_count": "lines", "pl_line_count_manual": "manual_lines",
            "pl_line_count_late": "late_lines", "pl_line_count_year_end": "special_lines"}),
    "fx": ("""SELECT company_code, company_name, local_currency, fiscal_year, reporting_period AS fiscal_period, account_group,
                     sum(signed_amount_group) AS amount, sum(signed_amount_at_actual_rate) AS actual, sum(signed_amount_at_budget_rate) AS budget,
                     sum(signed_amount_at_actual_rate) - sum(signed_amount_at_budget_rate) AS impact, sum(amount_local_currency * rate_budget) AS gross
              FROM v_journal GROUP BY ALL""",
           """SELECT a.company_code, co.company_name, a.local_currency, a.fiscal_year, a.fiscal_period, a.account_group, sum(a.amount) AS amount,
                     sum(a.actual) AS actual, sum(a.budget) AS budget, sum(a.actual) - sum(a.budget) AS impact, sum(a.gross) AS gross
              FROM agg0 a JOIN company co ON co.company_code = a.company_code GROUP BY ALL""",
           ["company_code", "company_name", "local_currency", "fiscal_year", "fiscal_period", "account_group"],
           {"fx_impact": "impact", "fx_amount_booked": "amount", "fx_at_actual_rate": "actual", "fx_at_budget_rate": "budget",
            "fx_gross_at_budget_rate": "gross"}),
    "var": ("SELECT company_code, fiscal_year, fiscal_period, cost_center, account_group, programme_id, actual_amount, budget_amount, variance FROM variance",
            """SELECT coalesce(a.company_code, b.company_code) AS company_code, coalesce(a.fiscal_year, b.fiscal_year) AS fiscal_year,
                      coalesce(a.fiscal_period, b.fiscal_period) AS fiscal_period, coalesce(a.cost_center, b.cost_center) AS cost_center,
                      coalesce(a.account_group, b.account_group) AS account_group, coalesce(a.programme_key, b.programme_key) AS programme_id,
                      coalesce(a.amount, 0) AS actual_amount, coalesce(b.budget_amount, 0) AS budget_amount,
                      coalesce(a.amount, 0) - coalesce(b.budget_amount, 0) AS variance
               FROM (SELECT company_code, fiscal_year, fiscal_period, cost_center, account_group, coalesce(programme_id, '(none)') AS programme_key,
                            sum(amount) AS amount FROM agg0 WHERE NOT is_special AND cost_center IS NOT NULL GROUP BY ALL) a
               FULL OUTER JOIN bud_cells b ON a.company_code = b.company_code AND a.fiscal_year = b.fiscal_year AND a.fiscal_period = b.fiscal_period
                AND a.cost_center = b.cost_center AND a.account_group = b.account_group AND a.programme_key = b.programme_key""",
            ["company_code", "fiscal_year", "fiscal_period", "cost_center", "account_group", "programme_id"],
            {"budget_variance": "variance", "variance_actual": "actual_amount", "variance_budget": "budget_amount"}),
    "prog": ("""SELECT programme_id, fiscal_year * 100 + fiscal_period AS period_key, sum(signed_amount_group) AS cost
                FROM v_journal WHERE programme_id IS NOT NULL AND fiscal_period <= 12 GROUP BY ALL""",
             """SELECT programme_id, fiscal_year * 100 + fiscal_period AS period_key, sum(amount) AS cost
                FROM agg0 WHERE programme_id IS NOT NULL AND NOT is_special GROUP BY ALL""",
             ["programme_id", "period_key"], {"programme_monthly_cost": "cost"}),
    "share": ("""SELECT company_code, fiscal_year, reporting_period AS fiscal_period, count(*) AS lines,
                        count(*) FILTER (WHERE is_manual_posting) AS manual_lines,
                        sum(CASE WHEN is_manual_posting THEN signed_amount_group ELSE 0 END) AS manual,
                        count(*) FILTER (WHERE is_late_posting) AS late_lines
                 FROM v_journal GROUP BY ALL""",
              """SELECT company_code, fiscal_year, fiscal_period, sum(lines) AS lines, sum(manual_lines) AS manual_lines, sum(manual) AS manual,
                        sum(late_lines) AS late_lines FROM agg0 GROUP BY ALL""",
              ["company_code", "fiscal_year", "fiscal_period"],
              {"share_line_count": "lines", "share_manual_count": "manual_lines", "share_amount_manual": "manual", "share_late_count": "late_lines"}),
    "fc": ("""SELECT company_code, cost_center, programme_key, fiscal_year, fiscal_period, actual FROM fc_base""",
           """SELECT company_code, cost_center, coalesce(programme_id, '(none)') AS programme_key, fiscal_year, fiscal_period, sum(amount) AS actual
              FROM agg0 WHERE NOT is_special AND cost_center IS NOT NULL GROUP BY ALL""",
           ["company_code", "cost_center", "programme_key", "fiscal_year", "fiscal_period"], {"forecast_actuals": "actual"}),
}


def _rc_sql() -> str:
    ctes, checks = [], []
    for view, (base, served, keys, measures) in _RC_VIEWS.items():
        on = " AND ".join(f"b.{k} IS NOT DISTINCT FROM s.{k}" for k in keys)
        deltas = ", ".join(f"abs(b.{c} - s.{c}) AS d_{c}" for c in measures.values())
        ctes.append(f"{view}_b AS ({base}), {view}_s AS ({served}), {view}_j AS (SELECT b.here AS in_b, s.here AS in_s, {deltas} "
                    f"FROM (SELECT *, TRUE AS here FROM {view}_b) b FULL OUTER JOIN (SELECT *, TRUE AS here FROM {view}_s) s ON {on})")
        for check, c in measures.items():
            checks.append(f"""SELECT '{check}' AS check_name, count(*) FILTER (WHERE in_b AND in_s) AS rows_compared,
              count(*) FILTER (WHERE in_b IS NULL) AS missing_left, count(*) FILTER (WHERE in_s IS NULL) AS missing_right,
              CAST(coalesce(max(d_{c}), 0) AS DOUBLE) AS max_abs_delta,
              count(*) FILTER (WHERE in_b IS NULL OR in_s IS NULL) = 0 AND coalesce(max(d_{c}), 0) = 0 AS passed FROM {view}_j""")
    agg = """, agg0 AS (
  SELECT company_code, fiscal_year, reporting_period AS fiscal_period, account_group, pl_section, programme_id, cost_center,
         fiscal_period > 12 AS is_special, local_currency, sum(signed_amount_group) AS amount,
         sum(CASE WHEN is_manual_posting THEN signed_amount_group ELSE 0 END) AS manual, sum(signed_amount_at_actual_rate) AS actual,
         sum(signed_amount_at_budget_rate) AS budget, sum(amount_local_currency * rate_budget) AS gross, count(*) AS lines,
         count(*) FILTER (WHERE is_manual_posting) AS manual_lines, count(*) FILTER (WHERE is_late_posting) AS late_lines
  FROM v_journal GROUP BY ALL
), fc_base AS (
  SELECT company_code, cost_center, coalesce(programme_id, '(none)') AS programme_key, fiscal_year, fiscal_period, sum(signed_amount_group) AS actual
  FROM v_journal WHERE fiscal_period <= 12 AND cost_center IS NOT NULL GROUP BY ALL
), """
    return _VARIANCE_CTE + agg + ", ".join(ctes) + " " + " UNION ALL ".join(checks)


@register("reconcile_agg_vs_base", _rc_sql())
def q_reconcile(ctx: Ctx) -> DataFrame:
    """RC1/RC2 — what the aggregate serves of six KPIs equals the base views at their grains (20 measures), by digests of key ranges."""
    L = ctx.L

    def checks(view: str, base: DataFrame, served: DataFrame, columns: list[str]) -> DataFrame:
        return reconcile.reconcile_measures(base, served, _RC_VIEWS[view][2], dict(zip(_RC_VIEWS[view][3], columns, strict=True)))

    vj, regular = ctx.vj, F.col("fiscal_period") <= 12
    monthly = vj.where(F.col("programme_id").isNotNull() & regular).groupBy(
        "programme_id", period_key().alias("period_key")).agg(F.sum("signed_amount_group").alias("period_cost"))
    shares = vj.groupBy("company_code", "fiscal_year", F.col("reporting_period").alias("fiscal_period")).agg(
        F.count(F.lit(1)).alias("line_count"), F.sum(F.col("is_manual_posting").cast("long")).alias("line_count_manual"),
        F.sum(F.when(F.col("is_manual_posting"), F.col("signed_amount_group")).otherwise(0)).alias("amount_manual"),
        F.sum(F.col("is_late_posting").cast("long")).alias("line_count_late"))
    return reduce(DataFrame.unionByName, [
        checks("pl", kpis.pl_actuals(vj), materialise.pl_actuals_from_agg(ctx.agg, L.company, L.gl_account),
               ["amount_group_currency", "amount_manual", "line_count", "line_count_manual", "line_count_late", "line_count_year_end_adjustment"]),
        checks("fx", kpis.fx_impact(vj), materialise.fx_impact_from_agg(ctx.agg, L.company),
               ["fx_impact", "amount_group_booked", "amount_at_actual_rate", "amount_at_budget_rate", "gross_at_budget_rate"]),
        checks("var", ctx.variance, materialise.budget_variance_from_agg(ctx.agg, ctx.budget_cells), ["variance", "actual_amount", "budget_amount"]),
        checks("prog", monthly, materialise.programme_monthly_from_agg(ctx.agg), ["period_cost"]),
        checks("share", shares, materialise.shares_from_agg(ctx.agg), ["line_count", "line_count_manual", "amount_manual", "line_count_late"]),
        checks("fc", kpis.forecast_actuals(vj), materialise.forecast_actuals_from_agg(ctx.agg), ["actual"])])


@register("published_views_nonempty", _VARIANCE_CTE + _TASKS_H_CTE + f"""
SELECT 'api_budget_variance' AS view_name, count(*) AS row_count, count(*) > 0 AS nonempty FROM variance
UNION ALL SELECT 'api_close_monitor', count(*), count(*) > 0 FROM close_monitor
UNION ALL SELECT 'api_pl_actuals', count(*), count(*) > 0 FROM ({_PL_SQL})
UNION ALL SELECT 'api_ic_reconciliation', count(*), count(*) > 0
          FROM (SELECT 1 FROM v_journal WHERE is_intercompany GROUP BY ic_pair, fiscal_year, reporting_period)
UNION ALL SELECT 'api_programme_burn', count(*), count(*) > 0
          FROM (SELECT DISTINCT programme_id FROM v_journal WHERE programme_id IS NOT NULL AND fiscal_period <= 12
                AND fiscal_year * 100 + fiscal_period <= {config.AS_OF_YEAR * 100 + config.AS_OF_PERIOD})
""")
def q_views_nonempty(ctx: Ctx) -> DataFrame:
    """RC3 — every published view resolves and returns rows."""
    L = ctx.L
    views = {
        "api_budget_variance": publish.api_budget_variance(ctx.variance, L.company, L.cost_center, L.programme_master,
                                                           L.gl_account),
        "api_close_monitor": publish.api_close_monitor(kpis.close_monitor(ctx.tasks_h, ctx.vj), L.company),
        "api_pl_actuals": publish.api_pl_actuals(kpis.pl_actuals(ctx.vj)),
        "api_ic_reconciliation": publish.api_ic_reconciliation(ctx.ic),
        "api_programme_burn": kpis.programme_burn(ctx.runrate(), config.AS_OF_DATE),
    }
    return reconcile.published_views_nonempty(views)


@register("dataset_profile", _TASKS_H_CTE + """
SELECT 'volume' AS section, 'journal_lines' AS metric, CAST(count(*) AS DOUBLE) AS value FROM journal
UNION ALL SELECT 'volume', 'special_period_lines', CAST(count(*) FILTER (WHERE fiscal_period > 12) AS DOUBLE) FROM journal
UNION ALL SELECT 'volume', 'budget_rows', CAST(count(*) AS DOUBLE) FROM budget
UNION ALL SELECT 'volume', 'forecast_rows', CAST(count(*) AS DOUBLE) FROM forecast
UNION ALL SELECT 'volume', 'company_rows', CAST(count(*) AS DOUBLE) FROM company
UNION ALL SELECT 'volume', 'cost_center_rows', CAST(count(*) AS DOUBLE) FROM cost_center
UNION ALL SELECT 'volume', 'gl_account_rows', CAST(count(*) AS DOUBLE) FROM gl_account
UNION ALL SELECT 'volume', 'calendar_days', CAST(count(*) AS DOUBLE) FROM dim_date
UNION ALL SELECT 'volume', 'rate_rows', CAST(count(*) AS DOUBLE) FROM rates
UNION ALL SELECT 'volume', 'reversal_lines', CAST(count(*) FILTER (WHERE is_reversal) AS DOUBLE) FROM journal
UNION ALL SELECT 'kpi', 'avg_days_to_close', avg(days_to_close) FROM tasks_h WHERE task_id = 'T12'
UNION ALL SELECT 'kpi', 'revenue', CAST(round(-sum(CASE WHEN account_group = 'REV' THEN signed_amount_group ELSE 0 END), 2) AS DOUBLE)
          FROM v_journal WHERE fiscal_period <= 12
UNION ALL SELECT 'kpi', 'cost', CAST(round(sum(CASE WHEN account_group <> 'REV' THEN signed_amount_group ELSE 0 END), 2) AS DOUBLE)
          FROM v_journal WHERE fiscal_period <= 12
UNION ALL SELECT 'volume', 'close_task_rows', CAST(count(*) AS DOUBLE) FROM close_tasks
UNION ALL SELECT 'kpi', 'manual_share', CAST(sum(CASE WHEN is_manual_posting THEN 1 ELSE 0 END) AS DOUBLE) / count(*)
          FROM v_journal WHERE fiscal_period <= 12
UNION ALL SELECT 'kpi', 'late_share', CAST(sum(CASE WHEN is_late_posting THEN 1 ELSE 0 END) AS DOUBLE) / count(*)
          FROM v_journal WHERE fiscal_period <= 12
UNION ALL SELECT 'kpi', 'ic_lines', CAST(count(*) FILTER (WHERE is_intercompany) AS DOUBLE) FROM v_journal
""")
def q_dataset_profile(ctx: Ctx) -> DataFrame:
    """RC4 — table volumes and a KPI digest as (section, metric, value) rows."""
    L = ctx.L
    names = {"journal": "journal_lines", "budget": "budget_rows", "forecast": "forecast_rows", "close_tasks": "close_task_rows",
             "company": "company_rows", "cost_center": "cost_center_rows", "gl_account": "gl_account_rows", "dim_date": "calendar_days",
             "rates": "rate_rows"}
    metric = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    volumes = L.row_counts().where(F.col("table_name").isin(list(names))).select(
        F.lit("volume").alias("section"), metric[F.col("table_name")].alias("metric"), F.col("row_count").cast("double").alias("value"))
    regular = F.col("fiscal_period") <= 12
    signed, count = F.when(regular, F.col("signed_amount_group")), F.sum(regular.cast("long"))
    parts = [
        volumes,
        reconcile.profile_rows("volume", L.journal, {
            "special_period_lines": F.sum((F.col("fiscal_period") > 12).cast("long")),
            "reversal_lines": F.sum(F.col("is_reversal").cast("long"))}),
        reconcile.profile_rows("kpi", kpis.days_to_close(ctx.tasks_h), {"avg_days_to_close": F.avg("days_to_close")}),
        reconcile.profile_rows("kpi", ctx.vj, {
            "manual_share": F.sum((F.col("is_manual_posting") & regular).cast("long")) / count,
            "late_share": F.sum((F.col("is_late_posting") & regular).cast("long")) / count,
            "revenue": F.round(-F.sum(F.when(F.col("account_group") == "REV", signed).otherwise(0)), 2),
            "cost": F.round(F.sum(F.when(F.col("account_group") != "REV", signed).otherwise(0)), 2),
            "ic_lines": F.sum(F.col("is_intercompany").cast("long"))}),
    ]
    return reduce(DataFrame.unionByName, parts)


# ======================================================================== slicing
@register("slice_dice_variance", _VARIANCE_CTE + f"""
SELECT company_code, programme_id, {M('sum(actual_amount)')} AS actual, {M('sum(budget_amount)')} AS budget,
       {M('sum(variance)')} AS variance
FROM variance WHERE fiscal_year = 2000 GROUP BY company_code, programme_id
ORDER BY sum(variance) DESC, company_code, programme_id LIMIT 10 OFFSET 2
""")
def q_slice_dice(ctx: Ctx) -> DataFrame:
    """QY1 — filter, group, aggregate, order, skip 2, top 10 over the variance view."""
    out = slicing.slice_dice(
        ctx.variance, filter=F.col("fiscal_year") == 2000, group_by=["company_code", "programme_id"],
        measures=[("actual", "sum", "actual_amount"), ("budget", "sum", "budget_amount"),
                  ("variance", "sum", "variance")],
        order_by=[F.col("variance").desc()], top=10, skip=2)
    return money_cols(out, "actual", "budget", "variance")


@register("select_filter_close_monitor", _TASKS_H_CTE + """
SELECT company_code, fiscal_year, fiscal_period, task_id, days_to_close, is_open
FROM close_monitor WHERE company_code = 'CO3' AND task_id = 'T12'
""")
def q_select_filter(ctx: Ctx) -> DataFrame:
    """QY2 — $select and $filter on the close monitor."""
    m = kpis.close_monitor(ctx.tasks_h, ctx.vj)
    return slicing.select_columns(slicing.filter_eq(m, company_code="CO3", task_id="T12"),
                                  ["company_code", "fiscal_year", "fiscal_period", "task_id", "days_to_close", "is_open"])


@register("variance_worst_first", _VARIANCE_CTE + f"""
SELECT company_code, fiscal_year, fiscal_period, cost_center, account_group, programme_id,
       {M('variance')} AS variance
FROM variance
ORDER BY variance DESC NULLS LAST, company_code, fiscal_year, fiscal_period, cost_center, account_group, programme_id
LIMIT 25
""")
def q_worst_first(ctx: Ctx) -> DataFrame:
    """TK1 — the 25 largest overruns, worst first."""
    keys = ["company_code", "fiscal_year", "fiscal_period", "cost_center", "account_group", "programme_id"]
    out = slicing.worst_first(ctx.variance.select(*keys, "variance"), "variance", keys, 25)
    return money_cols(out, "variance")


_TOP_CC = _VARIANCE_CTE + f"""
SELECT cost_center, {M('sum(actual_amount)')} AS actual_amount FROM variance WHERE fiscal_year = 2000
GROUP BY cost_center ORDER BY sum(actual_amount) {{dir}}, cost_center LIMIT 5
"""


@register("topcount_cost_centres", _TOP_CC.format(dir="DESC"))
def q_topcount(ctx: Ctx) -> DataFrame:
    """TK2 — five largest cost centres by actual cost in 2000."""
    v = ctx.variance.where(F.col("fiscal_year") == 2000)
    return money_cols(slicing.topcount(v, ["cost_center"], "actual_amount", 5), "actual_amount")


@register("bottomcount_cost_centres", _TOP_CC.format(dir="ASC"))
def q_bottomcount(ctx: Ctx) -> DataFrame:
    """TK2 — five smallest cost centres by actual cost in 2000."""
    v = ctx.variance.where(F.col("fiscal_year") == 2000)
    return money_cols(slicing.topcount(v, ["cost_center"], "actual_amount", 5, largest=False), "actual_amount")


@register("slice_page_close_monitor", _TASKS_H_CTE + """
SELECT company_code, fiscal_year, fiscal_period, task_id, days_to_close, line_count
FROM close_monitor ORDER BY company_code, fiscal_year, fiscal_period, task_id LIMIT 10 OFFSET 20
""")
def q_slice_page(ctx: Ctx) -> DataFrame:
    """TK3 — orderby + skip 20 + top 10 on the close monitor."""
    m = kpis.close_monitor(ctx.tasks_h, ctx.vj).select(
        "company_code", "fiscal_year", "fiscal_period", "task_id", "days_to_close", "line_count")
    return slicing.slice_page(m, ["company_code", "fiscal_year", "fiscal_period", "task_id"], 20, 10)


@register("top_programmes_trend", _PM_CTE + f"""
, top5 AS (SELECT programme_id FROM pm GROUP BY programme_id ORDER BY sum(cost) DESC, programme_id LIMIT 5)
SELECT programme_id, fiscal_year, fiscal_period, {M('sum(cost)')} AS cost
FROM pm WHERE programme_id IN (SELECT programme_id FROM top5) AND fiscal_year = 2000
GROUP BY programme_id, fiscal_year, fiscal_period
""")
def q_top_trend(ctx: Ctx) -> DataFrame:
    """TK5 — monthly cost in 2000 of the five largest programmes."""
    pm = ctx.vj.where(F.col("programme_id").isNotNull() & (F.col("fiscal_period") <= 12)).groupBy(
        "programme_id", "fiscal_year", "fiscal_period").agg(F.sum("signed_amount_group").alias("cost"))
    out = slicing.top_n_trend(pm, "programme_id", "cost", 5, ["fiscal_year", "fiscal_period"])
    return money_cols(out.where(F.col("fiscal_year") == 2000), "cost")


@register("query_concat", _VARIANCE_CTE + f"""
SELECT company_code, CAST(NULL AS VARCHAR) AS programme_id, {M('sum(actual_amount)')} AS actual, 'by_company' AS level
FROM variance WHERE fiscal_year = 2000 GROUP BY company_code
UNION ALL
SELECT CAST(NULL AS VARCHAR), programme_id, {M('sum(actual_amount)')}, 'by_programme'
FROM variance WHERE fiscal_year = 2000 GROUP BY programme_id
""")
def q_concat(ctx: Ctx) -> DataFrame:
    """ST4 — two aggregations of the same set with a level tag, in one pass (grouping sets)."""
    v = ctx.variance.where(F.col("fiscal_year") == 2000)
    out = slicing.query_concat(v, {"by_company": ["company_code"], "by_programme": ["programme_id"]},
                               [("actual", "sum", "actual_amount")])
    return money_cols(out.select("company_code", "programme_id", "actual", "level"), "actual")
