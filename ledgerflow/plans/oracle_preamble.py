"""Independent DuckDB SQL derivation of the demo finance tables.

This is the oracle side of the correctness gate: it is written by hand as SQL
(CTEs over the driver's pre-registered views) and is not generated from the
Spark code.  Every oracle query is ``PREAMBLE`` followed by its own CTEs and
final SELECT.  Money stays DECIMAL until the final projection; divisions that
must round to cents are done in integer cents, rounded half away from zero.
"""

from __future__ import annotations


def half_up(n: str, d: str) -> str:
    """SQL for integer n / d rounded half away from zero (d > 0)."""
    return (f"(CASE WHEN ({n}) >= 0 THEN (2 * ({n}) + ({d})) // (2 * ({d})) "
            f"ELSE -((2 * (-({n})) + ({d})) // (2 * ({d}))) END)")


_MIRROR_LOCAL = half_up(
    "CAST(b.amount_group_currency * 100 AS HUGEINT) * 1000000",
    "CAST(r.exchange_rate * 1000000 AS HUGEINT)",
)

_FORECAST_MEAN = half_up("sum(c)", "count(*)")
_FORECAST_AMOUNT = half_up("base_c * 12 + (pull_c - base_c) * (fp - after)", "12")
BUDGET_CENTS = half_up(
    "CAST(b.total * 100 AS HUGEINT) * 105 * ((year(m.end_date) - year(m.start_date)) * 12 + month(m.end_date)"
    " - month(m.start_date) + 1)", "b.n * 100")

PREAMBLE = f"""
WITH
bounds AS (
  SELECT CAST(min(o_orderdate) AS DATE) AS lo, CAST(max(o_orderdate) AS DATE) AS hi FROM orders
),
years AS (
  SELECT CAST(unnest(generate_series(year(lo), year(hi) + 1)) AS INTEGER) AS y FROM bounds
),
covered AS (
  SELECT CAST(year(m) AS INTEGER) AS fiscal_year, CAST(month(m) AS INTEGER) AS fiscal_period
  FROM (SELECT unnest(generate_series(date_trunc('month', lo), date_trunc('month', hi + 1) - INTERVAL 1 MONTH,
                                      INTERVAL 1 MONTH)) AS m FROM bounds)
),
last_covered AS (
  SELECT max(fiscal_year * 100 + fiscal_period) AS last_key FROM covered
),
span AS (
  SELECT (SELECT min(fiscal_year) FROM covered) AS first_year,
         CASE WHEN last_key % 100 = 12 THEN last_key // 100 + 1 ELSE last_key // 100 END AS open_year,
         CASE WHEN last_key % 100 = 12 THEN 0 ELSE last_key % 100 END AS last_closed
  FROM last_covered
),
-- Easter by search: the first Sunday after the ecclesiastical full moon, whose age in the 30-day
-- cycle follows from the golden number and the century's corrections
moons AS (
  SELECT y, y % 19 + 1 AS golden, 3 * (y // 100 + 1) // 4 - 12 AS solar, (8 * (y // 100 + 1) + 5) // 25 - 5 AS lunar
  FROM years
),
epacts AS (
  SELECT y, golden, (11 * golden + 20 + lunar - solar + 30) % 30 AS e FROM moons
),
full_moons AS (
  SELECT y, CASE WHEN 44 - ee < 21 THEN 74 - ee ELSE 44 - ee END AS march_day
  FROM (SELECT y, CASE WHEN (e = 25 AND golden > 11) OR e = 24 THEN e + 1 ELSE e END AS ee FROM epacts)
),
easter AS (
  SELECT f.y, min(make_date(f.y, 3, 1) + (f.march_day - 1 + k.range)::INTEGER) AS easter_sunday
  FROM full_moons f, range(1, 8) k
  WHERE isodow(make_date(f.y, 3, 1) + (f.march_day - 1 + k.range)::INTEGER) = 7
  GROUP BY f.y
),
holidays AS (
  SELECT make_date(y, m, dd) AS holiday_date
  FROM years, (VALUES (1, 1), (5, 1), (12, 25), (12, 26)) fh(m, dd)
  UNION
  SELECT CAST(easter_sunday + off AS DATE) AS holiday_date
  FROM easter, (VALUES (-2), (1)) eo(off)
),
cal_days AS (
  SELECT CAST(unnest(generate_series(make_date(y, 1, 1), make_date(y, 12, 31), INTERVAL 1 DAY)) AS DATE) AS date_id
  FROM years
),
cal_base AS (
  SELECT d.date_id,
         year(d.date_id) AS calendar_year,
         quarter(d.date_id) AS calendar_quarter,
         month(d.date_id) AS calendar_month,
         day(d.date_id) AS day_of_month,
         isodow(d.date_id) AS day_of_week,
         dayname(d.date_id) AS day_name,
         isodow(d.date_id) >= 6 AS is_weekend,
         (isodow(d.date_id) <= 5 AND h.holiday_date IS NULL) AS is_working_day,
         year(d.date_id) AS fiscal_year,
         month(d.date_id) AS fiscal_period,
         last_day(d.date_id) AS period_end_date
  FROM cal_days d LEFT JOIN holidays h ON h.holiday_date = d.date_id
),
dim_date AS (
  SELECT *,
         CAST(SUM(CASE WHEN is_working_day THEN 1 ELSE 0 END) OVER (
              PARTITION BY fiscal_year, fiscal_period ORDER BY date_id
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS INTEGER)
           AS working_days_after_period_end,
         CAST(CASE WHEN is_working_day THEN SUM(CASE WHEN is_working_day THEN 1 ELSE 0 END) OVER (
              PARTITION BY fiscal_year, fiscal_period ORDER BY date_id
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) ELSE 0 END AS INTEGER)
           AS working_day_of_period,
         CAST(SUM(CASE WHEN is_working_day THEN 1 ELSE 0 END) OVER (
              ORDER BY date_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS INTEGER)
           AS working_day_seq
  FROM cal_base
),
wd AS (
  SELECT date_id AS working_date, working_day_seq AS wd_seq FROM dim_date WHERE is_working_day
),
first_wd AS (
  SELECT fiscal_year, fiscal_period, min(date_id) AS first_working_day
  FROM dim_date WHERE is_working_day GROUP BY fiscal_year, fiscal_period
),
company AS (
  SELECT 'CO' || CAST(r_regionkey AS VARCHAR) AS company_code,
         r_name AS company_name,
         substr(r_name, 1, 2) AS country_key,
         CASE r_regionkey WHEN 1 THEN 'USD' WHEN 2 THEN 'GBP' ELSE 'EUR' END AS local_currency,
         'EUR' AS group_currency,
         4 AS soft_close_working_day,
         5 AS hard_close_target_wd
  FROM region
),
cost_center AS (
  SELECT 'CC' || lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS cost_center,
         n_name AS cost_center_name,
         'CO' || CAST(n_regionkey AS VARCHAR) AS company_code,
         'CO' || CAST(n_regionkey AS VARCHAR) || '-'
           || CASE WHEN n_nationkey % 2 = 0 THEN 'ENG' ELSE 'OPS' END AS division_id,
         CASE WHEN n_nationkey % 2 = 0 THEN 'Engineering' ELSE 'Operations' END AS division_name,
         'CO' || CAST(n_regionkey AS VARCHAR) || '-'
           || CASE WHEN n_nationkey % 2 = 0 THEN 'ENG' ELSE 'OPS' END
           || '-' || lpad(CAST(n_nationkey % 3 + 1 AS VARCHAR), 2, '0') AS department_id,
         'Department ' || CAST(n_nationkey % 3 + 1 AS VARCHAR) AS department_name,
         'CO' || CAST(n_regionkey AS VARCHAR) || '-'
           || CASE WHEN n_nationkey % 2 = 0 THEN 'ENG' ELSE 'OPS' END
           || '-' || lpad(CAST(n_nationkey % 3 + 1 AS VARCHAR), 2, '0') AS parent_id,
         3 AS hierarchy_level,
         n_nationkey >= 20 AS is_overhead,
         DATE '1995-01-01' AS valid_from,
         DATE '9999-12-31' AS valid_to,
         printf('USR-%06X', (n_regionkey + 1) * 1048576 + ((n_nationkey + 1000) * 7919) % 1048576) AS manager_user_id
  FROM nation
),
acct_types AS (
  SELECT * FROM (VALUES
    ('PROMO', 'REV', 'Revenue', 'REVENUE', 'H', 400000),
    ('ECONOMY', 'MAT', 'Materials', 'COST_OF_SALES', 'S', 500000),
    ('SMALL', 'SUB', 'Subcontracting', 'COST_OF_SALES', 'S', 510000),
    ('MEDIUM', 'PER', 'Personnel', 'PERSONNEL', 'S', 600000),
    ('STANDARD', 'TRV', 'Travel', 'OPERATING_EXPENSES', 'S', 700000),
    ('LARGE', 'DEP', 'Depreciation', 'OPERATING_EXPENSES', 'S', 800000)
  ) t(p_type, account_group, account_group_name, pl_section, normal_balance, first_account)
),
gl_account AS (
  SELECT CAST(t.first_account + CAST(split_part(p.p_brand, '#', 2) AS INTEGER) * 10 AS VARCHAR) AS gl_account,
         t.account_group_name || ' — ' || p.p_brand AS gl_account_name,
         t.account_group, t.account_group_name, t.pl_section,
         TRUE AS is_pl_account, t.normal_balance
  FROM (SELECT DISTINCT p_type, p_brand FROM part) p JOIN acct_types t ON t.p_type = p.p_type
),
close_task AS (
  SELECT * FROM (VALUES
    ('T01', 'Sub-ledger cut-off — Accounts Payable', 1, 1, FALSE),
    ('T02', 'Sub-ledger cut-off — Accounts Receivable', 2, 1, FALSE),
    ('T03', 'GR/IR clearing', 3, 2, FALSE),
    ('T04', 'Payroll posting', 4, 2, FALSE),
    ('T05', 'Depreciation run', 5, 2, FALSE),
    ('T06', 'Accruals posting', 6, 3, FALSE),
    ('T07', 'Overhead allocation cycle', 7, 3, FALSE),
    ('T08', 'Intercompany reconciliation', 8, 3, FALSE),
    ('T09', 'FX revaluation', 9, 4, FALSE),
    ('T10', 'Soft close / reporting cut-off', 10, 4, TRUE),
    ('T11', 'Management reporting pack', 11, 5, FALSE),
    ('T12', 'Hard close / period lock', 12, 5, TRUE)
  ) t(task_id, task_name, task_sequence, target_working_day, is_milestone)
),
order_values AS (
  SELECT CAST(year(o.o_orderdate) AS INTEGER) AS fiscal_year, CAST(month(o.o_orderdate) AS INTEGER) AS fiscal_period,
         n.n_regionkey AS region, CAST(CAST(o.o_totalprice AS DECIMAL(15, 2)) * 100 AS HUGEINT) AS v
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
),
month_levels AS (
  SELECT o.fiscal_year, o.fiscal_period, k.ccy,
         CAST(sum(CASE WHEN o.region = k.region THEN o.v ELSE 0 END) AS HUGEINT) AS s_own,
         CAST(sum(CASE WHEN o.region = k.region THEN 1 ELSE 0 END) AS HUGEINT) AS n_own,
         CAST(sum(o.v) AS HUGEINT) AS s_all, CAST(count(*) AS HUGEINT) AS n_all
  FROM order_values o, (VALUES ('USD', 1), ('GBP', 2)) k(ccy, region)
  GROUP BY o.fiscal_year, o.fiscal_period, k.ccy
),
rate_grid AS (
  SELECT y.y AS fiscal_year, CAST(p.range AS INTEGER) AS fiscal_period, c.ccy,
         CASE WHEN c.ccy = 'EUR' THEN 1000000
              WHEN m.s_own > 0 AND m.s_all > 0 THEN (2 * m.s_own * m.n_all * 1000000 + m.n_own * m.s_all) // (2 * m.n_own * m.s_all)
         END AS micro
  FROM years y CROSS JOIN range(1, 13) p CROSS JOIN (VALUES ('USD'), ('GBP'), ('EUR')) c(ccy)
  LEFT JOIN month_levels m ON m.fiscal_year = y.y AND m.fiscal_period = p.range AND m.ccy = c.ccy
),
rate_filled AS (
  SELECT ccy, fiscal_year, fiscal_period,
         CAST(CAST(coalesce(
           last_value(micro IGNORE NULLS) OVER (PARTITION BY ccy ORDER BY fiscal_year, fiscal_period
                                                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
           first_value(micro IGNORE NULLS) OVER (PARTITION BY ccy ORDER BY fiscal_year, fiscal_period
                                                 ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING),
           1000000) AS DECIMAL(18, 0)) * 0.000001 AS DECIMAL(15, 6)) AS rate_m
  FROM rate_grid
),
rate_vals AS (
  SELECT ccy AS from_currency, 'EUR' AS to_currency, fiscal_year, fiscal_period, rate_m,
         first_value(rate_m) OVER (PARTITION BY ccy, fiscal_year ORDER BY fiscal_period) AS rate_b
  FROM rate_filled
),
rates AS (
  SELECT from_currency, to_currency, fiscal_year, fiscal_period, 'M' AS rate_type, rate_m AS exchange_rate FROM rate_vals
  UNION ALL
  SELECT from_currency, to_currency, fiscal_year, fiscal_period, 'B' AS rate_type, rate_b AS exchange_rate FROM rate_vals
),
rates_m AS (
  SELECT from_currency, fiscal_year, fiscal_period, exchange_rate FROM rates WHERE rate_type = 'M'
),
fx_pair AS (
  SELECT from_currency, to_currency, fiscal_year, fiscal_period,
         max(CASE WHEN rate_type = 'M' THEN exchange_rate END) AS rate_actual,
         max(CASE WHEN rate_type = 'B' THEN exchange_rate END) AS rate_budget
  FROM rates GROUP BY from_currency, to_currency, fiscal_year, fiscal_period
),
j_src AS (
  SELECT l.*, sn.n_regionkey AS region, s.s_nationkey, p.p_type, p.p_brand, t.normal_balance, t.first_account,
         o.o_custkey, o.o_orderstatus, o.o_orderdate, o.o_orderpriority, c.c_mktsegment,
         cn.n_regionkey AS partner_region
  FROM lineitem l
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation sn ON s.s_nationkey = sn.n_nationkey
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN acct_types t ON t.p_type = p.p_type
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation cn ON c.c_nationkey = cn.n_nationkey
),
j_rows AS (
  SELECT
    l_orderkey, region, partner_region,
    'CO' || CAST(region AS VARCHAR) AS company_code,
    CAST(l_orderkey AS VARCHAR) || '-' || CAST(region AS VARCHAR) AS document_number,
    CAST(row_number() OVER (PARTITION BY l_orderkey, region ORDER BY l_linenumber, l_partkey, l_suppkey,
         l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS INTEGER)
      AS document_line,
    CASE o_orderpriority
      WHEN '1-URGENT' THEN 'SA'
      WHEN '2-HIGH' THEN CASE WHEN o_orderstatus = 'P' THEN 'SB' ELSE 'KR' END
      WHEN '3-MEDIUM' THEN CASE WHEN partner_region <> region THEN 'IC' ELSE 'KR' END
      WHEN '4-NOT SPECIFIED' THEN 'RE'
      ELSE 'WA' END AS document_type,
    CAST(o_orderdate AS DATE) AS posting_date,
    CAST(CAST(o_orderdate AS DATE) - CAST(l_linenumber % 3 AS INTEGER) AS DATE) AS document_date,
    CAST(CAST(o_orderdate AS DATE) + CAST(round(l_discount * 100) AS INTEGER)
         + CASE WHEN region = 3 THEN 3 ELSE 0 END AS DATE) AS entry_date,
    CAST(CAST(o_orderdate AS DATE) + CAST(l_orderkey % 7 AS INTEGER) AS DATE) AS receipt_date,
    CAST(year(o_orderdate) AS INTEGER) AS fiscal_year,
    CAST(CASE WHEN month(o_orderdate) = 12 AND o_orderpriority = '1-URGENT' AND o_orderstatus = 'O'
         THEN 13 ELSE month(o_orderdate) END AS INTEGER) AS fiscal_period,
    CAST(first_account + CAST(split_part(p_brand, '#', 2) AS INTEGER) * 10 AS VARCHAR) AS gl_account,
    CASE WHEN p_type <> 'PROMO' THEN 'CC' || lpad(CAST(s_nationkey AS VARCHAR), 3, '0') END AS cost_center,
    CASE WHEN p_type <> 'PROMO' AND o_orderpriority <> '5-LOW' THEN
      CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'PRG-AUTO' WHEN 'BUILDING' THEN 'PRG-BUILD'
                        WHEN 'FURNITURE' THEN 'PRG-FURN' WHEN 'HOUSEHOLD' THEN 'PRG-HOME'
                        WHEN 'MACHINERY' THEN 'PRG-MACH' END
    END AS programme_id,
    normal_balance AS debit_credit_ind,
    CAST(l_extendedprice AS DECIMAL(15, 2)) AS amount_doc_currency,
    CASE region WHEN 1 THEN 'USD' WHEN 2 THEN 'GBP' ELSE 'EUR' END AS doc_currency,
    (o_orderpriority = '3-MEDIUM' AND partner_region <> region) AS is_intercompany,
    CASE WHEN o_orderpriority = '3-MEDIUM' AND partner_region <> region
         THEN 'CO' || CAST(partner_region AS VARCHAR) END AS ic_partner_company,
    printf('USR-%06X', (region + 1) * 1048576 + ((o_custkey % 30) * 7919) % 1048576) AS posting_user_id
  FROM j_src
),
j_base AS (
  SELECT j.partner_region, j.receipt_date,
         j.company_code, j.document_number, j.document_line, j.document_type,
         j.posting_date, j.document_date, j.entry_date, j.fiscal_year, j.fiscal_period,
         j.gl_account, j.cost_center, j.programme_id, j.debit_credit_ind,
         j.amount_doc_currency, j.doc_currency,
         j.amount_doc_currency AS amount_local_currency, j.doc_currency AS local_currency,
         CAST(round(j.amount_doc_currency * r.exchange_rate, 2) AS DECIMAL(15, 2)) AS amount_group_currency,
         'EUR' AS group_currency, j.is_intercompany, j.ic_partner_company, j.posting_user_id,
         FALSE AS is_reversal, CAST(NULL AS VARCHAR) AS reversed_document
  FROM j_rows j
  LEFT JOIN rates_m r ON r.from_currency = j.doc_currency AND r.fiscal_year = j.fiscal_year
                     AND r.fiscal_period = least(j.fiscal_period, 12)
),
j_mirror0 AS (
  SELECT b.*, co.local_currency AS partner_ccy, r.exchange_rate AS partner_rate,
         CAST(CAST({_MIRROR_LOCAL} AS DECIMAL(18, 0)) * 0.01 AS DECIMAL(15, 2)) AS partner_local
  FROM j_base b
  JOIN company co ON co.company_code = b.ic_partner_company
  LEFT JOIN rates_m r ON r.from_currency = co.local_currency AND r.fiscal_year = year(b.receipt_date)
                     AND r.fiscal_period = month(b.receipt_date)
  WHERE b.is_intercompany
),
j_mirror AS (
  SELECT ic_partner_company AS company_code, 'M' || document_number AS document_number,
         document_line, 'IC' AS document_type, receipt_date AS posting_date, document_date,
         receipt_date AS entry_date,
         CAST(year(receipt_date) AS INTEGER) AS fiscal_year, CAST(month(receipt_date) AS INTEGER) AS fiscal_period,
         gl_account, CAST(NULL AS VARCHAR) AS cost_center, CAST(NULL AS VARCHAR) AS programme_id,
         CASE WHEN debit_credit_ind = 'S' THEN 'H' ELSE 'S' END AS debit_credit_ind,
         amount_doc_currency, doc_currency,
         partner_local AS amount_local_currency, partner_ccy AS local_currency,
         CAST(round(partner_local * partner_rate, 2) AS DECIMAL(15, 2)) AS amount_group_currency,
         group_currency, TRUE AS is_intercompany, company_code AS ic_partner_company,
         printf('USR-%06X', (partner_region + 1) * 1048576 + (document_line * 7919) % 1048576) AS posting_user_id,
         FALSE AS is_reversal, CAST(NULL AS VARCHAR) AS reversed_document
  FROM j_mirror0
),
j_rev0 AS (
  SELECT *, fiscal_year + CASE WHEN fiscal_period = 12 THEN 1 ELSE 0 END AS nfy,
         fiscal_period % 12 + 1 AS nfp
  FROM j_base WHERE document_type = 'SB' AND fiscal_period <= 12
),
j_rev AS (
  SELECT company_code, 'R' || document_number AS document_number, document_line, document_type,
         f.first_working_day AS posting_date, f.first_working_day AS document_date,
         f.first_working_day AS entry_date,
         CAST(nfy AS INTEGER) AS fiscal_year, CAST(nfp AS INTEGER) AS fiscal_period,
         gl_account, cost_center, programme_id,
         CASE WHEN debit_credit_ind = 'S' THEN 'H' ELSE 'S' END AS debit_credit_ind,
         amount_doc_currency, doc_currency, amount_local_currency, local_currency,
         amount_group_currency, group_currency, is_intercompany, ic_partner_company, posting_user_id,
         TRUE AS is_reversal, document_number AS reversed_document
  FROM j_rev0 b JOIN first_wd f ON f.fiscal_year = b.nfy AND f.fiscal_period = b.nfp
  WHERE b.nfy * 100 + b.nfp <= (SELECT last_key FROM last_covered)
),
journal AS (
  SELECT document_number || '/' || CAST(document_line AS VARCHAR) AS journal_id, company_code, document_number, document_line, document_type,
         posting_date, document_date, entry_date, fiscal_year, fiscal_period, gl_account, cost_center,
         programme_id, debit_credit_ind, amount_doc_currency, doc_currency, amount_local_currency,
         local_currency, amount_group_currency, group_currency, is_intercompany, ic_partner_company,
         posting_user_id, is_reversal, reversed_document
  FROM j_base
  UNION ALL
  SELECT document_number || '/' || CAST(document_line AS VARCHAR), company_code, document_number, document_line, document_type,
         posting_date, document_date, entry_date, fiscal_year, fiscal_period, gl_account, cost_center,
         programme_id, debit_credit_ind, amount_doc_currency, doc_currency, amount_local_currency,
         local_currency, amount_group_currency, group_currency, is_intercompany, ic_partner_company,
         posting_user_id, is_reversal, reversed_document
  FROM j_mirror
  UNION ALL
  SELECT document_number || '/' || CAST(document_line AS VARCHAR), company_code, document_number, document_line, document_type,
         posting_date, document_date, entry_date, fiscal_year, fiscal_period, gl_account, cost_center,
         programme_id, debit_credit_ind, amount_doc_currency, doc_currency, amount_local_currency,
         local_currency, amount_group_currency, group_currency, is_intercompany, ic_partner_company,
         posting_user_id, is_reversal, reversed_document
  FROM j_rev
),
prog_master AS (
  SELECT * FROM (VALUES
    ('AUTOMOBILE', 'PRG-AUTO', 'Automotive platform', 'PLATFORM', 'CO0', DATE '1995-01-01', DATE '2002-12-31'),
    ('BUILDING', 'PRG-BUILD', 'Building systems', 'INFRASTRUCTURE', 'CO1', DATE '1995-01-01', DATE '2003-06-30'),
    ('FURNITURE', 'PRG-FURN', 'Furniture line', 'PRODUCT', 'CO2', DATE '1995-07-01', DATE '1999-12-31'),
    ('HOUSEHOLD', 'PRG-HOME', 'Household range', 'PRODUCT', 'CO3', DATE '1996-01-01', DATE '2001-12-31'),
    ('MACHINERY', 'PRG-MACH', 'Machinery upgrade', 'CAPEX', 'CO4', DATE '1995-01-01', DATE '2004-12-31')
  ) t(segment, programme_id, programme_name, programme_type, lead_company_code, start_date, end_date)
),
prog_monthly AS (
  SELECT programme_id, fiscal_year, fiscal_period,
         sum(CASE WHEN debit_credit_ind = 'S' THEN amount_group_currency ELSE -amount_group_currency END) AS period_cost
  FROM journal WHERE fiscal_period <= 12 AND programme_id IS NOT NULL
  GROUP BY programme_id, fiscal_year, fiscal_period
),
prog_budget AS (
  SELECT programme_id, sum(period_cost) AS total, count(*) AS n FROM prog_monthly GROUP BY programme_id
),
programme AS (
  SELECT m.programme_id, m.programme_name, m.programme_type, m.lead_company_code, m.start_date, m.end_date,
         CAST(coalesce(CAST({BUDGET_CENTS} AS DECIMAL(30, 0)) * 0.01, 0) AS DECIMAL(28, 2)) AS total_budget_eur,
         CASE WHEN m.end_date < DATE '2001-06-30' THEN 'CLOSED' ELSE 'ACTIVE' END AS status
  FROM prog_master m LEFT JOIN prog_budget b ON b.programme_id = m.programme_id
),
ct_grid AS (
  SELECT co.company_code, CAST(regexp_extract(co.company_code, '(\\d+)$', 1) AS INTEGER) AS entity_no,
         c.fiscal_year, c.fiscal_period, t.task_id, t.task_sequence, t.target_working_day,
         last_day(make_date(c.fiscal_year, c.fiscal_period, 1)) AS period_end_date
  FROM company co, covered c, close_task t
),
ct_entered AS (
  SELECT company_code, fiscal_year, fiscal_period, entry_date, count(*) AS n
  FROM j_base WHERE fiscal_period <= 12 GROUP BY company_code, fiscal_year, fiscal_period, entry_date
),
ct_done AS (
  SELECT *, sum(n) OVER (PARTITION BY company_code, fiscal_year, fiscal_period ORDER BY entry_date) AS done,
         sum(n) OVER (PARTITION BY company_code, fiscal_year, fiscal_period) AS total
  FROM ct_entered
),
ct_ready AS (
  SELECT g.company_code, g.fiscal_year, g.fiscal_period, g.task_sequence,
         greatest(min(e.entry_date), g.period_end_date + 1) AS ready
  FROM ct_grid g JOIN ct_done e ON e.company_code = g.company_code AND e.fiscal_year = g.fiscal_year
                               AND e.fiscal_period = g.fiscal_period AND e.done * 100 >= e.total * (g.task_sequence + 88)
  GROUP BY g.company_code, g.fiscal_year, g.fiscal_period, g.task_sequence, g.period_end_date
),
ct_calc AS (
  SELECT g.*, w.working_date AS due_date, wd2.working_day_seq - d.working_day_seq AS actual_wd,
         CASE WHEN nx.working_date <= (SELECT hi FROM bounds) THEN nx.working_date END AS finished
  FROM ct_grid g
  LEFT JOIN dim_date d ON d.date_id = g.period_end_date
  LEFT JOIN wd w ON w.wd_seq = d.working_day_seq + g.target_working_day
  LEFT JOIN ct_ready r ON r.company_code = g.company_code AND r.fiscal_year = g.fiscal_year
                      AND r.fiscal_period = g.fiscal_period AND r.task_sequence = g.task_sequence
  LEFT JOIN dim_date pd ON pd.date_id = r.ready - 1
  LEFT JOIN wd nx ON nx.wd_seq = pd.working_day_seq + 1
  LEFT JOIN dim_date wd2 ON wd2.date_id = nx.working_date
),
close_tasks AS (
  SELECT ((CAST(entity_no AS BIGINT) * 10000 + fiscal_year) * 100 + fiscal_period) * 100 + task_sequence
           AS close_task_id,
         company_code, fiscal_year, fiscal_period, task_id, period_end_date, due_date,
         finished AS actual_completion_date,
         CASE WHEN finished IS NOT NULL THEN printf('USR-%06X', (entity_no + 1) * 1048576
              + ((fiscal_period * 12 + task_sequence) * 7919) % 1048576) END AS completed_by_user_id,
         CASE WHEN finished IS NOT NULL THEN CAST(actual_wd - target_working_day AS INTEGER) END AS delay_working_days
  FROM ct_calc
),
plan_act AS (
  SELECT j.company_code, j.fiscal_year, j.fiscal_period, j.cost_center, a.account_group,
         coalesce(j.programme_id, '(none)') AS programme_key,
         sum(CASE WHEN j.debit_credit_ind = 'S' THEN j.amount_group_currency ELSE -j.amount_group_currency END)
           AS actual_amount
  FROM journal j JOIN gl_account a ON a.gl_account = j.gl_account
  WHERE j.fiscal_period <= 12 AND j.cost_center IS NOT NULL
  GROUP BY j.company_code, j.fiscal_year, j.fiscal_period, j.cost_center, a.account_group,
           coalesce(j.programme_id, '(none)')
),
b_annual AS (
  SELECT company_code, fiscal_year, cost_center, account_group, programme_key,
         CAST(sum(actual_amount) AS DECIMAL(18, 2)) AS actual_annual
  FROM plan_act GROUP BY company_code, fiscal_year, cost_center, account_group, programme_key
),
b_rows AS (
  SELECT company_code, fiscal_year, cost_center, account_group, programme_key,
         round(actual_annual * 1.00, 2) AS amount
  FROM b_annual WHERE fiscal_year = (SELECT first_year FROM span)
  UNION ALL
  SELECT company_code, fiscal_year + 1, cost_center, account_group, programme_key,
         round(actual_annual * 1.03, 2) AS amount
  FROM b_annual WHERE fiscal_year >= (SELECT first_year FROM span) AND fiscal_year < (SELECT open_year FROM span)
),
budget AS (
  SELECT company_code, CAST(fiscal_year AS INTEGER) AS fiscal_year, cost_center, account_group,
         CASE WHEN programme_key <> '(none)' THEN programme_key END AS programme_id,
         'BUDGET' AS version, CAST(amount AS DECIMAL(28, 2)) AS amount_group_currency
  FROM b_rows WHERE abs(amount) >= 5000
),
f_per AS (
  SELECT company_code, fiscal_year, fiscal_period, cost_center, coalesce(programme_id, '(none)') AS programme_key,
         CAST(sum(CASE WHEN debit_credit_ind = 'S' THEN amount_group_currency ELSE -amount_group_currency END) * 100
              AS BIGINT) AS c
  FROM journal WHERE fiscal_period <= 12 AND cost_center IS NOT NULL
  GROUP BY company_code, fiscal_year, fiscal_period, cost_center, coalesce(programme_id, '(none)')
),
f_combo AS (
  SELECT company_code, fiscal_year, cost_center, programme_key, {_FORECAST_MEAN} AS mean_c
  FROM f_per GROUP BY company_code, fiscal_year, cost_center, programme_key
  HAVING abs(sum(c)) >= 5000000
),
f_snap AS (
  SELECT f.company_code, f.fiscal_year, f.cost_center, f.programme_key, f.mean_c, v.version, v.after,
         last_day(make_date(f.fiscal_year, v.after, 1)) AS snap_end
  FROM f_combo f, (VALUES ('FC-Q1', 3), ('FC-Q2', 6), ('FC-Q3', 9)) v(version, after)
  WHERE v.after <= CASE WHEN f.fiscal_year = (SELECT open_year FROM span) THEN (SELECT last_closed FROM span) ELSE 12 END
),
f_upto AS (
  SELECT v.version, p.company_code, p.fiscal_year, p.cost_center, p.programme_key, {_FORECAST_MEAN} AS pull_c
  FROM f_per p JOIN (VALUES ('FC-Q1', 3), ('FC-Q2', 6), ('FC-Q3', 9)) v(version, after) ON p.fiscal_period <= v.after
  GROUP BY v.version, p.company_code, p.fiscal_year, p.cost_center, p.programme_key
),
f_rows AS (
  SELECT s.*, t.fp, w.working_date AS snapshot_date, CAST(coalesce(a.c, s.mean_c) AS HUGEINT) AS base_c,
         CAST(coalesce(u.pull_c, s.mean_c) AS HUGEINT) AS pull_c
  FROM (SELECT *, unnest(generate_series(after + 1, 12)) AS fp FROM f_snap) t
  JOIN f_snap s ON s.company_code = t.company_code AND s.fiscal_year = t.fiscal_year AND s.cost_center = t.cost_center
               AND s.programme_key = t.programme_key AND s.version = t.version
  LEFT JOIN f_per a ON a.company_code = s.company_code AND a.fiscal_year = s.fiscal_year AND a.cost_center = s.cost_center
                   AND a.programme_key = s.programme_key AND a.fiscal_period = t.fp
  LEFT JOIN f_upto u ON u.company_code = s.company_code AND u.fiscal_year = s.fiscal_year AND u.cost_center = s.cost_center
                    AND u.programme_key = s.programme_key AND u.version = s.version
  LEFT JOIN dim_date d ON d.date_id = s.snap_end
  LEFT JOIN wd w ON w.wd_seq = d.working_day_seq + 5
),
forecast AS (
  SELECT company_code, cost_center, CASE WHEN programme_key <> '(none)' THEN programme_key END AS programme_id,
         CAST(fiscal_year AS INTEGER) AS fiscal_year, CAST(fp AS INTEGER) AS fiscal_period, version,
         snapshot_date, CAST(fp - after AS INTEGER) AS horizon_periods,
         CAST(CAST({_FORECAST_AMOUNT} AS DECIMAL(30, 0)) * 0.01 AS DECIMAL(28, 2)) AS amount_group_currency
  FROM f_rows
),
soft_close AS (
  SELECT company_code, fiscal_year, fiscal_period, due_date FROM close_tasks WHERE task_id = 'T10'
),
v_journal AS (
  SELECT j.journal_id, j.company_code, co.company_name, co.country_key,
         j.document_number, j.document_line, j.document_type,
         j.posting_date, j.document_date, j.entry_date,
         j.fiscal_year, j.fiscal_period, least(j.fiscal_period, 12) AS reporting_period,
         j.gl_account, a.gl_account_name, a.account_group, a.account_group_name, a.pl_section,
         j.cost_center, cc.cost_center_name, cc.division_id, cc.division_name,
         cc.department_id, cc.department_name, cc.is_overhead,
         j.programme_id, p.programme_name, p.programme_type,
         j.debit_credit_ind, j.doc_currency, j.amount_doc_currency,
         j.local_currency, j.amount_local_currency, j.group_currency, j.amount_group_currency,
         CASE WHEN j.debit_credit_ind = 'S' THEN j.amount_group_currency ELSE -j.amount_group_currency END
           AS signed_amount_group,
         CASE WHEN j.debit_credit_ind = 'S' THEN j.amount_local_currency ELSE -j.amount_local_currency END
           AS signed_amount_local,
         CASE WHEN j.debit_credit_ind = 'S' THEN j.amount_local_currency ELSE -j.amount_local_currency END
           * fx.rate_actual AS signed_amount_at_actual_rate,
         CASE WHEN j.debit_credit_ind = 'S' THEN j.amount_local_currency ELSE -j.amount_local_currency END
           * fx.rate_budget AS signed_amount_at_budget_rate,
         fx.rate_actual, fx.rate_budget,
         j.document_type IN ('SA', 'SB') AS is_manual_posting,
         coalesce(j.fiscal_period <= 12 AND j.entry_date > sc.due_date, FALSE) AS is_late_posting,
         j.is_intercompany, j.ic_partner_company,
         CASE WHEN j.is_intercompany THEN least(j.company_code, j.ic_partner_company) || '|'
              || greatest(j.company_code, j.ic_partner_company) END AS ic_pair,
         j.posting_user_id, j.is_reversal, j.reversed_document
  FROM journal j
  JOIN company co ON co.company_code = j.company_code
  JOIN gl_account a ON a.gl_account = j.gl_account
  LEFT JOIN cost_center cc ON cc.cost_center = j.cost_center
  LEFT JOIN programme p ON p.programme_id = j.programme_id
  LEFT JOIN fx_pair fx ON fx.from_currency = j.local_currency AND fx.to_currency = j.group_currency
                      AND fx.fiscal_year = j.fiscal_year AND fx.fiscal_period = least(j.fiscal_period, 12)
  LEFT JOIN soft_close sc ON sc.company_code = j.company_code AND sc.fiscal_year = j.fiscal_year
                         AND sc.fiscal_period = least(j.fiscal_period, 12)
)
"""


def oracle(body: str) -> str:
    """Full oracle statement: the preamble CTEs, then ``body``.

    ``body`` starts either with ``SELECT`` or with ``, name AS (...)`` extra CTEs.
    """
    body = body.strip()
    sep = "\n" if body.startswith(",") else "\n"
    return PREAMBLE.rstrip() + sep + body


def sql_cents(x: str) -> str:
    return f"CAST(({x}) * 100 AS HUGEINT)"


def sql_div_cents(amount: str, divisor: str) -> str:
    """Exact decimal amount / positive integer rounded half up to cents, as DECIMAL(28,2)."""
    return f"CAST(CAST({half_up(sql_cents(amount), divisor)} AS DECIMAL(30, 0)) * 0.01 AS DECIMAL(28, 2))"


def sql_wide_div(amount: str, divisor: str) -> str:
    """Amount in cents / positive integer rounded half up to eight decimals, as DECIMAL(30,8)."""
    n = f"{sql_cents(amount)} * 1000000"
    return f"CAST(CAST({half_up(n, divisor)} AS DECIMAL(29, 0)) * 0.00000001 AS DECIMAL(30, 8))"


def sql_exact_ratio(num: str, den: str, dp: int = 4) -> str:
    """Ratio of two amounts of up to eight decimals, half up to ``dp`` decimals, as DOUBLE."""
    def units(x):
        return f"CAST(CAST({x} AS DECIMAL(30, 8)) * 100000000 AS HUGEINT)"

    scale = 10 ** dp
    d = f"abs({units(den)})"
    return (f"(CASE WHEN {d} <> 0 THEN CAST({half_up(units(num) + f' * {scale}', d)} AS DOUBLE) "
            f"/ {float(scale)} END)")
