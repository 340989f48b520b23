"""Data-quality rules (QC1-QC20); each yields (rule, table, rows_checked, violations).

Row-level journal rules are evaluated in a single pass: broadcast lookups of
the master data, then one global aggregate of conditional counts, unpivoted
into one row per rule with ``stack``.  Key- and document-level rules each
need one grouped aggregation (partial aggregation first, so a hot document or
user costs one partial row per task).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config, schemas
from ..functions.columns import count_if, period_end_date, period_start_date, ratio, reporting_period
from ..functions.hints import dim
from ..sources.files import DOCUMENT_KEY, with_document_key
from .ledger import active_programme_window

RULE_SCHEMA = "rule string, table_name string, rows_checked long, violations long"


def _stack(agg: DataFrame, table: str, rules: list[str]) -> DataFrame:
    """One-row aggregate with ``n`` and ``v_<rule>`` columns -> one row per rule."""
    expr = "stack({}, {}) as (rule, violations)".format(
        len(rules), ", ".join(f"'{r}', v_{r}" for r in rules))
    return agg.select(F.col("n").alias("rows_checked"), F.expr(expr)).select(
        "rule", F.lit(table).alias("table_name"), "rows_checked", F.col("violations").cast("long"))


def journal_row_rules(journal: DataFrame, company: DataFrame, gl_account: DataFrame,
                      cost_center: DataFrame, programme: DataFrame, rates: DataFrame,
                      open_year: int | None = None,
                      rules: list[str] | None = None) -> DataFrame:
    """QC4-QC11, QC13-QC16 (row part) in one scan of the journal; ``rules`` names those wanted (all).
    Special periods are wrong from ``open_year`` on (None: nowhere).

    Only the lookups that the wanted rules use are joined, so columns and joins of others fall away.

    Foreign keys are orphan checks (JN14) against broadcast master data; the
    group-currency reconciliation is FX9; the token pattern is SF16."""
    co = dim(company, F.col("company_code").alias("__co"))
    acc = dim(gl_account, F.col("gl_account").alias("__acc"), "account_group", "normal_balance")
    cc = dim(cost_center, F.col("cost_center").alias("__cc"), F.col("company_code").alias("__cc_co"))
    pg = dim(programme, F.col("programme_id").alias("__pg"), F.col("start_date").alias("__pg_s"),
             F.col("end_date").alias("__pg_e"))
    rm = dim(rates.where(F.col("rate_type") == "M"), F.col("from_currency").alias("__r_ccy"),
             F.col("fiscal_year").alias("__r_fy"), F.col("fiscal_period").alias("__r_fp"),
             F.col("exchange_rate").alias("__rate"))
    rate_key = (F.col("local_currency") == F.col("__r_ccy")) & (F.col("fiscal_year") == F.col("__r_fy")) \
        & (reporting_period() == F.col("__r_fp"))
    lookups = {  # each side is unique on its key; the rules that need it
        "fk_company": (co, F.col("company_code") == F.col("__co")),
        "fk_gl_account revenue_no_centre normal_balance": (acc, F.col("gl_account") == F.col("__acc")),
        "fk_cost_center centre_ownership": (cc, F.col("cost_center") == F.col("__cc")),
        "fk_programme programme_window_non_reversal programme_window_reversal": (pg, F.col("programme_id") == F.col("__pg")),
        "group_reconciles": (rm, rate_key),
    }
    j = journal
    for users, (side, on) in lookups.items():
        if rules is None or set(users.split()) & set(rules):
            j = j.join(side, on, "left")
    regular = F.col("fiscal_period") <= 12
    outside = (F.col("posting_date") < F.col("__pg_s")) | (F.col("posting_date") > F.col("__pg_e"))
    recomputed = F.round(F.col("amount_local_currency") * F.col("__rate"), 2)
    checks = {
        "fk_company": F.col("__co").isNull(),
        "fk_gl_account": F.col("__acc").isNull(),
        "fk_cost_center": F.col("cost_center").isNotNull() & F.col("__cc").isNull(),
        "fk_programme": F.col("programme_id").isNotNull() & F.col("__pg").isNull(),
        "programme_empty_string": F.col("programme_id") == "",
        "centre_ownership": F.col("__cc").isNotNull() & (F.col("__cc_co") != F.col("company_code")),
        "revenue_no_centre": (F.col("account_group") == "REV") & F.col("cost_center").isNotNull(),
        "programme_window_non_reversal": F.col("__pg").isNotNull() & ~F.col("is_reversal") & outside,
        "programme_window_reversal": F.col("__pg").isNotNull() & F.col("is_reversal") & outside,
        "date_order": (F.col("document_date") > F.col("posting_date")) | (F.col("posting_date") > F.col("entry_date")),
        "period_range": (F.col("fiscal_period") < 1) | (F.col("fiscal_period") > 16),
        "special_in_incomplete_year": (F.col("fiscal_period") > 12) & (F.col("fiscal_year") >= F.lit(open_year).cast("int")),
        "posting_outside_period": regular & ((F.year("posting_date") != F.col("fiscal_year"))
                                             | (F.month("posting_date") != F.col("fiscal_period"))),
        "unsigned_amounts": (F.col("amount_doc_currency") < 0) | (F.col("amount_local_currency") < 0)
        | (F.col("amount_group_currency") < 0),
        "group_reconciles": ~F.col("is_reversal") & (F.col("__rate").isNull()
                                                     | (F.abs(F.col("amount_group_currency") - recomputed) > 0.01)),
        "same_currency_identity": (F.col("local_currency") == F.col("group_currency"))
        & (F.col("amount_local_currency") != F.col("amount_group_currency")),
        "normal_balance": ~F.col("is_reversal") & ~F.col("is_intercompany")
        & (F.col("debit_credit_ind") != F.col("normal_balance")),
        "intercompany_partner": (F.col("is_intercompany") & (F.col("ic_partner_company").isNull()
                                                             | (F.col("ic_partner_company") == F.col("company_code"))))
        | (~F.col("is_intercompany") & F.col("ic_partner_company").isNotNull()),
        "user_token_pattern": ~F.col("posting_user_id").rlike(config.USER_TOKEN_PATTERN),
    }
    checks = {name: cond for name, cond in checks.items() if rules is None or name in rules}
    agg = j.agg(F.count(F.lit(1)).alias("n"),
                *[count_if(F.coalesce(cond, F.lit(False))).alias(f"v_{name}") for name, cond in checks.items()])
    return _stack(agg, "journal", list(checks))


def primary_key_rule(df: DataFrame, table: str, keys: list[str], rule: str | None = None) -> DataFrame:
    """QC1: surplus rows over unique keys (0 when the key is unique)."""
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("c"))
    return g.agg(
        F.sum("c").cast("long").alias("rows_checked"),
        F.coalesce(F.sum(F.col("c") - 1), F.lit(0)).cast("long").alias("violations"),
    ).select(F.lit(rule or "primary_key").alias("rule"), F.lit(table).alias("table_name"),
             F.coalesce("rows_checked", F.lit(0)).alias("rows_checked"), "violations")


def document_rules(journal: DataFrame) -> DataFrame:
    """QC2 + QC3 (AG11/AG12) in one grouping by document: lines 1..n without gaps, one header
    per document (min <> max per attribute instead of a multi-column distinct count).  A journal
    that is bucketed by ``document_key`` is grouped where it lies."""
    d = journal.groupBy(*[k for k in (DOCUMENT_KEY, "document_number") if k in journal.columns]).agg(
        F.min("document_line").alias("lo"), F.max("document_line").alias("hi"), F.count(F.lit(1)).alias("c"),
        *[(F.min(k) != F.max(k)).alias(f"x_{k}") for k in
          ("company_code", "fiscal_year", "fiscal_period", "document_type")],
    )
    header_bad = reduce(lambda a, b: a | b, [F.col(f"x_{k}") for k in
                                             ("company_code", "fiscal_year", "fiscal_period", "document_type")])
    agg = d.agg(F.count(F.lit(1)).alias("n"),
                count_if((F.col("lo") != 1) | (F.col("hi") != F.col("c"))).alias("v_line_numbering"),
                count_if(header_bad).alias("v_header_consistency"))
    return _stack(agg, "journal_documents", ["line_numbering", "header_consistency"])


def user_rules(journal: DataFrame) -> DataFrame:
    """QC16: a user posts in one entity only."""
    u = journal.groupBy("posting_user_id").agg((F.min("company_code") != F.max("company_code")).alias("multi"))
    agg = u.agg(F.count(F.lit(1)).alias("n"), count_if(F.col("multi")).alias("v_user_single_entity"))
    return _stack(agg, "journal_users", ["user_single_entity"])


def reversal_rules(journal: DataFrame) -> DataFrame:
    """QC12/JN15: every reversal matches an original line: same three amounts, flipped side, later posting date.

    A document and its reversal share their ``document_key``, so the match is a window over (key, line); a journal
    that is bucketed by the key needs no shuffle for it.
    """
    j = journal if DOCUMENT_KEY in journal.columns else with_document_key(journal)
    amounts = ["amount_doc_currency", "amount_local_currency", "amount_group_currency"]
    j = j.where(F.col("is_reversal") | (F.col("document_type") == "SB")).select(
        DOCUMENT_KEY, "document_line", "is_reversal", "debit_credit_ind", "posting_date", *amounts)
    line = Window.partitionBy(DOCUMENT_KEY, "document_line")
    orig = F.max(F.when(~F.col("is_reversal"), F.struct("debit_credit_ind", "posting_date", *amounts))).over(line)
    m = j.withColumn("__o", orig).where("is_reversal")
    bad = F.col("__o").isNull() | (F.col("__o.debit_credit_ind") == F.col("debit_credit_ind")) \
        | (F.col("posting_date") <= F.col("__o.posting_date"))
    for a in amounts:
        bad = bad | (F.col(a) != F.col(f"__o.{a}"))
    agg = m.agg(F.count(F.lit(1)).alias("n"), count_if(bad).alias("v_reversal_match"))
    return _stack(agg, "journal_reversals", ["reversal_match"])


def plan_rules(budget: DataFrame, forecast: DataFrame, company: DataFrame, cost_center: DataFrame,
               gl_account: DataFrame) -> DataFrame:
    """QC17: budget/forecast keys exist, versions allowed, horizon = period - snapshot period >= 1."""
    co = dim(company, F.col("company_code").alias("__co"))
    cc = dim(cost_center, F.col("cost_center").alias("__cc"))
    groups = dim(gl_account.select(F.col("account_group").alias("__g")).distinct())
    b = budget.join(co, F.col("company_code") == F.col("__co"), "left") \
        .join(cc, F.col("cost_center") == F.col("__cc"), "left") \
        .join(groups, F.col("account_group") == F.col("__g"), "left")
    bagg = b.agg(F.count(F.lit(1)).alias("n"),
                 count_if(F.col("__co").isNull() | F.col("__cc").isNull() | F.col("__g").isNull()).alias("v_budget_keys"),
                 count_if(F.col("version") != config.BUDGET_VERSION).alias("v_budget_version"))
    snap_period = F.month("snapshot_date") - 1
    f = forecast.join(co, F.col("company_code") == F.col("__co"), "left") \
        .join(cc, F.col("cost_center") == F.col("__cc"), "left")
    fagg = f.agg(F.count(F.lit(1)).alias("n"),
                 count_if(F.col("__co").isNull() | F.col("__cc").isNull()).alias("v_forecast_keys"),
                 count_if(~F.col("version").isin(list(config.FORECAST_SNAPSHOT_AFTER_PERIOD))).alias("v_forecast_version"),
                 count_if((F.col("horizon_periods") < 1)
                          | (F.col("horizon_periods") != F.col("fiscal_period") - snap_period)).alias("v_forecast_horizon"))
    return _stack(bagg, "budget", ["budget_keys", "budget_version"]).unionByName(
        _stack(fagg, "forecast", ["forecast_keys", "forecast_version", "forecast_horizon"]))


def programme_window_share(journal: DataFrame, programme: DataFrame, limit: float = 0.01) -> DataFrame:
    """QC7: per programme the lines outside its dates, reversals and others, against the limit.

    A reversal may fall behind its programme's end, but the lines outside must stay under ``limit``
    of all, and no other line may be among them.
    """
    x = journal.where(F.col("programme_id").isNotNull())
    x = x.withColumn("period_start", period_start_date()).withColumn("period_end", period_end_date())
    x = active_programme_window(x, programme)
    outside = ~F.coalesce(F.col("is_programme_active"), F.lit(False))
    return x.groupBy("programme_id").agg(
        F.count(F.lit(1)).alias("line_count"), count_if(outside).alias("outside"),
        count_if(outside & ~F.col("is_reversal")).alias("outside_not_reversal"),
    ).withColumn("outside_share", ratio("outside", "line_count")) \
     .withColumn("passed", (F.col("outside_share") < limit) & (F.col("outside_not_reversal") == 0))


def close_rules(close_tasks: DataFrame, company: DataFrame, calendar: DataFrame, periods: DataFrame) -> DataFrame:
    """QC18: coverage (every entity x covered period x task present exactly once), due dates
    on working days, open rows carry no completion data."""
    keys = ["company_code", "fiscal_year", "fiscal_period", "task_id"]
    wd = dim(calendar.select(F.col("date_id").alias("__d"), F.col("is_working_day").alias("__w")))
    t = close_tasks.join(wd, F.col("due_date") == F.col("__d"), "left")
    agg = t.agg(
        F.count(F.lit(1)).alias("n"),
        count_if(~F.coalesce(F.col("__w"), F.lit(False))).alias("v_due_on_working_day"),
        count_if(F.col("actual_completion_date").isNull()
                 & (F.col("delay_working_days").isNotNull() | F.col("completed_by_user_id").isNotNull()))
        .alias("v_open_rows_clean"),
        (F.count(F.lit(1)) - F.countDistinct(*keys)).alias("v_coverage_duplicates"),
    )
    every = periods.agg(F.collect_list(F.struct("fiscal_year", "fiscal_period")).alias("p"))  # one row a month
    task_ids = F.array(*[F.lit(t[0]) for t in config.CLOSE_TASKS])
    expected = (
        company.join(F.broadcast(every)).select("company_code", F.explode("p").alias("p"))
        .select("company_code", "p.fiscal_year", "p.fiscal_period", F.explode(task_ids).alias("task_id"))
    )
    present = close_tasks.select(*keys).distinct().withColumn("__present", F.lit(True))
    cov = expected.join(present, keys, "left").agg(
        F.count(F.lit(1)).alias("n"), count_if(F.col("__present").isNull()).alias("v_coverage_missing"))
    return _stack(agg, "close_tasks", ["due_on_working_day", "open_rows_clean", "coverage_duplicates"]) \
        .unionByName(_stack(cov, "close_tasks", ["coverage_missing"]))


def rate_rules(journal: DataFrame, rates: DataFrame) -> DataFrame:
    """QC19: every rate a journal line needs exists; budget rate constant per currency x FY."""
    need = journal.select(F.col("local_currency").alias("from_currency"), "fiscal_year",
                          reporting_period().alias("fiscal_period")).distinct()
    have = dim(rates.where(F.col("rate_type") == "M").select(
        "from_currency", "fiscal_year", "fiscal_period", F.lit(True).alias("__have")))
    a = need.join(have, ["from_currency", "fiscal_year", "fiscal_period"], "left").agg(
        F.count(F.lit(1)).alias("n"), count_if(F.col("__have").isNull()).alias("v_rate_coverage"))
    b = rates.where(F.col("rate_type") == "B").groupBy("from_currency", "fiscal_year").agg(
        (F.min("exchange_rate") != F.max("exchange_rate")).alias("moving"))
    bb = b.agg(F.count(F.lit(1)).alias("n"), count_if(F.col("moving")).alias("v_budget_rate_frozen"))
    return _stack(a, "rates", ["rate_coverage"]).unionByName(_stack(bb, "rates", ["budget_rate_frozen"]))


def qc_summary(ledger) -> DataFrame:
    """All rules on a ledger (any object exposing the eleven finance tables)."""
    L = ledger
    parts = [
        primary_key_rule(L.journal, "journal", ["journal_id"]),
        primary_key_rule(L.journal, "journal", ["document_number", "document_line"], "document_line_unique"),
        journal_row_rules(L.journal, L.company, L.gl_account, L.cost_center, L.programme, L.rates, L.fiscal_span.open_year),
        document_rules(L.journal_by_document),
        user_rules(L.journal),
        reversal_rules(L.journal_by_document),
        plan_rules(L.budget, L.forecast, L.company, L.cost_center, L.gl_account),
        close_rules(L.close_tasks, L.company, L.dim_date, L.periods),
        rate_rules(L.journal, L.rates),
    ]
    for t in ("company", "cost_center", "programme", "gl_account", "close_tasks"):
        parts.append(primary_key_rule(getattr(L, t), t, schemas.PRIMARY_KEYS[t]))
    return reduce(DataFrame.unionByName, parts)


def hierarchy_rules(nodes: DataFrame, faults: DataFrame) -> DataFrame:
    """The faults of a hierarchy as rule rows, one a kind of fault."""
    checked = nodes.select("node_id").distinct().agg(F.count(F.lit(1)).alias("n"))
    kinds = ["two_parents", "missing_parent", "cycle", "below_cycle"]
    seen = faults.agg(*[F.coalesce(count_if(F.col("fault") == k), F.lit(0)).alias(f"v_hierarchy_{k}") for k in kinds])
    return _stack(checked.crossJoin(seen), "cost_center", [f"hierarchy_{k}" for k in kinds])  # one row and one row


def raw_line_rules(lineitem: DataFrame, orders: DataFrame, customer: DataFrame, supplier: DataFrame,
                   part: DataFrame, nation: DataFrame) -> DataFrame:
    """QC4/JN14 on the raw lines, before the adapter's inner joins drop those without master data: lines without
    supplier, part, order or customer, and the lines that the journal lacks for any of these."""
    def known(df: DataFrame, key: str, flag: str) -> DataFrame:
        return df.select(key).distinct().withColumn(flag, F.lit(True))

    nations = F.broadcast(known(nation, "n_nationkey", "__n"))
    homes = supplier.join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
    buyers = customer.join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    buys = orders.select("o_orderkey", "o_custkey").join(known(buyers, "c_custkey", "__c"), F.col("o_custkey") == F.col("c_custkey"), "left")
    buys = buys.groupBy("o_orderkey").agg(F.max("__c").alias("__c")).withColumn("__o", F.lit(True))
    x = (lineitem.select("l_orderkey", "l_partkey", "l_suppkey")
         .join(known(homes, "s_suppkey", "__s"), F.col("l_suppkey") == F.col("s_suppkey"), "left")
         .join(known(part, "p_partkey", "__p"), F.col("l_partkey") == F.col("p_partkey"), "left")
         .join(buys, F.col("l_orderkey") == F.col("o_orderkey"), "left"))
    lacks = {"raw_line_supplier": F.col("__s").isNull(), "raw_line_part": F.col("__p").isNull(), "raw_line_order": F.col("__o").isNull(),
             "raw_line_customer": F.col("__o").isNotNull() & F.col("__c").isNull()}
    lacks["raw_line_dropped"] = reduce(lambda a, b: a | b, list(lacks.values()))
    agg = x.agg(F.count(F.lit(1)).alias("n"), *[count_if(c).alias(f"v_{k}") for k, c in lacks.items()])
    return _stack(agg, "lineitem", list(lacks))


def driver_table_rules(spark, sf_dir: str) -> DataFrame:
    """QC1/QC4/QC8 on the raw driver tables, where real violations exist."""
    from ..sources.demo import read_driver_table

    li = read_driver_table(spark, sf_dir, "lineitem")
    orders = read_driver_table(spark, sf_dir, "orders")
    pk = primary_key_rule(li, "lineitem", ["l_orderkey", "l_linenumber"])
    keys_with_lines = li.select(F.col("l_orderkey").alias("o_orderkey")).distinct() \
        .withColumn("__has_lines", F.lit(True))
    a = orders.select("o_orderkey").join(keys_with_lines, "o_orderkey", "left").agg(
        F.count(F.lit(1)).alias("n"), count_if(F.col("__has_lines").isNull()).alias("v_orders_without_lines"))
    orphan = li.join(orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate"), "l_orderkey", "left")
    b = orphan.agg(F.count(F.lit(1)).alias("n"),
                   count_if(F.col("o_orderdate").isNull()).alias("v_lines_without_order"),
                   count_if(F.col("l_shipdate") < F.col("o_orderdate")).alias("v_ship_before_order"))
    return reduce(DataFrame.unionByName, [
        pk, _stack(a, "orders", ["orders_without_lines"]),
        _stack(b, "lineitem", ["lines_without_order", "ship_before_order"]),
    ])
