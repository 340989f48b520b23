"""Demo adapter: the driver's TPC-H-like tables -> the eleven finance tables.

Mapping (all deterministic, no random draws):

* company      = region; local currency USD for region 1, GBP for region 2, else EUR
* cost centre  = nation (belongs to the nation's region)
* G/L account  = part type x brand; PROMO is revenue (credit), the rest are costs
* programme    = customer market segment (master data fixed below, budget derived
                 from the journal's burn rate)
* journal line = lineitem; entity = region of the line's supplier; document =
                 (order, entity); posting date = order date; entry date lags the
                 posting by the discount in days (plus a lag for the slow entity);
                 amounts = extended price in local currency, translated to EUR at
                 the period's actual rate, rounded at each hop
* plus derived lines: intercompany mirrors on the partner side (booked on receipt,
  so month-end timing differences surface as open items) and next-period
  reversals of accrual documents (type SB), which carry their original amounts.
  The partner books a whole mirror document on one receipt date (posting date
  plus 0-6 days by order key), so the mirror document keeps one period.
* close tasks, budget and forecast are built by the planning operators.

Scale notes: only the journal grows with the data.  Its derivation is three
equi-joins (supplier, part, order keys; a side that is or turns out small is
broadcast) followed by a window over the document that reuses the order-key
partitioning of the last join; orders of very many lines are numbered apart.  Every dimension that
is explicitly broadcast here has a size bound by construction (regions,
nations, currencies x months, days in the calendar window, the 12-task
catalogue, five programmes).
"""

from __future__ import annotations

import threading
import uuid
from decimal import Decimal
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import config
from ..functions.columns import div_half_up
from ..functions.hints import bounded
from ..operators import calendar as cal
from ..operators.ledger import number_lines
from ..session import cut_lineage, shuffles_for, tasks_for
from . import versions
from .files import DOCUMENT_COLUMNS, document_buckets, load_counts, with_document_key, write_by_document

DRIVER_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


def _bounded_table(fn):
    """A ledger table whose size has a bound by construction, marked for broadcast."""
    def build(self) -> DataFrame:
        return bounded(fn(self))

    build.__doc__ = fn.__doc__
    return cached_property(build)


def read_driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def user_token(region: F.Column, k: F.Column) -> F.Column:
    """Pseudonymous user token ``USR-XXXXXX``, unique per (entity, user number)."""
    return F.format_string("USR-%06X", (region + 1) * F.lit(1048576) + (k * 7919) % 1048576)


def _company_code(region_col) -> F.Column:
    return F.concat(F.lit("CO"), region_col.cast("string"))


def _local_currency(region_col) -> F.Column:
    expr = F.lit("EUR")
    for key, ccy in sorted(config.REGION_CURRENCY.items(), reverse=True):
        expr = F.when(region_col == key, F.lit(ccy)).otherwise(expr)
    return expr


class DemoLedger:
    """Lazy set of finance tables derived from one driver scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str,
                 store: str | None = None):
        self.spark = spark
        self.sf_dir = sf_dir
        self.store = store
        self._lock, self._written = threading.RLock(), {}

    def _t(self, name: str) -> DataFrame:
        return read_driver_table(self.spark, self.sf_dir, name)

    driver_table = _t

    # ------------------------------------------------------------------ dims
    @_bounded_table
    def company(self) -> DataFrame:
        r = self._t("region")
        return r.select(
            _company_code(F.col("r_regionkey")).alias("company_code"),
            F.col("r_name").alias("company_name"),
            F.substring("r_name", 1, 2).alias("country_key"),
            _local_currency(F.col("r_regionkey")).alias("local_currency"),
            F.lit(config.GROUP_CURRENCY).alias("group_currency"),
            F.lit(4).alias("soft_close_working_day"),
            F.lit(5).alias("hard_close_target_wd"),
        )

    @_bounded_table
    def cost_center(self) -> DataFrame:
        n = self._t("nation")
        even = F.col("n_nationkey") % 2 == 0
        division_id = F.concat(
            F.lit("CO"), F.col("n_regionkey").cast("string"), F.lit("-"),
            F.when(even, F.lit("ENG")).otherwise(F.lit("OPS")),
        )
        dept_no = (F.col("n_nationkey") % 3 + 1).cast("string")
        department_id = F.concat(division_id, F.lit("-"), F.lpad(dept_no, 2, "0"))
        return n.select(
            F.concat(F.lit("CC"), F.lpad(F.col("n_nationkey").cast("string"), 3, "0")).alias("cost_center"),
            F.col("n_name").alias("cost_center_name"),
            _company_code(F.col("n_regionkey")).alias("company_code"),
            division_id.alias("division_id"),
            F.when(even, F.lit("Engineering")).otherwise(F.lit("Operations")).alias("division_name"),
            department_id.alias("department_id"),
            F.concat(F.lit("Department "), dept_no).alias("department_name"),
            department_id.alias("parent_id"),
            F.lit(3).alias("hierarchy_level"),
            (F.col("n_nationkey") >= 20).alias("is_overhead"),
            F.lit(config.VALID_FROM).alias("valid_from"),
            F.to_date(F.lit("9999-12-31")).alias("valid_to"),
            user_token(F.col("n_regionkey"), F.col("n_nationkey") + 1000).alias("manager_user_id"),
        )

    @_bounded_table
    def account_types(self) -> DataFrame:
        return self.spark.createDataFrame(
            config.ACCOUNT_TYPES,
            "p_type string, account_group string, account_group_name string, pl_section string, "
            "normal_balance string, first_account int",
        )

    @_bounded_table
    def gl_account(self) -> DataFrame:
        p = self._t("part").select("p_type", "p_brand").distinct()
        brand_no = F.split_part(F.col("p_brand"), F.lit("#"), F.lit(2)).cast("int")
        return p.join(F.broadcast(self.account_types), "p_type").select(
            (F.col("first_account") + brand_no * 10).cast("string").alias("gl_account"),
            F.concat(F.col("account_group_name"), F.lit(" — "), F.col("p_brand")).alias("gl_account_name"),
            "account_group",
            "account_group_name",
            "pl_section",
            F.lit(True).alias("is_pl_account"),
            "normal_balance",
        )

    @_bounded_table
    def programme_master(self) -> DataFrame:
        return self.spark.createDataFrame(
            [(seg, pid, name, ptype, f"CO{lead}", start, end)
             for seg, pid, name, ptype, lead, start, end in config.PROGRAMMES],
            "segment string, programme_id string, programme_name string, programme_type string, "
            "lead_company_code string, start_date date, end_date date",
        )

    @_bounded_table
    def programme(self) -> DataFrame:
        from ..operators.plan import programme_budget_derive

        budget = programme_budget_derive(self.journal, self.programme_master)
        return self._kept("programme", (
            self.programme_master.join(budget, "programme_id", "left")
            .select(
                "programme_id", "programme_name", "programme_type", "lead_company_code",
                "start_date", "end_date",
                F.coalesce(F.col("total_budget_eur"), F.lit(0).cast("decimal(28,2)"))
                .cast("decimal(28,2)").alias("total_budget_eur"),
                F.when(F.col("end_date") < F.lit(config.AS_OF_DATE), F.lit("CLOSED"))
                .otherwise(F.lit("ACTIVE")).alias("status"),
            )
        ))

    @_bounded_table
    def dim_date(self) -> DataFrame:
        return cut_lineage(cal.dim_date(self.calendar_years))

    @cached_property
    def order_days(self) -> DataFrame:
        """Orders by day and region of the customer (null without one): number and value in cents.

        The one pass over the orders that calendar, periods and rates need; a few rows a day.
        """
        nation = F.broadcast(self._t("nation").select("n_nationkey", "n_regionkey"))
        customer = self._t("customer").select("c_custkey", "c_nationkey").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        value = F.round(F.col("o_totalprice").cast("decimal(15,2)") * 100, 0).cast("decimal(18,0)")
        days = (self._t("orders").select("o_custkey", F.to_date("o_orderdate").alias("day"), "o_totalprice")
                .join(customer.select("c_custkey", "n_regionkey"), F.col("o_custkey") == F.col("c_custkey"), "left")
                .groupBy("day", F.col("n_regionkey").alias("region")).agg(F.count(F.lit(1)).alias("orders"), F.sum(value).alias("cents")))
        return cut_lineage(days)

    @cached_property
    def calendar_years(self) -> DataFrame:
        return cut_lineage(cal.calendar_years(self.order_days, "day"))

    @cached_property
    def periods(self) -> DataFrame:
        """The closed regular periods, read off the order dates."""
        return cut_lineage(cal.covered_periods(self.order_days, "day"))

    @cached_property
    def as_of(self) -> DataFrame:
        """One row: the last posting's date."""
        return cut_lineage(self.order_days.agg(F.max("day").alias("as_of")))

    @cached_property
    def fiscal_span(self) -> cal.FiscalSpan:
        return cal.fiscal_span(self.periods)

    @property
    def last_covered(self) -> int:
        """Key of the last closed period (0 without postings)."""
        return self.fiscal_span.last_key

    @_bounded_table
    def close_task(self) -> DataFrame:
        return self.spark.createDataFrame(
            config.CLOSE_TASKS,
            "task_id string, task_name string, task_sequence int, target_working_day int, "
            "is_milestone boolean",
        )

    @_bounded_table
    def rates(self) -> DataFrame:
        """Actual (M) and budget (B) rates to EUR, read off the orders.

        A currency's actual rate of a month is the price level of its region: the mean order value
        of the region's customers over that of all customers, to six digits.  A month without
        orders keeps the last month's rate (the first known one at the start), and EUR is 1.  The
        budget rate is that of the fiscal year's first month.
        """
        orders = self.order_days.where(F.col("region").isNotNull())
        sums = [F.sum("cents").cast("decimal(20,0)").alias("s_all"), F.sum("orders").cast("decimal(10,0)").alias("n_all")]
        for key in config.REGION_CURRENCY:
            own = F.col("region") == key
            sums += [F.sum(F.when(own, F.col("cents")).otherwise(0)).cast("decimal(20,0)").alias(f"s{key}"),
                     F.sum(F.when(own, F.col("orders")).otherwise(0)).cast("decimal(10,0)").alias(f"n{key}")]
        by_month = orders.groupBy(F.year("day").alias("fiscal_year"), F.month("day").alias("fiscal_period")).agg(*sums)

        def level(key):
            million = F.lit(1000000).cast("decimal(7,0)")
            micro = div_half_up(F.col(f"s{key}") * F.col("n_all") * million, F.col(f"n{key}") * F.col("s_all"))
            known = (F.col(f"n{key}") > 0) & (F.col("s_all") > 0) & (F.col(f"s{key}") > 0)
            return F.when(known, (micro.cast("decimal(18,0)") * F.lit(Decimal("0.000001"))).cast("decimal(15,6)"))

        levels = by_month.select("fiscal_year", "fiscal_period", *[level(k).alias(f"r{k}") for k in config.REGION_CURRENCY])
        grid = self.calendar_years.select(
            F.col("year").alias("fiscal_year"), F.explode(F.sequence(F.lit(1), F.lit(12))).alias("fiscal_period"))
        grid = grid.join(levels, ["fiscal_year", "fiscal_period"], "left")
        one = F.lit(Decimal("1.000000")).cast("decimal(15,6)")
        each = F.array(*[F.struct(F.lit(ccy).alias("from_currency"), F.col(f"r{k}").alias("r"))
                         for k, ccy in config.REGION_CURRENCY.items()],
                       F.struct(F.lit(config.GROUP_CURRENCY).alias("from_currency"), one.alias("r")))
        rows = grid.select("fiscal_year", "fiscal_period", F.explode(each).alias("e")).select("fiscal_year", "fiscal_period", "e.*")
        time = Window.partitionBy("from_currency").orderBy("fiscal_year", "fiscal_period")  # one row a month
        before = time.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        after = time.rowsBetween(Window.currentRow, Window.unboundedFollowing)
        rate = F.coalesce(F.last("r", True).over(before), F.first("r", True).over(after), one)
        rows = rows.withColumn("rate_m", rate)
        year = Window.partitionBy("from_currency", "fiscal_year").orderBy("fiscal_period")
        rows = rows.withColumn("rate_b", F.first("rate_m").over(year))
        return cut_lineage(rows.select(
            "from_currency", F.lit(config.GROUP_CURRENCY).alias("to_currency"), "fiscal_year", "fiscal_period",
            F.explode(F.array(
                F.struct(F.lit("M").alias("rate_type"), F.col("rate_m").alias("exchange_rate")),
                F.struct(F.lit("B").alias("rate_type"), F.col("rate_b").alias("exchange_rate")),
            )).alias("r"),
        ).select("from_currency", "to_currency", "fiscal_year", "fiscal_period", "r.rate_type",
                 "r.exchange_rate"))

    # --------------------------------------------------------------- journal
    def _actual_rates(self) -> DataFrame:
        return self.rates.where("rate_type = 'M'").select(
            F.col("from_currency").alias("__ccy"),
            F.col("fiscal_year").alias("__fy"),
            F.col("fiscal_period").alias("__fp"),
            F.col("exchange_rate").alias("__rate"),
        )

    @cached_property
    def line_count(self) -> int:
        """Rows of ``lineitem``, read off its footers."""
        return self._t("lineitem").count()

    @cached_property
    def journal_base(self) -> DataFrame:
        """One journal line per lineitem (lines whose keys have no master row drop)."""
        li = self._t("lineitem").select(
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
            "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
        )
        nation = F.broadcast(self._t("nation").select("n_nationkey", "n_regionkey"))
        homes = nation.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_regionkey").alias("s_regionkey"))
        supp = self._t("supplier").select("s_suppkey", "s_nationkey")
        part = self._t("part").select("p_partkey", "p_type", "p_brand")
        types = F.broadcast(self.account_types.select("p_type", "normal_balance", "first_account"))
        cust = self._t("customer").select("c_custkey", "c_nationkey", "c_mktsegment").join(
            nation, F.col("c_nationkey") == F.col("n_nationkey")
        ).select("c_custkey", "c_mktsegment", F.col("n_regionkey").alias("c_regionkey"))
        orders = self._t("orders").select(
            "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"
        ).join(cust, F.col("o_custkey") == F.col("c_custkey"))

        def joined(lines: DataFrame) -> DataFrame:
            # small dimensions after the tables they describe, so that the size of those is known to the planner
            known = (
                lines.join(supp, F.col("l_suppkey") == F.col("s_suppkey")).join(homes, "s_nationkey")
                .join(part, F.col("l_partkey") == F.col("p_partkey")).join(types, "p_type")
            )
            # documents are sorted twice where this join leaves them, so its tasks grow in number with the lines, not in size
            tasks = tasks_for(self.spark, self.line_count)
            return known.repartition(tasks, "l_orderkey").join(
                orders.repartition(tasks, "o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey"))

        region = F.col("s_regionkey")
        doc_no = F.concat_ws("-", "l_orderkey", region)
        # WN4: line number within document by a total order of the line's columns.
        line_order = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
                      "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
        keys = li.select("l_orderkey").union(self._t("orders").select("o_orderkey"))
        x = number_lines(li, "l_orderkey", joined, keys, ["l_orderkey", "s_regionkey"], line_order, "document_line")
        posting = F.to_date("o_orderdate")
        is_ic = (F.col("o_orderpriority") == "3-MEDIUM") & (F.col("c_regionkey") != region)
        doc_type = (
            F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("SA"))
            .when(F.col("o_orderpriority") == "2-HIGH",
                  F.when(F.col("o_orderstatus") == "P", F.lit("SB")).otherwise(F.lit("KR")))
            .when(F.col("o_orderpriority") == "3-MEDIUM",
                  F.when(is_ic, F.lit("IC")).otherwise(F.lit("KR")))
            .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit("RE"))
            .otherwise(F.lit("WA"))
        )
        special = (
            (F.month(posting) == 12)
            & (F.col("o_orderpriority") == "1-URGENT")
            & (F.col("o_orderstatus") == "O")
        )
        revenue = F.col("p_type") == "PROMO"
        segment_programme = F.lit(None).cast("string")
        for seg, pid, *_ in reversed(config.PROGRAMMES):
            segment_programme = F.when(F.col("c_mktsegment") == seg, F.lit(pid)).otherwise(segment_programme)
        lag_days = F.round(F.col("l_discount") * 100).cast("int") + F.when(
            region == config.SLOW_CLOSE_REGION, F.lit(3)).otherwise(F.lit(0))

        y = x.select(
            F.col("l_orderkey"),
            region.alias("region"),
            F.col("c_regionkey").alias("partner_region"),
            _company_code(region).alias("company_code"),
            doc_no.alias("document_number"),
            F.col("document_line"),
            doc_type.alias("document_type"),
            posting.alias("posting_date"),
            F.date_sub(posting, F.col("l_linenumber") % 3).alias("document_date"),
            F.date_add(posting, lag_days).alias("entry_date"),
            # The partner books the whole document on receipt, a few days after posting.
            F.date_add(posting, (F.col("l_orderkey") % 7).cast("int")).alias("receipt_date"),
            F.year(posting).alias("fiscal_year"),
            F.when(special, F.lit(13)).otherwise(F.month(posting)).alias("fiscal_period"),
            (F.col("first_account") + F.split_part(F.col("p_brand"), F.lit("#"), F.lit(2)).cast("int") * 10)
            .cast("string").alias("gl_account"),
            F.when(~revenue, F.concat(F.lit("CC"), F.lpad(F.col("s_nationkey").cast("string"), 3, "0")))
            .alias("cost_center"),
            F.when(~revenue & (F.col("o_orderpriority") != "5-LOW"), segment_programme).alias("programme_id"),
            F.col("normal_balance").alias("debit_credit_ind"),
            F.col("l_extendedprice").cast("decimal(15,2)").alias("amount_doc_currency"),
            _local_currency(region).alias("doc_currency"),
            is_ic.alias("is_intercompany"),
            F.when(is_ic, _company_code(F.col("c_regionkey"))).alias("ic_partner_company"),
            user_token(region, F.col("o_custkey") % 30).alias("posting_user_id"),
        )
        rates = self._actual_rates()
        y = y.join(
            rates,
            (F.col("doc_currency") == F.col("__ccy"))
            & (F.col("fiscal_year") == F.col("__fy"))
            & (F.least(F.col("fiscal_period"), F.lit(12)) == F.col("__fp")),
            "left",
        )
        return y.select(
            "region", "partner_region", "receipt_date",
            "company_code", "document_number", "document_line", "document_type",
            "posting_date", "document_date", "entry_date", "fiscal_year", "fiscal_period",
            "gl_account", "cost_center", "programme_id", "debit_credit_ind",
            "amount_doc_currency", "doc_currency",
            F.col("amount_doc_currency").alias("amount_local_currency"),
            F.col("doc_currency").alias("local_currency"),
            F.round(F.col("amount_doc_currency") * F.col("__rate"), 2).cast("decimal(15,2)")
            .alias("amount_group_currency"),
            F.lit(config.GROUP_CURRENCY).alias("group_currency"),
            "is_intercompany", "ic_partner_company", "posting_user_id",
            F.lit(False).alias("is_reversal"),
            F.lit(None).cast("string").alias("reversed_document"),
        )

    @cached_property
    def journal(self) -> DataFrame:
        from ..operators.ledger import journal_with_derived, with_journal_id

        j = journal_with_derived(self.journal_base, self.rates, self.company, self.dim_date, self.last_covered)
        if self.store is None:
            return j
        with shuffles_for(self.spark, self.line_count):
            return with_journal_id(self._kept("journal", j.drop("journal_id"), "fiscal_year"))  # the key is not stored twice

    @cached_property
    def journal_by_document(self) -> DataFrame:
        """SC9: what document rules read of the journal, bucketed by document; without a store the same columns as they are."""
        journal = self.journal.select(*DOCUMENT_COLUMNS)
        if self.store is None:
            return with_document_key(journal)
        with self._lock:
            if "by_document" not in self._written:
                self._written["by_document"] = f"journal_by_document_{uuid.uuid4().hex}"
                table = self._written["by_document"]
                try:
                    write_by_document(journal, table, f"{self.store}/{table}", document_buckets(self._journal_rows()))
                except BaseException:
                    del self._written["by_document"]
                    raise
        return self.spark.table(self._written["by_document"])

    def _journal_rows(self) -> int:
        """Lines of the stored journal, as its write counted them; a journal that is served from elsewhere is counted."""
        return int(self._written["journal"]) if "journal" in self._written else self.journal.count()

    def _kept(self, name: str, df: DataFrame, *by: str) -> DataFrame:
        """A shared ledger writes ``df`` to its store once, partitioned, and reads it from there, so
        that filters and columns reach the files; without a store the frame itself.  A write that fails
        leaves no commit, so the next question writes again."""
        if self.store is None:
            return df
        path = f"{self.store}/{name}"
        with self._lock:  # queries may run side by side in one session
            if name not in self._written:
                self._written[name] = str(versions.replace_table(df, path, list(by)))
        return versions.read_table(self.spark, path).select(*df.columns)

    def row_counts(self) -> DataFrame:
        """SC4: rows of every finance table, counted while the tables are written; none is scanned for it."""
        if self.store is None:
            return load_counts(self, None)
        for name, df in self.tables().items():
            if name not in self._written:
                self._kept(name, df)
        return versions.row_counts(self.spark, self.store, FINANCE_TABLES)

    @cached_property
    def agg_journal_monthly(self) -> DataFrame | None:
        """The stored monthly aggregate; None without a store."""
        if self.store is None:
            return None
        from ..operators import ledger as lg
        from ..operators import materialise

        vj = lg.harmonised_journal(self.journal, self.company, self.gl_account, self.cost_center,
                                   self.programme_master, self.rates, self.close_schedule)
        return self._kept("agg_journal_monthly", materialise.agg_journal_monthly(vj), "fiscal_year")

    # ----------------------------------------------------- plans and close
    @_bounded_table
    def close_tasks(self) -> DataFrame:
        from ..operators.plan import close_calendar

        # the original lines: no reversals, and no mirrors (whose document numbers start with M)
        lines = self.journal.where(~F.col("is_reversal") & ~F.col("document_number").startswith("M"))
        return self._kept("close_tasks", close_calendar(self.close_schedule, lines, self.dim_date, self.as_of))

    @_bounded_table
    def close_schedule(self) -> DataFrame:
        """Tasks with due dates alone; completion dates take a pass over the lines."""
        from ..operators.plan import close_schedule

        return cut_lineage(close_schedule(self.company, self.periods, self.dim_date))

    @cached_property
    def budget(self) -> DataFrame:
        from ..operators.plan import budget_build

        return self._kept("budget", budget_build(self.journal, self.gl_account, self.fiscal_span))

    @cached_property
    def forecast(self) -> DataFrame:
        from ..operators.plan import forecast_build

        return self._kept("forecast", forecast_build(self.journal, self.dim_date, self.fiscal_span))

    def use_stored_journal(self, journal: DataFrame) -> None:
        """Serve the journal (and everything derived from it) from a stored copy."""
        self.__dict__["journal"] = journal
        for name in ("programme", "budget", "forecast"):
            self.__dict__.pop(name, None)

    def tables(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in FINANCE_TABLES}


JOURNAL_COLUMNS = [
    "journal_id", "company_code", "document_number", "document_line", "document_type",
    "posting_date", "document_date", "entry_date", "fiscal_year", "fiscal_period",
    "gl_account", "cost_center", "programme_id", "debit_credit_ind",
    "amount_doc_currency", "doc_currency", "amount_local_currency", "local_currency",
    "amount_group_currency", "group_currency", "is_intercompany", "ic_partner_company",
    "posting_user_id", "is_reversal", "reversed_document",
]

FINANCE_TABLES = [
    "company", "cost_center", "programme", "gl_account", "dim_date", "close_task",
    "rates", "journal", "budget", "forecast", "close_tasks",
]


_SHARED: dict[tuple[int, str], DemoLedger] = {}


def demo_ledger(spark: SparkSession, sf_dir: str) -> DemoLedger:
    """The session's ledger for a data folder; journal and aggregate are written to the shared
    checkpoint folder once and read back by every query."""
    from ..session import ensure_checkpoint_dir

    key = (id(spark), sf_dir.rstrip("/"))
    ledger_obj = _SHARED.get(key)
    if ledger_obj is None or ledger_obj.spark is not spark:
        store = f"{ensure_checkpoint_dir(spark).rstrip('/')}/ledger-{uuid.uuid4().hex}"
        ledger_obj = DemoLedger(spark, sf_dir, store=store)
        _SHARED[key] = ledger_obj
    return ledger_obj
