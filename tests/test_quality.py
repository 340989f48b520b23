"""Data-quality rules: clean on the demo ledger, and they catch deliberately broken rows."""
import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerflow.operators import quality

D = dt.date


def _violations(df):
    return {(r.table_name, r.rule): r.violations for r in df.collect()}


def test_demo_ledger_is_clean_except_documented_rules(ledger):
    v = _violations(quality.qc_summary(ledger))
    # Lines of the furniture programme continue after its end date (a demo story, QC7 reports it).
    expected_nonzero = {("journal", "programme_window_non_reversal"), ("journal", "programme_window_reversal")}
    dirty = {k for k, n in v.items() if n and k not in expected_nonzero}
    assert not dirty, dirty
    assert v[("journal", "programme_window_non_reversal")] > 0


def test_rules_catch_broken_rows(spark, ledger):
    j = ledger.journal
    row = j.where("NOT is_reversal AND NOT is_intercompany AND cost_center IS NOT NULL").limit(1)
    broken = (
        row.withColumn("journal_id", F.lit(-1).cast("long"))
        .withColumn("entry_date", F.date_sub("posting_date", 3))           # date order
        .withColumn("gl_account", F.lit("999999"))                         # orphan account
        .withColumn("amount_group_currency", F.lit(Decimal("-1.00")).cast("decimal(15,2)"))  # negative
        .withColumn("posting_user_id", F.lit("bob"))                       # not a token
    )
    bad = j.unionByName(broken)
    v = _violations(quality.journal_row_rules(bad, ledger.company, ledger.gl_account, ledger.cost_center,
                                              ledger.programme, ledger.rates))
    for rule in ("date_order", "fk_gl_account", "unsigned_amounts", "user_token_pattern"):
        assert v[("journal", rule)] >= 1, rule
    dup = j.unionByName(j.limit(3))
    pk = quality.primary_key_rule(dup, "journal", ["journal_id"]).first()
    assert pk.violations == 3


def test_driver_tables_have_real_violations(spark):
    v = _violations(quality.driver_table_rules(spark, "/root/testdata/sf0.001"))
    assert v[("lineitem", "primary_key")] > 0
    assert v[("lineitem", "ship_before_order")] > 0


def test_document_rules_detect_gaps_and_mixed_headers(spark):
    rows = [("D1", 1, "CO0", 2000, 1, "SA"), ("D1", 3, "CO0", 2000, 1, "SA"),
            ("D2", 1, "CO0", 2000, 1, "SA"), ("D2", 2, "CO1", 2000, 1, "SA")]
    df = spark.createDataFrame(rows, "document_number string, document_line int, company_code string, "
                                     "fiscal_year int, fiscal_period int, document_type string")
    v = _violations(quality.document_rules(df))
    assert v[("journal_documents", "line_numbering")] == 1
    assert v[("journal_documents", "header_consistency")] == 1
