"""Full loads that replace a table as a whole, counts at load, and the layout by document."""

import json
import os
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ledgerflow.operators import publish, quality
from ledgerflow.sources import files, versions


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_replace_counts_and_history(spark, tmp_path):
    root = str(tmp_path / "t")
    assert versions.replace_table(spark.range(7), root) == 7
    old = versions.read_table(spark, root)
    assert versions.replace_table(spark.range(3).withColumn("y", F.col("id") % 2), root, ["y"]) == 3
    assert versions.replace_table(spark.range(0), str(tmp_path / "empty")) == 0
    assert versions.read_table(spark, root).count() == 3 and old.count() == 7  # a reader stays on its version
    assert versions.read_table(spark, root, commit=1).count() == 7
    assert [c["rows"] for c in versions.commits(spark, root)] == [7, 3]
    assert rows(versions.row_counts(spark, str(tmp_path), ["t", "empty"])) == [("empty", 0), ("t", 3)]
    with pytest.raises(ValueError):
        versions.read_table(spark, root, commit=9)


def test_a_killed_load_leaves_the_old_table(spark, tmp_path):
    root = str(tmp_path / "t")
    versions.replace_table(spark.range(5), root)
    broken = spark.range(100, numPartitions=4).withColumn("x", F.when(F.col("id") > 90, F.raise_error(F.lit("killed"))).otherwise(F.lit(1)))
    with pytest.raises(Exception, match="killed"):
        versions.replace_table(broken, root)
    assert versions.read_table(spark, root).count() == 5
    # killed while the commit was being written
    (tmp_path / "t" / versions.COMMITS / "000000000002").write_text(json.dumps({"version": "v-gone"})[:9])
    assert versions.read_table(spark, root).count() == 5
    assert versions.replace_table(spark.range(6), root) == 6  # the same load again
    assert versions.read_table(spark, root).count() == 6 and [c["commit"] for c in versions.commits(spark, root)] == [1, 3]


def test_a_failed_store_of_the_ledger_is_tried_again(spark, ledger, tmp_path):
    from ledgerflow.sources.demo import DemoLedger

    stored = DemoLedger(spark, ledger.sf_dir, store=str(tmp_path / "store"))
    with pytest.raises(Exception, match="killed"):
        stored._kept("probe", spark.range(9).withColumn("x", F.raise_error(F.lit("killed"))))
    assert stored._kept("probe", spark.range(9)).count() == 9


def test_old_versions_are_removed(spark, tmp_path):
    root = str(tmp_path / "t")
    for n in (1, 2, 3, 4):
        versions.replace_table(spark.range(n), root)
    os.makedirs(tmp_path / "t" / "v-running")  # a load that has not committed yet
    kept = {c["version"] for c in versions.commits(spark, root)[-2:]}
    assert len(versions.remove_old(spark, root, keep=2)) == 2
    assert {d for d in os.listdir(root) if d.startswith("v-")} == kept | {"v-running"}
    assert versions.read_table(spark, root).count() == 4
    assert versions.read_table(spark, str(tmp_path / "t" / versions.commits(spark, root)[-1]["version"])).count() == 4  # plain folder


def test_counts_at_load_equal_the_tables(spark, ledger, tmp_path):
    files.materialise_ledger(ledger, str(tmp_path))
    pq = files.ParquetLedger(spark, str(tmp_path))
    got = dict(rows(pq.row_counts()))
    assert len(got) == 11 and all(got[t] == getattr(pq, t).count() for t in got) and got["journal"] == ledger.journal.count()
    assert dict(rows(ledger.row_counts())) == got


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_document_layout_spares_the_shuffle(spark, ledger, tmp_path):
    name = "journal_by_document_test"
    by_document = files.write_by_document(ledger.journal, name, str(tmp_path / "b"), 4)
    try:
        assert {d for d in os.listdir(tmp_path / "b") if "=" in d} == {f"fiscal_year={y}" for y in range(1995, 2002)}
        for rule in (quality.document_rules, quality.reversal_rules):
            plan = plan_of(rule(by_document))
            assert "Exchange hashpartitioning" not in plan and plan.count("Exchange") == 1  # the one-row total
            assert rows(rule(by_document)) == rows(rule(ledger.journal))
        assert by_document.count() == ledger.journal.count()
    finally:
        spark.sql(f"DROP TABLE {name}")


def test_reversal_rules_find_what_does_not_match(spark, ledger):
    j = ledger.journal
    n = j.where("is_reversal").count()
    assert rows(quality.reversal_rules(j)) == [("reversal_match", "journal_reversals", n, 0)]
    one = j.where("is_reversal").orderBy("journal_id").first()
    hit = F.col("journal_id") == one["journal_id"]
    for column, value in (("amount_group_currency", F.col("amount_group_currency") + 1), ("posting_date", F.to_date(F.lit("1995-01-01"))),
                          ("reversed_document", F.lit("nowhere")), ("debit_credit_ind", F.when(F.col("debit_credit_ind") == "S", "H").otherwise("S"))):
        bad = j.withColumn(column, F.when(hit, value).otherwise(F.col(column)))
        assert rows(quality.reversal_rules(bad)) == [("reversal_match", "journal_reversals", n, 1)]


def test_unused_associations_are_not_joined(spark, ledger, tmp_path):
    files.materialise_ledger(ledger, str(tmp_path))
    pq = files.ParquetLedger(spark, str(tmp_path))
    view = publish.journal_interface(pq.journal, pq.company, pq.gl_account, pq.cost_center, pq.programme)
    assert "Join" not in plan_of(view.select("journal_id", "signed_amount_group"))
    named = plan_of(view.select("journal_id", "company_name"))
    assert named.count("BroadcastHashJoin") == 1 and "Exchange hashpartitioning" not in named
    # a side with repeated keys adds no rows
    twice = pq.company.unionByName(pq.company.withColumn("company_name", F.lit("A")))
    doubled = publish.journal_interface(pq.journal, twice, pq.gl_account, pq.cost_center, pq.programme)
    assert doubled.count() == pq.journal.count() and {r[0] for r in doubled.select("company_name").distinct().collect()} == {"A"}


def test_raw_line_rules_count_planted_orphans(spark):
    li = spark.createDataFrame([(1, 1, 1), (1, 9, 1), (2, 1, 9), (3, 1, 1), (9, 1, 1), (4, 9, 9)], "l_orderkey long, l_partkey long, l_suppkey long")
    orders = spark.createDataFrame([(1, 1), (2, 1), (3, 9), (4, None)], "o_orderkey long, o_custkey long")
    customer = spark.createDataFrame([(1, 1), (2, 77)], "c_custkey long, c_nationkey long")
    supplier, nation = spark.createDataFrame([(1, 1)], "s_suppkey long, s_nationkey long"), spark.createDataFrame([(1,)], "n_nationkey long")
    part = spark.createDataFrame([(1,), (1,)], "p_partkey long")
    got = {r["rule"]: (r["rows_checked"], r["violations"]) for r in quality.raw_line_rules(li, orders, customer, supplier, part, nation).collect()}
    assert got == {"raw_line_supplier": (6, 2), "raw_line_part": (6, 2), "raw_line_order": (6, 1), "raw_line_customer": (6, 2), "raw_line_dropped": (6, 5)}


def test_json_of_many_rows_is_several_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "JSON_ONE_FILE_ROWS", 10)
    files.write_json(spark.range(11, numPartitions=3), str(tmp_path / "many"))
    files.write_json(spark.range(10, numPartitions=3), str(tmp_path / "one"))
    count = lambda d: len([f for f in os.listdir(tmp_path / d) if f.endswith(".json")])
    assert count("many") == 3 and count("one") == 1


def test_schema_of_a_versioned_table(spark, tmp_path):
    schema = StructType([StructField("k", StringType())])
    versions.replace_table(spark.createDataFrame([("a",), (None,)], schema), str(tmp_path))
    assert versions.read_table(spark, str(tmp_path)).schema == schema


def test_partitioned_writes_need_no_sort_by_folder(spark, tmp_path, monkeypatch):
    """F4-F14: a task's rows are not sorted by folder before they are written, whatever the number of folders."""
    from pyspark.sql.readwriter import DataFrameWriter

    key, seen, write = "spark.sql.maxConcurrentOutputFileWriters", [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda w, *a, **k: (seen.append(spark.conf.get(key)), write(w, *a, **k))[1])
    folders = versions.OPEN_FOLDERS + 9
    rows = spark.range(2000).selectExpr("id", f"nullif(cast(id % {folders} as int), 0) AS y")
    before = spark.conf.get(key, "0")
    assert versions.replace_table(rows, str(tmp_path / "t"), ["y"]) == 2000
    assert seen == [str(versions.OPEN_FOLDERS)] and spark.conf.get(key) == before
    got = versions.read_table(spark, str(tmp_path / "t")).select("id", "y")
    assert got.exceptAll(rows).isEmpty() and rows.exceptAll(got).isEmpty()


def test_buckets_of_documents_grow_with_the_journal():
    """what a task sorts for the layout by document has a bound."""
    assert files.document_buckets(0) == files.document_buckets(files.BUCKET_ROWS * files.DOCUMENT_BUCKETS) == files.DOCUMENT_BUCKETS
    assert files.document_buckets(files.BUCKET_ROWS * 264 + 1) == 265


def test_journal_tasks_grow_in_number_with_the_lines(spark, ledger, tmp_path, monkeypatch):
    from ledgerflow import session
    from ledgerflow.sources.demo import DemoLedger

    want = ledger.journal
    monkeypatch.setattr(session, "TASK_ROWS", 200)
    set_to = spark.conf.get("spark.sql.shuffle.partitions")
    stored = DemoLedger(spark, ledger.sf_dir, store=str(tmp_path))
    tasks = session.tasks_for(spark, stored.line_count)
    assert tasks == -(-stored.line_count // 200) > int(set_to)
    assert stored.journal_base.rdd.getNumPartitions() == tasks
    got = stored.journal
    assert spark.conf.get("spark.sql.shuffle.partitions") == set_to
    assert got.count() == want.count() and got.exceptAll(want.select(*got.columns)).isEmpty()
    with session.shuffles_for(spark, 10 ** 6):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "5000"
        with session.shuffles_for(spark, 1):  # never fewer than are set
            assert spark.conf.get("spark.sql.shuffle.partitions") == "5000"


def test_derived_lines_are_made_in_methods_that_the_jvm_compiles(spark, ledger, capsys):
    from ledgerflow.operators.ledger import journal_with_derived

    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        journal_with_derived(ledger.journal_base, ledger.rates, ledger.company, ledger.dim_date, ledger.last_covered).drop("journal_id").explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) < 8000
