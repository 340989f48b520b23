"""Planning transformations and slice/dice helpers on hand-sized frames."""
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerflow.operators import plan, slicing


def test_weighted_spread_sums_to_annual(spark):
    df = spark.createDataFrame([("C1", 1200.0)], "cell string, annual double")
    w = [4 / 52, 4 / 52, 5 / 52] * 4
    out = plan.plan_spread(df, "annual", w)
    assert out.count() == 12
    assert abs(out.agg(F.sum("amount_period")).first()[0] - 1200.0) < 1e-9


def test_uplift_touches_only_the_targeted_version_and_programme(spark):
    df = spark.createDataFrame(
        [("FC-Q2", "P1", Decimal("100.00")), ("FC-Q1", "P1", Decimal("100.00")), ("FC-Q2", "P2", Decimal("100.00"))],
        "version string, programme_id string, amount_group_currency decimal(15,2)")
    rows = {(r.version, r.programme_id): r.amount_group_currency
            for r in plan.plan_uplift(df, "FC-Q2", "P1", 5.0).collect()}
    assert rows[("FC-Q2", "P1")] == Decimal("105.00")
    assert rows[("FC-Q1", "P1")] == Decimal("100.00") and rows[("FC-Q2", "P2")] == Decimal("100.00")


def test_slice_dice_orders_skips_and_limits_deterministically(spark):
    df = spark.createDataFrame([(k, v) for k, v in [("a", 1), ("b", 3), ("c", 3), ("d", 2), ("a", 5)]],
                               "k string, v int")
    out = slicing.slice_dice(df, group_by=["k"], measures=[("total", "sum", "v")],
                             order_by=[F.col("total").desc()], top=2, skip=1)
    assert [(r.k, r.total) for r in out.collect()] == [("b", 3), ("c", 3)]


def test_topcount_and_bottomcount(spark):
    df = spark.createDataFrame([("a", 1), ("b", 5), ("c", 3)], "k string, v int")
    assert [r.k for r in slicing.topcount(df, ["k"], "v", 2).collect()] == ["b", "c"]
    assert [r.k for r in slicing.topcount(df, ["k"], "v", 1, largest=False).collect()] == ["a"]
