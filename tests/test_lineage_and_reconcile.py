"""Column lineage, reconciliation by key ranges, grouping sets and the table function."""

import math

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerflow.operators import kpis, lineage, reconcile, slicing, sql_functions


@pytest.fixture(scope="module")
def people(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("people"))
    spark.createDataFrame([(1, "USR-00000A", "x"), (2, "USR-00000B", "y"), (3, None, "y")], "id int, posting_user_id string, grp string").write.parquet(path + "/p")
    return spark.read.parquet(path + "/p")


def sources(df):
    return {c: set(s) for c, s in lineage.column_sources(df).items()}


def test_lineage_through_every_kind_of_node(spark, people):
    user = "posting_user_id"
    assert sources(people.select("id", F.col(user).alias("clerk")))["clerk"] == {(user, "renamed")}
    twice = people.select(F.col(user).alias("a")).select(F.col("a").alias("b"), F.upper("a").alias("c"))
    assert sources(twice) == {"b": {(user, "renamed")}, "c": {(user, "computed")}}
    agg = people.groupBy(F.col("grp").alias("g")).agg(F.max(user).alias("last"), F.count("*").alias("n"), F.count_distinct(user).alias("users"))
    assert sources(agg) == {"g": {("grp", "renamed")}, "last": {(user, "computed")}, "n": set(), "users": {(user, "computed")}}
    window = people.withColumn("prev", F.lag(user).over(Window.partitionBy("grp").orderBy("id"))).drop(user)
    assert sources(window)["prev"] == {(user, "computed"), ("grp", "computed"), ("id", "computed")} or (user, "computed") in sources(window)["prev"]
    union = people.select("grp").union(people.select(F.col(user)))
    assert sources(union)["grp"] == {("grp", "as is"), (user, "renamed")}
    joined = people.select("id", "grp").join(people.select("id", F.col(user).alias("who")), "id", "left")
    assert sources(joined)["who"] == {(user, "renamed")} and sources(joined)["grp"] == {("grp", "as is")}
    exploded = people.select("id", F.explode(F.split(user, "-")).alias("part"))
    assert sources(exploded)["part"] == {(user, "computed")}
    packed = people.select(F.struct("id", user).alias("s")).select(F.col("s.id").alias("x"))
    assert (user, "computed") in sources(packed)["x"]  # members of a struct are not told apart, which errs on the safe side
    people.createOrReplaceTempView("people")
    scalar = spark.sql("SELECT id, (SELECT max(posting_user_id) FROM people) AS top FROM people")
    assert (user, "computed") in sources(scalar)["top"] and sources(scalar)["id"] == {("id", "as is")}
    assert sources(people.where(F.col(user).isNotNull()).select("id")) == {"id": {("id", "as is")}}
    python = people.mapInPandas(lambda it: it, "id int, posting_user_id string, grp string").select(F.col("grp").alias("z"))
    assert (user, "computed") in sources(python)["z"]  # a Python function can move any value anywhere


def test_exposure_by_plan_and_by_value(people):
    views = {"clean": people.select("id", "grp"), "renamed": people.select(F.col("posting_user_id").alias("clerk"), "grp"),
             "hidden": people.select(F.sha2("posting_user_id", 256).alias("h")), "pasted": people.select(F.lit("USR-00000A").alias("note"))}
    got = {r["view_name"]: (r["columns_by_lineage"], r["columns_with_tokens"], r["passed"]) for r in lineage.exposure(views).collect()}
    assert got == {"clean": (0, 0, True), "renamed": (1, 1, False), "hidden": (1, 0, False), "pasted": (0, 1, False)}


@pytest.fixture(scope="module")
def side(spark):
    return spark.range(20000).select(F.col("id").alias("k"), F.when(F.col("id") % 7 != 0, F.concat(F.lit("g"), F.col("id") % 5)).alias("g"),
                                     (F.col("id") * 3 / 100).cast("decimal(20,2)").alias("v"), (F.col("id") % 11).alias("w"))


def verdict(df):
    return {r["check_name"]: tuple(r)[1:] for r in df.collect()}


def test_equal_sides_are_not_joined_row_by_row(spark, side, monkeypatch):
    monkeypatch.setattr(reconcile, "_details", lambda *a: pytest.fail("rows were joined"))
    other = side.select(F.col("k").cast("int").alias("k"), "g", F.col("v").cast("decimal(38,8)").alias("v"), F.col("w").cast("int").alias("w")).repartition(3)
    got = verdict(reconcile.reconcile_measures(side, other, ["k", "g"], {"a": "v", "b": "w"}))
    assert got == {"a": (20000, 0, 0, 0.0, True), "b": (20000, 0, 0, 0.0, True)}
    none = side.limit(0)
    assert verdict(reconcile.reconcile_measures(none, none, ["k"], {"a": "v"})) == {"a": (0, 0, 0, 0.0, True)}


def test_planted_differences_are_found(spark, side):
    off = side.withColumn("v", F.when(F.col("k") == 777, F.col("v") + 5).otherwise(F.col("v"))).where("k <> 5").unionByName(
        side.limit(1).withColumn("k", F.lit(-1).cast("long")))
    got = verdict(reconcile.reconcile_measures(side, off, ["k", "g"], {"a": "v", "b": "w"}, tol=6.0))
    assert got == {"a": (19999, 1, 1, 5.0, False), "b": (19999, 1, 1, 0.0, False)}
    near = side.withColumn("v", F.when(F.col("k") == 777, F.col("v") + 5).otherwise(F.col("v")))
    assert verdict(reconcile.reconcile(side, near, ["k", "g"], "v", 5.0, "n"))["n"] == (20000, 0, 0, 5.0, True)
    assert verdict(reconcile.reconcile(side, near, ["k", "g"], "v", 4.9, "n"))["n"][-1] is False
    lost = side.withColumn("v", F.when(F.col("k") != 777, F.col("v")))
    assert verdict(reconcile.reconcile(side, lost, ["k", "g"], "v", 5.0, "n"))["n"] == (20000, 0, 0, math.inf, False)
    assert verdict(reconcile.reconcile(side, side.limit(0), ["k", "g"], "v", 0.0, "n"))["n"] == (0, 0, 20000, 0.0, False)


def test_concatenated_levels_take_one_pass(side):
    out = slicing.query_concat(side, {"all": [], "by_g": ["g"], "by_gw": ["g", "w"]}, [("s", "sum", "v"), ("n", "count", "k")])
    got = {(r["level"], r["g"], r["w"]): (r["s"], r["n"]) for r in out.collect()}
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Range (") == 1
    want = {}
    for level, keys in (("all", []), ("by_g", ["g"]), ("by_gw", ["g", "w"])):
        for r in side.groupBy(*keys).agg(F.sum("v").alias("s"), F.count("k").alias("n")).collect():
            want[level, r["g"] if "g" in keys else None, r["w"] if "w" in keys else None] = (r["s"], r["n"])
    assert got == want and ("by_g", None, None) in got  # a null group is not mistaken for a total
    with pytest.raises(ValueError):
        slicing.query_concat(side, {"a": ["g"], "b": ["g"]}, [("n", "count", "k")])


def test_runrate_table_function(spark, ctx):
    name = sql_functions.register_runrate(spark, ctx.vj, ctx.L.programme, "tf_runrate_test")
    columns = ["programme_id", "actuals_to_date", "run_rate", "remaining_periods", "eac", "eac_vs_budget_pct"]
    for year, period, window in ((2001, 6, 3), (1999, 12, 1), (2000, 2, 12), (1990, 1, 3)):
        want = kpis.programme_runrate(ctx.vj, ctx.L.programme, year, period, window).select(*columns)
        assert sorted(map(tuple, sql_functions.runrate(spark, name, year, period, window).select(*columns).collect())) == sorted(map(tuple, want.collect()))
    months = spark.sql(f"SELECT p, count(*) AS n FROM VALUES (3), (6) AS v(p), LATERAL {name}(2001, p, 3) GROUP BY p")
    assert {r["p"]: r["n"] for r in months.collect()} == {3: 5, 6: 5}
