"""Hierarchy walks and order statistics against plain Python."""

import random
from collections import Counter, defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerflow.operators import hierarchy, ordering

EDGES = [("g", None), ("a", "g"), ("b", "g"), ("a1", "a"), ("a2", "a"), ("deep1", "a2"), ("deep2", "deep1"), ("deep3", "deep2"),
         ("other", None), ("lone", "gone"), ("x", "y"), ("y", "z"), ("z", "x"), ("hang", "x"), ("hang2", "hang"), ("self", "self"),
         ("two", "b"), ("two", "a"), ("a1", "a"), (None, "g")]


@pytest.fixture
def spread(spark):
    """Small tables stay in as many partitions as asked for."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    yield
    spark.conf.unset(key)


@pytest.fixture(scope="module")
def tree(spark):
    return hierarchy.walk(spark.createDataFrame(EDGES, "node_id string, parent_id string")).cache()


def test_walk_of_ragged_branches(tree):
    paths = {r["node_id"]: r["path"] for r in tree.collect()}
    assert paths["deep3"] == ["g", "a", "a2", "deep1", "deep2", "deep3"] and paths["b"] == ["g", "b"]
    assert paths["lone"] == ["lone"] and paths["self"] == ["self"] and paths["two"] == ["g", "a", "two"]
    assert not set(paths) & {"x", "y", "z", "hang", "hang2", None} and len(paths) == tree.count()
    assert all(r["depth"] == len(r["path"]) - 1 for r in tree.collect())


def test_every_node_is_the_sum_of_its_children_and_its_own(spark, tree):
    rng = random.Random(1)
    facts = [(rng.choice(["a1", "deep3", "deep1", "b", "two", "lone", "x", "nowhere", None]), rng.randint(-9, 9)) for _ in range(500)]
    got = {r["node_id"]: r for r in hierarchy.node_sums(spark.createDataFrame(facts, "k string, m long"), "k", ["m"], tree).collect()}
    own = Counter()
    for k, m in facts:
        own[k] += m
    children = defaultdict(list)
    for n, r in got.items():
        children[r["parent_id"]].append(n)
    for n, r in got.items():
        if n != hierarchy.UNASSIGNED:
            assert (r["m"] or 0) == own[n] + sum(got[c]["m"] or 0 for c in children[n]), n
            assert r["is_leaf"] == (not children[n])
    assert got[hierarchy.UNASSIGNED]["m"] == own["x"] + own["nowhere"] + own[None]
    assert sum(got[n]["m"] or 0 for n in children[None]) == sum(m for _, m in facts)


def test_faults_are_reported(spark, tree):
    nodes = spark.createDataFrame(EDGES, "node_id string, parent_id string")
    got = {(r["node_id"], r["fault"]) for r in hierarchy.hierarchy_faults(nodes, tree).collect()}
    assert got == {("x", "cycle"), ("y", "cycle"), ("z", "cycle"), ("self", "cycle"), ("hang", "below_cycle"), ("hang2", "below_cycle"),
                   ("two", "two_parents"), ("lone", "missing_parent")}


def test_empty_hierarchy(spark):
    none = spark.createDataFrame([], "node_id string, parent_id string")
    tree = hierarchy.walk(none)
    assert tree.count() == 0 and hierarchy.hierarchy_faults(none, tree).count() == 0
    facts = spark.createDataFrame([("a", 2), (None, 3)], "k string, m long")
    assert [(r["node_id"], r["m"]) for r in hierarchy.node_sums(facts, "k", ["m"], tree).collect()] == [(hierarchy.UNASSIGNED, 5)]


@pytest.mark.parametrize("slices", [1, 4, 40])
def test_numbers_of_a_hot_document(spark, spread, slices):
    """A document with a third of all lines, one with none but equal lines, null keys: same numbers as one window."""
    rng = random.Random(slices)
    rows = [("hot", rng.randint(0, 10**9), k) for k in range(2000)] + [("same", 7, -1)] * 1500 + [(None, k, k) for k in range(300)]
    rows += [(f"d{rng.randint(0, 600)}", rng.randint(0, 50), 5000 + k) for k in range(2200)]
    rng.shuffle(rows)
    spark.conf.set("spark.sql.shuffle.partitions", str(slices))
    try:
        df = spark.createDataFrame(rows, "d string, a long, b long").repartition(7)
        got = ordering.number_rows(df, ["d"], ["a", "b"], "line").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    want, seen = Counter(), Counter()
    for d, a, b in sorted(rows, key=lambda r: (str(r[0]), r[1], r[2])):
        seen[d] += 1
        want[d, a, b, seen[d]] += 1
    assert Counter((r["d"], r["a"], r["b"], r["line"]) for r in got) == want


def test_only_hot_documents_are_dealt_to_slices(spark, monkeypatch):
    """Numbers of hot and other documents are those of one window; without a hot key nothing is dealt to slices."""
    from ledgerflow.operators.ledger import number_lines

    rows = [("hot" if k % 3 == 0 else f"d{k % 50}", k % 2, (k * 37) % 1000, k) for k in range(900)] + [(None, 0, 1, 1)]
    df = spark.createDataFrame(rows, "d string, r int, a int, b int").repartition(5)
    window = Window.partitionBy("d", "r").orderBy("a", "b")
    want = sorted(map(tuple, df.where("d is not null").withColumn("line", F.row_number().over(window)).collect()))

    def number():
        return number_lines(df, "d", lambda lines: lines.where("d is not null"), df.select("d"), ["d", "r"], ["a", "b"], "line")

    monkeypatch.setattr(ordering, "HOT_ROWS", 100)
    assert [r["d"] for r in ordering.heavy_keys(df, "d").collect()] == ["hot"]
    assert sorted(map(tuple, number().collect())) == want
    monkeypatch.setattr(ordering, "HOT_ROWS", 1000)
    assert ordering.heavy_keys(df, "d") is None
    plain = number()
    assert sorted(map(tuple, plain.collect())) == want
    plan = plain._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan


def test_slices_of_a_hot_document_are_even(spark, spread):
    df = spark.range(0, 90000, 1, 6).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("d"), "id")
    sizes = sorted(r["n"] for r in ordering.in_order(df, "d", "id").groupBy("__slice").agg(F.count("*").alias("n")).collect())
    assert len(sizes) == 8 and sizes[-1] < 2 * sizes[len(sizes) // 2]


def test_pages_anywhere(spark, spread):
    df = spark.range(0, 5000, 1, 5).select((F.col("id") * 7919 % 5000).alias("v"))
    for skip, top in ((0, 10), (20, 10), (2490, 25), (4995, 10), (6000, 5), (7, 0)):
        assert [r["v"] for r in ordering.page(df, ["v"], skip, top).collect()] == list(range(5000))[skip:skip + top]


@pytest.mark.parametrize("n", [1, 2, 999, 1000])
def test_exact_median(spark, n):
    rng = random.Random(n)
    values = [Decimal(rng.randint(-10**15, 10**17)).scaleb(-2) if rng.random() < 0.5 else Decimal("12.34") for _ in range(n)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)] * 3, "v decimal(28,2)").repartition(3)
    ordered = sorted(values)
    assert ordering.exact_median(df, "v") == (float(ordered[(n - 1) // 2]) + float(ordered[n // 2])) / 2
    assert ordering.exact_median(df.where("v is null"), "v") is None
