"""Parent-child hierarchies: walk, node sums, faults (AG16).

A hierarchy is a table of (node, parent).  ``walk`` goes down from the roots level by level, one join a
level, and gives every node its path; a node is visited once, so the work is the number of nodes
and not of (node, ancestor) pairs.  Depth is not fixed and branches may end at any level.  What no root
reaches hangs on a cycle and is reported by ``hierarchy_faults`` instead of being walked for ever.

``node_sums`` adds measures up to every node.  Facts are summed by their own node first, so only one row
a node is expanded to its path, however many facts there are.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

UNASSIGNED = "(unassigned)"


def edges(nodes: DataFrame, node: str = "node_id", parent: str = "parent_id") -> DataFrame:
    """One ``(node_id, parent_id)`` row a node.

    Repeated rows count once; of several parents the smallest leads, a parent that is no node itself (or is
    the node) counts as none.  Rows without a node are left out.
    """
    one = (nodes.where(F.col(node).isNotNull()).groupBy(F.col(node).alias("node_id"))
           .agg(F.min(F.when(F.col(parent) != F.col(node), F.col(parent))).alias("__parent")))
    known = one.select(F.col("node_id").alias("__parent"), F.lit(True).alias("__known"))
    return one.join(known, "__parent", "left").select("node_id", F.when(F.col("__known"), F.col("__parent")).alias("parent_id"))


def walk(nodes: DataFrame, node: str = "node_id", parent: str = "parent_id") -> DataFrame:
    """``(node_id, parent_id, depth, path)`` of every node that a root reaches; ``path`` leads from the root to the node.

    Each level is one join of the last level with the edges, whose lineage is cut; the number of levels is that of the
    hierarchy.
    """
    e = cut_lineage(edges(nodes, node, parent))
    level = e.where(F.col("parent_id").isNull()).select("node_id", "parent_id", F.lit(0).alias("depth"), F.array("node_id").alias("path"))
    levels = []
    while not level.isEmpty():
        levels.append(level)
        above = level.select(F.col("node_id").alias("parent_id"), "depth", "path")
        level = cut_lineage(e.join(above, "parent_id").select(
            "node_id", "parent_id", (F.col("depth") + 1).alias("depth"), F.concat("path", F.array("node_id")).alias("path")))
    return reduce(DataFrame.unionByName, levels) if levels else level


def node_sums(facts: DataFrame, key: str, measures: list[str], tree: DataFrame) -> DataFrame:
    """``(node_id, parent_id, depth, is_leaf, measures)``: every node of a walked tree with the sums of all facts below it.

    A node without facts has null sums.  Facts whose key is no node of the tree are summed in a node ``(unassigned)``
    of their own, so that the roots and it add up to the total.
    """
    own = facts.groupBy(F.col(key).alias("node_id")).agg(*[F.sum(m).alias(m) for m in measures])
    placed = own.join(tree.select("node_id", "path"), "node_id", "left")
    spread = placed.select(F.explode(F.coalesce("path", F.array(F.lit(UNASSIGNED)))).alias("node_id"), *measures)
    sums = spread.groupBy("node_id").agg(*[F.sum(m).alias(m) for m in measures])
    parents = tree.where(F.col("parent_id").isNotNull()).select(F.col("parent_id").alias("node_id")).distinct().withColumn("__inner", F.lit(True))
    named = (tree.select("node_id", "parent_id", "depth").join(parents, "node_id", "left")
             .select("node_id", "parent_id", "depth", F.col("__inner").isNull().alias("is_leaf")))
    known = named.join(sums, "node_id", "left")
    rest = sums.where(F.col("node_id") == UNASSIGNED).select(
        "node_id", F.lit(None).cast("string").alias("parent_id"), F.lit(0).alias("depth"), F.lit(True).alias("is_leaf"), *measures)
    return known.unionByName(rest)


def hierarchy_faults(nodes: DataFrame, tree: DataFrame, node: str = "node_id", parent: str = "parent_id") -> DataFrame:
    """``(node_id, fault)``: ``cycle`` (on one), ``below_cycle``, ``two_parents`` or ``missing_parent``.

    Nodes on a cycle are those of the unreached ones that stay when nodes without children are taken off
    again and again.
    """
    given = nodes.where(F.col(node).isNotNull()).select(F.col(node).alias("node_id"), F.col(parent).alias("parent_id")).distinct()
    several = given.groupBy("node_id").agg(F.count_distinct("parent_id").alias("n")).where("n > 1").select("node_id", F.lit("two_parents").alias("fault"))
    own = given.where(F.col("parent_id") == F.col("node_id")).select("node_id", F.lit("cycle").alias("fault"))
    ids = given.select(F.col("node_id").alias("parent_id")).distinct()
    orphans = (given.where(F.col("parent_id").isNotNull()).join(ids, "parent_id", "left_anti")
               .select("node_id", F.lit("missing_parent").alias("fault")).distinct())
    lost = cut_lineage(edges(nodes, node, parent).join(tree.select("node_id"), "node_id", "left_anti"))
    core, before = lost, lost.count()
    while before:
        core = cut_lineage(core.join(core.select(F.col("parent_id").alias("node_id")).distinct(), "node_id", "left_semi"))
        after = core.count()
        if after == before:
            break
        before = after
    on = core.select("node_id", F.lit(True).alias("__on"))
    looped = lost.join(on, "node_id", "left").select("node_id", F.when(F.col("__on"), "cycle").otherwise("below_cycle").alias("fault"))
    return reduce(DataFrame.unionByName, [several, own, orphans, looped])


def cost_center_nodes(cost_center: DataFrame) -> DataFrame:
    """The cost-centre hierarchy as (node_id, parent_id, node_name): every edge that the master data name.

    A centre hangs on its ``parent_id``; departments, divisions and entities come from the columns that name them.
    """
    centre = cost_center.select(F.col("cost_center").alias("node_id"), "parent_id", F.col("cost_center_name").alias("node_name"))
    department = cost_center.select(F.col("department_id").alias("node_id"), F.col("division_id").alias("parent_id"),
                                    F.col("department_name").alias("node_name"))
    division = cost_center.select(F.col("division_id").alias("node_id"), F.col("company_code").alias("parent_id"),
                                  F.col("division_name").alias("node_name"))
    entity = cost_center.select(F.col("company_code").alias("node_id"), F.lit(None).cast("string").alias("parent_id"),
                                F.col("company_code").alias("node_name"))
    return reduce(DataFrame.unionByName, [centre, department.distinct(), division.distinct(), entity.distinct()])


def account_nodes(gl_account: DataFrame) -> DataFrame:
    """The account hierarchy as (node_id, parent_id, node_name): account, group, section of the P&L."""
    account = gl_account.select(F.col("gl_account").alias("node_id"), F.col("account_group").alias("parent_id"),
                                F.col("gl_account_name").alias("node_name"))
    group = gl_account.select(F.col("account_group").alias("node_id"), F.col("pl_section").alias("parent_id"),
                              F.col("account_group_name").alias("node_name"))
    section = gl_account.select(F.col("pl_section").alias("node_id"), F.lit("P&L").alias("parent_id"), F.col("pl_section").alias("node_name"))
    root = gl_account.select(F.lit("P&L").alias("node_id"), F.lit(None).cast("string").alias("parent_id"), F.lit("Profit and loss").alias("node_name"))
    return reduce(DataFrame.unionByName, [account, group.distinct(), section.distinct(), root.distinct()])
