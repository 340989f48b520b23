"""Connected components of a graph of long ids, by alternating stars.

Each round hangs every node on the smallest node it sees (large star), then on the smallest
of those below it (small star), until no edge moves.  Rounds are cut by checkpoints; the smallest neighbour
is a partial aggregate, and a hub's edges are split by the skew join of adaptive execution, so
no component ever meets in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed

MAX_ROUNDS = 60


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*").alias("n"),
                    F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """``edges`` (u > v) after one star operation."""
    seen = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    lowest = seen.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    joined = seen.join(lowest, "u")
    if large:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                              F.struct(F.col("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
    return out.where("u <> v").distinct()


def components(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, root)`` for every node of ``pairs`` that is not the smallest of its component."""
    edges = checkpointed(pairs.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                         .where("u <> v").distinct())
    before = _state(edges)
    for _ in range(MAX_ROUNDS):
        if before[0] == 0:
            break
        edges = checkpointed(_star(edges, large=True))
        edges = checkpointed(_star(edges, large=False))
        after = _state(edges)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
