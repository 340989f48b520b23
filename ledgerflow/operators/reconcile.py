"""Reconciliation and profiling (RC1-RC4, JN13).

Two results are compared by digests first: each side is grouped into hashed ranges of its keys, one row a range
with its number of rows and, per measure, an order-free digest of keys and values.  Ranges that agree are done;
only the rows of those that differ are joined, which names what is missing and how far values are apart.  Equal
sides, the usual case, are never joined row by row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from ..functions.columns import count_if

#: Ranges of the keys; so many rows a side are compared, and so many numbers at most reach the driver.
RANGES = 4096


def _range_of(keys: list[str]) -> Column:
    # a null key is a value like any other, and the same key may be an int here and a long there
    return F.pmod(F.xxhash64(*[F.coalesce(F.col(k).cast("string"), F.lit("\x00null")) for k in keys]), F.lit(RANGES))


def _plain(df: DataFrame, column: str) -> Column:
    """The value in a form that both sides share: doubles stay, all else is a decimal of eight places."""
    kind = df.schema[column].dataType
    return F.col(column) if isinstance(kind, (DoubleType, FloatType)) else F.col(column).cast("decimal(38,8)")


def _digests(df: DataFrame, keys: list[str], values: dict[str, str], side: str) -> DataFrame:
    key = [F.coalesce(F.col(k).cast("string"), F.lit("\x00null")) for k in keys]
    sums = [F.sum(F.xxhash64(*key, F.coalesce(_plain(df, c).cast("string"), F.lit("\x00null"))).cast("decimal(38,0)")).alias(f"{side}{i}")
            for i, c in enumerate(values.values())]
    return df.groupBy(_range_of(keys).alias("__range")).agg(F.count(F.lit(1)).alias(f"{side}n"), *sums)


def _details(left: DataFrame, right: DataFrame, keys: list[str], values: dict[str, str]) -> dict:
    """What differs, of rows on both sides of a null-safe full outer join."""
    l_ = left.select(*[F.col(k).alias(f"__l_{k}") for k in keys], *[_plain(left, c).alias(f"__lv{i}") for i, c in enumerate(values.values())],
                     F.lit(True).alias("__in_l"))
    r_ = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys], *[_plain(right, c).alias(f"__rv{i}") for i, c in enumerate(values.values())],
                      F.lit(True).alias("__in_r"))
    on = reduce(lambda a, b: a & b, [F.col(f"__l_{k}").eqNullSafe(F.col(f"__r_{k}")) for k in keys])
    both = F.col("__in_l").isNotNull() & F.col("__in_r").isNotNull()
    deltas = []
    for i in range(len(values)):
        lv, rv = F.col(f"__lv{i}"), F.col(f"__rv{i}")
        one_null = both & (lv.isNull() != rv.isNull())
        deltas += [F.max(F.when(both, F.abs(lv - rv))).cast("double").alias(f"d{i}"), count_if(one_null).alias(f"u{i}")]
    return l_.join(r_, on, "full_outer").agg(
        count_if(both).alias("both"), count_if(F.col("__in_l").isNull()).alias("missing_left"),
        count_if(F.col("__in_r").isNull()).alias("missing_right"), *deltas).first().asDict()


def reconcile_measures(left: DataFrame, right: DataFrame, keys: list[str], values: dict[str, str], tol: float = 0.0) -> DataFrame:
    """RC1/JN13 for several measures of the same pair: one row a measure with the rows compared, the keys missing on
    either side, the worst absolute delta and a pass flag.

    ``values`` maps the name of each check to its column.  NULL keys compare equal, and a value that is NULL on one
    side only is an infinite delta.  Keys should be unique; a repeated one shows as differing.
    """
    a, b = _digests(left, keys, values, "a"), _digests(right, keys, values, "b")
    same = reduce(lambda x, y: x & y, [F.col(f"a{k}").eqNullSafe(F.col(f"b{k}")) for k in ("n", *range(len(values)))])
    seen = a.join(b, "__range", "full_outer").agg(
        F.coalesce(F.sum(F.when(same, F.col("an"))), F.lit(0)).alias("equal"), F.collect_list(F.when(~same, F.col("__range"))).alias("ranges")).first()
    found = {"both": 0, "missing_left": 0, "missing_right": 0}
    if seen["ranges"]:
        differ = _range_of(keys).isin(list(seen["ranges"]))
        found = _details(left.where(differ), right.where(differ), keys, values)
    rows = []
    for i, name in enumerate(values):
        delta = float("inf") if found.get(f"u{i}") else round(found.get(f"d{i}") or 0.0, 6)
        lost = found["missing_left"] + found["missing_right"]
        rows.append((name, seen["equal"] + found["both"], found["missing_left"], found["missing_right"], delta, not lost and delta <= tol))
    return left.sparkSession.createDataFrame(
        rows, "check_name string, rows_compared long, missing_left long, missing_right long, max_abs_delta double, passed boolean")


def reconcile(left: DataFrame, right: DataFrame, keys: list[str], value: str, tol: float,
              name: str = "reconcile") -> DataFrame:
    """RC1/JN13: one measure (see ``reconcile_measures``)."""
    return reconcile_measures(left, right, keys, {name: value}, tol)


def reconcile_many(checks: list[tuple[str, DataFrame, DataFrame, list[str], str, float]]) -> DataFrame:
    """RC2: a list of (name, left, right, keys, value, tolerance) checks as one result."""
    return reduce(DataFrame.unionByName, [reconcile(l_, r_, k, v, t, n) for n, l_, r_, k, v, t in checks])


def published_views_nonempty(views: dict[str, DataFrame]) -> DataFrame:
    """RC3: every published view resolves and returns rows (one count per view)."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("view_name"), "row_count")
             for name, df in views.items()]
    return reduce(DataFrame.unionByName, parts).withColumn("nonempty", F.col("row_count") > 0)


def profile_rows(section: str, df: DataFrame, metrics: dict) -> DataFrame:
    """RC4 helper: one aggregate pass of ``df`` -> (section, metric, value) rows."""
    agg = df.agg(*[expr.cast("double").alias(name) for name, expr in metrics.items()])
    stack = "stack({}, {}) as (metric, value)".format(
        len(metrics), ", ".join(f"'{m}', `{m}`" for m in metrics))
    return agg.select(F.expr(stack)).select(F.lit(section).alias("section"), "metric", "value")
