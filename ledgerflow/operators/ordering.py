"""Positions and order statistics over whole tables, without a hot task (WN4, TK3, AG13).

``in_order`` deals rows to range partitions (slices) of a total order and stores them sorted.  A group of any size
is spread over as many slices as it needs, and the rows before a slice are a prefix sum over one row a slice.
``number_rows`` and ``page`` build on it.  ``exact_median`` narrows value ranges by counting.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from ..functions.hints import bounded
from ..session import cut_lineage, stored_table

#: Value ranges counted in a round of the median.
RANGES = 1024

#: Rows of one key up to which a single task sorts them, and the bins in which rows are counted to find keys of more.
HOT_ROWS = 1 << 18
BINS = 1 << 16

_SLICE, _PLACE = "__slice", "__place"


def in_order(df: DataFrame, *order: Column | str) -> DataFrame:
    """``df`` stored in slices of the order, with ``__slice`` and ``__place`` (from 0 in the slice)."""
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    at = F.monotonically_increasing_id()  # slice number above 33 bits of place
    stored = stored_table(dealt.withColumn("__at", at))
    return stored.withColumn(_SLICE, F.shiftright("__at", 33)).withColumn(_PLACE, F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))).drop("__at")


def number_rows(df: DataFrame, group: list[str], order: list[str], out: str) -> DataFrame:
    """``df`` with the row number of each row in its group by ``order`` (a total order, or equal rows in any order).

    A slice holds runs of groups in order, and only the group that a slice begins with has rows in earlier ones.  So
    rows are numbered by (slice, group), and the first group's rows add what the slices before hold of it: one row a
    slice is broadcast.  Groups with null members count like any other.
    """
    keys = F.struct(*group)
    dealt = in_order(df, *group, *order)
    runs = dealt.groupBy(_SLICE).agg(
        F.min_by(keys, _PLACE).alias("__first"), F.max_by(keys, _PLACE).alias("__last"))
    ends = runs.select(_SLICE, F.col("__last").alias("__key"))
    tail = (dealt.join(bounded(ends), _SLICE).where(keys.eqNullSafe(F.col("__key")))
            .groupBy(_SLICE).agg(F.count("*").alias("__tail")))
    runs = cut_lineage(runs.join(tail, _SLICE))
    # rows of a slice's last group up to its end: its tail, and what came before if the slice is all of that group
    line = Window.orderBy(_SLICE)  # one row a slice
    goes_on = F.coalesce(F.lag("__last").over(line).eqNullSafe(F.col("__first")), F.lit(False))
    runs = runs.withColumn("__goes_on", goes_on)
    anew = ~(F.col("__goes_on") & F.col("__first").eqNullSafe(F.col("__last")))
    runs = runs.withColumn("__chain", F.sum(anew.cast("int")).over(line))
    runs = runs.withColumn("__sum", F.sum("__tail").over(Window.partitionBy("__chain").orderBy(_SLICE)))
    before = F.when(F.col("__goes_on"), F.lag("__sum").over(line)).otherwise(0)
    offsets = cut_lineage(runs.select(_SLICE, "__first", before.alias("__before")))
    # a slice's rows go to one task again, which numbers its groups apart
    inner = F.row_number().over(Window.partitionBy(_SLICE, *group).orderBy(_PLACE))
    numbered = dealt.repartitionByRange(_SLICE).withColumn("__n", inner).join(bounded(offsets), _SLICE, "left")
    number = F.col("__n") + F.when(keys.eqNullSafe(F.col("__first")), F.col("__before")).otherwise(0)
    return numbered.withColumn(out, number.cast("int")).drop(_SLICE, _PLACE, "__n", "__first", "__before")


def heavy_keys(df: DataFrame, key: str) -> DataFrame | None:
    """The values of ``key`` with more than HOT_ROWS rows, None without any; nulls are left out.

    Rows are counted by hash bin first, and by key only in the bins that hold so many: no count of all keys is
    shuffled.  The result has at most one row for HOT_ROWS of ``df``.
    """
    rows = df.where(F.col(key).isNotNull()).select(key, F.pmod(F.xxhash64(key), F.lit(BINS)).alias("__bin"))
    full = cut_lineage(rows.groupBy("__bin").agg(F.count("*").alias("__n")).where(F.col("__n") > HOT_ROWS).select("__bin"))
    if full.isEmpty():
        return None
    counts = rows.join(bounded(full), "__bin").groupBy(key).agg(F.count("*").alias("__n"))
    found = cut_lineage(counts.where(F.col("__n") > HOT_ROWS).select(key))
    return None if found.isEmpty() else found


def page(df: DataFrame, order: list[Column | str], skip: int, top: int) -> DataFrame:
    """TK3: ``top`` rows behind the first ``skip`` of a total order, wherever the page lies.

    The slices that hold the page are found by their counts (one row a slice); only their rows in question are merged.
    """
    dealt = in_order(df, *order)
    sizes = dealt.groupBy(_SLICE).agg(F.count("*").alias("__n"))
    starts = sizes.select(_SLICE, (F.sum("__n").over(Window.orderBy(_SLICE)) - F.col("__n")).alias("__start"))
    at = F.col("__start") + F.col(_PLACE)
    rows = dealt.join(bounded(starts), _SLICE).where((at >= skip) & (at < skip + top))
    return rows.orderBy(_SLICE, _PLACE).drop(_SLICE, _PLACE, "__start")


def kth_value(values: DataFrame, column: str, places: list[int]) -> dict[int, int]:
    """The whole numbers at the given places (from 1) of the sorted column; nulls are left out.

    Each round counts the values in RANGES equal ranges between the bounds and goes on with the range that holds the
    place, until that is one number wide.  A round sends one row a range to the driver.
    """
    found = {}
    rows = values.where(F.col(column).isNotNull()).select(F.col(column).cast("decimal(38,0)").alias("v"))
    ends = rows.agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.count("*").alias("n")).first()
    for place in places:
        if not 1 <= place <= ends["n"]:
            continue
        lo, hi, left = int(ends["lo"]), int(ends["hi"]), place
        while lo < hi:
            width = -(-(hi - lo + 1) // RANGES)
            inside = rows.where(F.col("v").between(F.lit(Decimal(lo)), F.lit(Decimal(hi))))
            bin_ = F.expr(f"(v - CAST('{lo}' AS DECIMAL(38, 0))) div CAST('{width}' AS DECIMAL(38, 0))")
            counts = {r["b"]: r["n"] for r in inside.groupBy(bin_.alias("b")).agg(F.count("*").alias("n")).collect()}
            for b in sorted(counts):
                if left <= counts[b]:
                    lo, hi = lo + b * width, min(hi, lo + (b + 1) * width - 1)
                    break
                left -= counts[b]
        found[place] = lo
    return found


def exact_median(df: DataFrame, column: str) -> float | None:
    """AG13: the exact median of a decimal or whole-number column (the mean of the middle two), None without values."""
    kind = df.schema[column].dataType
    scale = kind.scale if isinstance(kind, DecimalType) else 0
    whole = cut_lineage(df.where(F.col(column).isNotNull())
                        .select((F.col(column).cast(f"decimal(38,{scale})") * F.lit(10 ** scale).cast("decimal(20,0)")).cast("decimal(38,0)").alias("v")))
    n = whole.count()
    middle = kth_value(whole, "v", [(n + 1) // 2, n // 2 + 1])
    return sum(float(Decimal(v).scaleb(-scale)) for v in (middle[(n + 1) // 2], middle[n // 2 + 1])) / 2 if n else None
