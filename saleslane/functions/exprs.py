"""Column expressions with the panel's NULL rules.

A missing measure is NULL, never NaN.  Statistics propagate NULL where one missing value
makes the statistic unknown (``strict_*``), flags are 0 for a missing operand, and divisions
are guarded because ANSI mode raises on a zero divisor.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

def flag(cond: Column) -> Column:
    """1 where ``cond`` holds, 0 where it is false or unknown."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def ratio_or_zero(num: Column, den: Column) -> Column:
    return F.when(den > 0, num / den).otherwise(F.lit(0.0))


def total(x: Column) -> Column:
    """Sum that is 0 for a group without values."""
    return F.coalesce(F.sum(x), F.lit(0.0))


def strict_avg(x: Column, rows: Column | None = None) -> Column:
    """Mean over the rows where ``rows`` is non-null; NULL if any of them lacks ``x``."""
    rows = F.lit(1) if rows is None else rows
    in_scope = F.when(rows.isNotNull(), x)
    return F.when(F.count(in_scope) == F.count(rows), F.avg(in_scope))


def strict_sum(x: Column) -> Column:
    return F.when(F.count(x) == F.count(F.lit(1)), F.sum(x))


def weighted_avg(x: Column, w: Column) -> Column:
    """Mean of ``x`` weighted by ``w``; the plain mean where the weights sum to 0 or less.

    One pair with a missing part makes the weighted mean NULL.  Both branches are partial
    aggregates, so a hot group is combined map-side.
    """
    both = F.count(F.when(x.isNotNull(), w))
    weighted = F.when(
        both == F.count(F.lit(1)), F.try_divide(F.sum(x * w), F.sum(w))
    )
    return F.when(F.sum(w) > 0, weighted).otherwise(F.avg(x))


def full_window_avg(x: Column, window: WindowSpec, size: int) -> Column:
    """Mean over a row frame, NULL until the frame holds ``size`` values."""
    return F.when(F.count(x).over(window) >= size, F.avg(x).over(window))


def series_window(keys, order: str = "date", descending: bool = False) -> WindowSpec:
    """Rows of one series in date order; a panel's date uniqueness bounds its length."""
    by = F.col(order).desc() if descending else F.col(order).asc()
    return Window.partitionBy(*keys).orderBy(by)


def up_to_now(window: WindowSpec) -> WindowSpec:
    return window.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def whole(window: WindowSpec) -> WindowSpec:
    return window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def nan_to_null(df: DataFrame) -> DataFrame:
    """Replace NaN by NULL in every floating column, once, where data enters."""
    floats = [
        f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    ]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats})
