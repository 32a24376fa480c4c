"""Calendar spines: every day of a series, and the days after its end."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def date_spine(
    df: DataFrame,
    keys: Sequence[str] = ("category",),
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """Every day of every series from ``start`` to ``end``, by default its own first to last."""
    bounds = df.groupBy(*keys).agg(F.min("date").alias("_lo"), F.max("date").alias("_hi"))
    lo = F.lit(start).cast("date") if start else F.col("_lo")
    hi = F.lit(end).cast("date") if end else F.col("_hi")
    return bounds.select(*keys, F.explode(F.sequence(lo, hi)).alias("date"))


def densify(df: DataFrame, keys: Sequence[str] = ("category",), **range_) -> DataFrame:
    """The panel with a row of NULL measures for every missing day."""
    return date_spine(df, keys, **range_).join(df, [*keys, "date"], "left")


def future_spine(history: DataFrame, horizon: int, keys: Sequence[str] = ("category",)) -> DataFrame:
    """Rows ``(keys, step, date)`` for the ``horizon`` days after each series' last day."""
    ends = history.groupBy(*keys).agg(F.max("date").alias("_last"))
    return ends.select(
        *keys, "_last", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step")
    ).select(*keys, "step", F.date_add("_last", F.col("step")).alias("date"))
