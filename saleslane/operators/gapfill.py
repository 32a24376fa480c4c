"""Filling of low-stock days by bounded linear interpolation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleslane.functions.exprs import series_window, up_to_now, whole

MEASURES = ("sales", "instock_rate", "final_sku_price")


def is_low(threshold: float) -> Column:
    """Strictly below the threshold; an unknown rate is not low."""
    return F.coalesce(F.col("instock_rate") < threshold, F.lit(False))


def low_stock_stats(sku_day: DataFrame, threshold: float = 60.0) -> DataFrame:
    return sku_day.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(is_low(threshold)).alias("n_low"),
        F.try_divide(100.0 * F.count_if(is_low(threshold)), F.count(F.lit(1))).alias("pct_low"),
    )


def fill_low_stock(
    sku_day: DataFrame,
    threshold: float = 60.0,
    limit: int | None = 7,
    keys: Sequence[str] = ("sku_id",),
    cols: Sequence[str] = MEASURES,
) -> DataFrame:
    """Replace the measures of low-stock rows and add ``fill_kind``.

    Positions are row numbers within the series, not days.  Inside a gap a value is
    interpolated linearly if it lies within ``limit`` rows of either edge; the middle of a
    longer gap repeats the last value reached from the left.  A leading gap takes the first
    value for its last ``limit`` rows and stays NULL before; a trailing gap repeats the last
    value.  Series without a low row are left alone.  Rates still under the threshold after
    filling are lifted to it.  ``fill_kind`` describes the first of ``cols``.  Two rows of a series on
    one date are an error: their order, and so what fills the gaps, would be arbitrary.

    The plan is one shuffle and two sorts per series: the value to the left comes from the
    ascending window, the one to the right from the descending window.  An ascending frame
    that reaches forward to the end would rescan the rest of the series for every row.
    """
    cols = [c for c in cols if c in sku_day.columns]
    ahead, back = series_window(keys), series_window(keys, descending=True)

    place = F.row_number().over(ahead)
    repeated = (place > 1) & F.lag("date").over(ahead).eqNullSafe(F.col("date"))
    message = F.concat(F.lit("two rows of series "), F.concat_ws(" / ", *keys), F.lit(" on "), F.coalesce(F.col("date").cast("string"), F.lit("no date")))
    marked = sku_day.withColumns(
        {
            "_low": is_low(threshold),
            "_pos": F.when(repeated, F.raise_error(message).cast("int")).otherwise(place),
            "_has_low": F.max(is_low(threshold)).over(whole(ahead)),
        }
    )

    def seen(c: str) -> Column:
        value = F.when(~F.col("_low"), F.col(c))
        return F.when(value.isNotNull(), F.struct(F.col("_pos").alias("p"), value.alias("v")))

    edges = marked.withColumns(
        {f"_prev_{c}": F.last(seen(c), ignorenulls=True).over(up_to_now(ahead)) for c in cols}
    ).withColumns(
        {f"_next_{c}": F.last(seen(c), ignorenulls=True).over(up_to_now(back)) for c in cols}
    )

    filled = {c: F.when(F.col("_has_low"), _between(c, limit)).otherwise(F.col(c)) for c in cols}
    if "instock_rate" in filled:
        rate = filled["instock_rate"]
        filled["instock_rate"] = F.when(rate < threshold, F.lit(threshold)).otherwise(rate)
    kept = [filled[c].alias(c) if c in filled else F.col(c) for c in sku_day.columns]
    return edges.select(*kept, _fill_kind(cols[0], limit).alias("fill_kind"))


def _between(c: str, limit: int | None) -> Column:
    prev, nxt, pos = F.col(f"_prev_{c}"), F.col(f"_next_{c}"), F.col("_pos")
    left, right = pos - prev["p"], nxt["p"] - pos
    if limit is None:
        step, leading = left, nxt["v"]
    else:
        step = F.when((left <= limit) | (right <= limit), left).otherwise(F.lit(limit))
        leading = F.when(right <= limit, nxt["v"])
    inside = prev["v"] + F.try_divide((nxt["v"] - prev["v"]) * step, nxt["p"] - prev["p"])
    return (
        F.when(left == 0, prev["v"])
        .when(prev.isNull(), leading)
        .when(nxt.isNull(), prev["v"])
        .otherwise(inside)
    )


def _fill_kind(c: str, limit: int | None) -> Column:
    prev, nxt, pos = F.col(f"_prev_{c}"), F.col(f"_next_{c}"), F.col("_pos")
    left, right = pos - prev["p"], nxt["p"] - pos
    near = F.lit(True) if limit is None else (left <= limit) | (right <= limit)
    return (
        F.when(~F.col("_has_low") & F.col(c).isNull(), "unfilled")
        .when(~F.col("_has_low") | (left == 0), "observed")
        .when(prev.isNull() & nxt.isNull(), "unfilled")
        .when(F.coalesce(near, F.lit(False)), "interpolated")
        .when(prev.isNull(), "unfilled")
        .otherwise("forward_filled")
    )


def fill_report(filled: DataFrame) -> DataFrame:
    return filled.groupBy("fill_kind").agg(F.count(F.lit(1)).alias("n_rows"))
