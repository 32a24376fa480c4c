"""The data behind each report chart, and the summary of a run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleslane.config import TargetConfig
from saleslane.operators.metrics import target_verdict
from saleslane.operators.splits import tail_per_series

KEYS = ("category",)


def plot_forecast_actual(
    train: DataFrame,
    evaluated: DataFrame,
    keys: Sequence[str] = KEYS,
    context: int = 90,
    predicted: str = "final_forecast",
) -> DataFrame:
    """The last ``context`` training rows of a series, then its test actuals and forecasts."""
    before = tail_per_series(train.select(*keys, "date", "sales"), context, keys).select(
        *keys, "date", F.lit("train").alias("part"), "sales",
        F.lit(None).cast("double").alias("forecast"),
    )
    after = evaluated.select(
        *keys, "date", F.lit("test").alias("part"), "sales", F.col(predicted).alias("forecast")
    )
    starts = evaluated.groupBy(*keys).agg(F.min("date").alias("forecast_start"))
    return before.unionByName(after).join(starts, list(keys), "left")


def component_frame(evaluated: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Actual, smoothing forecast, residual forecast and final forecast by day."""
    return evaluated.select(
        *keys, "date", "sales", "ets_forecast", "residual_forecast", "final_forecast"
    )


def residual_frame(
    df: DataFrame,
    actual: str = "sales",
    predicted: str = "final_forecast",
    keys: Sequence[str] = KEYS,
) -> DataFrame:
    """Residual and absolute percentage error per row; the error is NULL unless finite."""
    a, p = F.col(actual), F.col(predicted)
    return df.select(
        *keys, "date", a.alias("actual"), p.alias("predicted"), (a - p).alias("residual"),
        (F.abs(F.try_divide(a - p, a)) * 100).alias("ape"),
    )


def residual_summary(residuals: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    return residuals.groupBy(*keys).agg(
        F.avg("residual").alias("mean_residual"),
        F.stddev_pop("residual").alias("std_residual"),
        F.avg("ape").alias("mean_ape"),
        F.least(F.min("actual"), F.min("predicted")).alias("scatter_min"),
        F.greatest(F.max("actual"), F.max("predicted")).alias("scatter_max"),
    )


def residual_histogram(
    residuals: DataFrame, bins: int = 30, keys: Sequence[str] = KEYS
) -> DataFrame:
    """Counts in ``bins`` equal steps from the least to the greatest residual of a series.

    The last bin is closed; a constant series is binned over a range widened by a half on
    either side.  The ranges are one row per series and the counts ``bins`` rows per series,
    so both shuffles carry partial aggregates only.
    """
    known = residuals.where(F.col("residual").isNotNull())
    ranges = known.groupBy(*keys).agg(
        F.min("residual").alias("_min"), F.max("residual").alias("_max")
    )
    flat = F.col("_min") == F.col("_max")
    ranges = ranges.select(
        *keys,
        F.when(flat, F.col("_min") - 0.5).otherwise(F.col("_min")).alias("lo"),
        F.when(flat, F.col("_max") + 0.5).otherwise(F.col("_max")).alias("hi"),
    )
    place = F.floor(F.try_divide((F.col("residual") - F.col("lo")) * bins, F.col("hi") - F.col("lo")))
    width = (F.col("hi") - F.col("lo")) / bins
    return (
        known.join(ranges, list(keys))
        .groupBy(*keys, "lo", "hi", F.least(place, F.lit(bins - 1)).cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .select(*keys, "bin", (F.col("lo") + F.col("bin") * width).alias("bin_start"), "n_rows")
    )


def metrics_long(
    metrics: DataFrame, targets: TargetConfig = TargetConfig(), keys: Sequence[str] = KEYS
) -> DataFrame:
    """Scores in long form with the target line of those that have one."""
    target = (
        F.when(F.col("metric") == "mape", F.lit(targets.mape))
        .when(F.col("metric") == "mase", F.lit(targets.mase))
        .when(F.col("metric") == "bias_pct", F.lit(0.0))
    )
    return metrics.unpivot(
        list(keys), ["mape", "mae", "mase", "bias_pct"], "metric", "value"
    ).withColumn("target", target)


def run_summary(
    sku_day: DataFrame,
    panel: DataFrame,
    metrics: DataFrame,
    targets: TargetConfig = TargetConfig(),
    keys: Sequence[str] = KEYS,
) -> DataFrame:
    """Report lines ``(section, item, value)``: sizes, date range, scores and verdict.

    Series get a line each instead of being collected into one list, so the report stays
    distributed with any number of them.
    """
    series = F.array_join(F.array(*(F.col(k).cast("string") for k in keys)), " / ")

    def lines(section: str, df: DataFrame, values: dict[str, Column]) -> DataFrame:
        named = df.select(*(v.cast("string").alias(n) for n, v in values.items()))
        return named.unpivot([], list(values), "item", "value").select(
            F.lit(section).alias("section"), "item", "value"
        )

    data = lines(
        "data",
        panel.agg(
            F.count(F.lit(1)).alias("n"), F.min("date").alias("lo"), F.max("date").alias("hi")
        ),
        {"panel_rows": F.col("n"), "first_date": F.col("lo"), "last_date": F.col("hi")},
    )
    size = lines(
        "data", sku_day.agg(F.count(F.lit(1)).alias("n")), {"sku_day_rows": F.col("n")}
    )
    scores = metrics.select(
        series.alias("series"), *(F.col(c).cast("string") for c in ("mape", "mae", "mase", "bias_pct", "r2"))
    ).unpivot(["series"], ["mape", "mae", "mase", "bias_pct", "r2"], "metric", "value")
    scores = scores.select(
        F.lit("metrics").alias("section"), F.concat_ws(" ", "series", "metric").alias("item"), "value"
    )
    verdict = lines(
        "targets",
        target_verdict(metrics, targets),
        {
            "avg_mape": F.bround("avg_mape", 2),
            "avg_mase": F.bround("avg_mase", 3),
            "status": F.when(F.col("targets_met"), "met").otherwise("not met"),
        },
    )
    return size.unionByName(data).unionByName(scores).unionByName(verdict)
