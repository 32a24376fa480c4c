"""Forecast accuracy per series, pooled, and per component of the forecast.

A score is NULL where one of its rows lacks the actual or the prediction, so a forecast with
holes never looks better than it is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleslane.config import TargetConfig
from saleslane.functions.exprs import series_window, strict_avg, strict_sum

KEYS = ("category",)

# Fixed value: actuals up to this size do not enter percentage errors.
SMALLEST_ACTUAL = 1e-10

SCORES = {
    "mape": 2, "mae": 2, "rmse": 2, "mase": 3,
    "bias_pct": 2, "r2": 3, "mean_actual": 2, "mean_predicted": 2,
}


def eval_join(
    actuals: DataFrame, forecast: DataFrame, keys: Sequence[str] = KEYS
) -> DataFrame:
    """Actual rows with the forecast of the same series and day, NULL where there is none."""
    columns = [c for c in forecast.columns if c not in (*keys, "date", "step")]
    return actuals.join(forecast.select(*keys, "date", *columns), [*keys, "date"], "left")


def _mape(actual: Column, predicted: Column) -> Column:
    counted = F.when(actual > SMALLEST_ACTUAL, F.lit(1))
    error = F.abs(F.try_divide(actual - predicted, actual))
    return strict_avg(error, counted) * 100


def _scores(actual: Column, predicted: Column) -> dict[str, Column]:
    """Aggregates over rows that carry ``_naive`` and ``_has_naive``."""
    mae = strict_avg(F.abs(actual - predicted))
    naive = strict_avg(F.col("_naive"), F.when(F.col("_has_naive"), F.lit(1)))
    ss_res = strict_sum(F.pow(actual - predicted, F.lit(2)))
    ss_tot = F.when(F.count(actual) == F.count(F.lit(1)), F.var_pop(actual) * F.count(actual))
    bias = strict_sum(predicted) - strict_sum(actual)
    return {
        "mape": _mape(actual, predicted),
        "mae": mae,
        "rmse": F.sqrt(strict_avg(F.pow(actual - predicted, F.lit(2)))),
        "mase": F.try_divide(mae, naive),
        "bias_pct": F.try_divide(bias, strict_sum(actual)) * 100,
        "r2": F.when(ss_tot > 0, 1 - ss_res / ss_tot),
        "mean_actual": strict_avg(actual),
        "mean_predicted": strict_avg(predicted),
    }


def _with_naive_errors(
    df: DataFrame, actual: str, keys: Sequence[str], m: int
) -> DataFrame:
    """Seasonal-naive errors; they never cross from one series into the next."""
    w = series_window(keys)
    return df.withColumns(
        {
            "_naive": F.abs(F.col(actual) - F.lag(actual, m).over(w)),
            "_has_naive": F.row_number().over(w) > m,
        }
    )


def _rounded(scores: dict[str, Column], digits: dict[str, int] | None) -> list[Column]:
    if digits is None:
        return [x.alias(n) for n, x in scores.items()]
    return [F.bround(x, digits[n]).alias(n) for n, x in scores.items()]


def forecast_metrics(
    df: DataFrame,
    actual: str = "sales",
    predicted: str = "final_forecast",
    keys: Sequence[str] = KEYS,
    m: int = 7,
    rounded: bool = True,
) -> DataFrame:
    """One row of scores per series, from one window pass and one aggregation.

    MASE is scaled by the seasonal-naive error of the evaluated rows themselves.
    """
    scores = _scores(F.col(actual), F.col(predicted))
    return (
        _with_naive_errors(df, actual, keys, m)
        .groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("n_samples"), *_rounded(scores, SCORES if rounded else None)
        )
    )


def metrics_overall(
    df: DataFrame,
    actual: str = "sales",
    predicted: str = "final_forecast",
    keys: Sequence[str] = KEYS,
    m: int = 7,
) -> DataFrame:
    """The same scores over all rows pooled."""
    scores = _scores(F.col(actual), F.col(predicted))
    return _with_naive_errors(df, actual, keys, m).agg(
        F.count(F.lit(1)).alias("n_samples"), *_rounded(scores, SCORES)
    )


def metrics_with_total(
    df: DataFrame,
    actual: str = "sales",
    predicted: str = "final_forecast",
    keys: Sequence[str] = KEYS,
    m: int = 7,
) -> DataFrame:
    """Per-series rows and the pooled row (``is_total = 1``) from one scan."""
    scores = _scores(F.col(actual), F.col(predicted))
    return (
        _with_naive_errors(df, actual, keys, m)
        .groupingSets([[F.col(k) for k in keys], []], *keys)
        .agg(
            F.grouping(keys[0]).cast("int").alias("is_total"),
            F.count(F.lit(1)).alias("n_samples"),
            *_rounded(scores, SCORES),
        )
    )


def target_verdict(metrics: DataFrame, targets: TargetConfig = TargetConfig()) -> DataFrame:
    """Mean MAPE and MASE over the series against their targets."""
    return (
        metrics.agg(
            F.count(F.lit(1)).alias("n_series"),
            F.avg("mape").alias("avg_mape"),
            F.avg("mase").alias("avg_mase"),
        )
        .withColumn("mape_met", F.coalesce(F.col("avg_mape") < targets.mape, F.lit(False)))
        .withColumn("mase_met", F.coalesce(F.col("avg_mase") < targets.mase, F.lit(False)))
        .withColumn("targets_met", F.col("mape_met") & F.col("mase_met"))
    )


def component_metrics(
    df: DataFrame,
    actual: str = "sales",
    base: str = "ets_forecast",
    final: str = "final_forecast",
    keys: Sequence[str] = KEYS,
) -> DataFrame:
    """Scores of the smoothing forecast alone against the final one."""
    a, b, f = F.col(actual), F.col(base), F.col(final)

    def gain(before: str, after: str) -> Column:
        x, y = F.col(before), F.col(after)
        return F.when(x > 0, (x - y) / x * 100).otherwise(F.lit(0.0))

    raw = df.groupBy(*keys).agg(
        strict_avg(F.abs(a - b)).alias("ets_mae"),
        _mape(a, b).alias("ets_mape"),
        strict_avg(F.abs(a - f)).alias("final_mae"),
        _mape(a, f).alias("final_mape"),
    )
    return raw.withColumns(
        {
            "mae_improvement_pct": gain("ets_mae", "final_mae"),
            "mape_improvement_pct": gain("ets_mape", "final_mape"),
        }
    ).select(
        *keys,
        *(
            F.bround(c, 2).alias(c)
            for c in (
                "ets_mae", "ets_mape", "final_mae", "final_mape",
                "mae_improvement_pct", "mape_improvement_pct",
            )
        ),
    )


def component_improvement(components: DataFrame) -> DataFrame:
    return components.agg(
        F.avg("mae_improvement_pct").alias("avg_mae_improvement_pct"),
        F.avg("mape_improvement_pct").alias("avg_mape_improvement_pct"),
    )
