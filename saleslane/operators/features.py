"""Calendar, lag, rolling, promotion, holiday and weather features of a panel.

All frames are row-positional within a series, so a missing day shifts a lag; densify the
panel first (:func:`saleslane.operators.spine.densify`) where calendar lags are wanted.  Every
window has the same partitioning and ordering, so a feature frame costs one shuffle and one
sort per series.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleslane.config import FeatureConfig
from saleslane.functions.dates import temporal_columns
from saleslane.functions.exprs import flag, full_window_avg, series_window, whole
from saleslane.operators.holidays import add_holiday_phases

KEYS = ("category",)


def add_temporal(df: DataFrame) -> DataFrame:
    return df.withColumns(temporal_columns(F.col("date")))


def add_lags(
    df: DataFrame,
    lags: Sequence[int] = (7, 14, 28),
    promo_lag: int | None = 7,
    keys: Sequence[str] = KEYS,
) -> DataFrame:
    w = series_window(keys)
    columns = {f"lag_{k}": F.lag("sales", k).over(w) for k in lags}
    if promo_lag and "promo_intensity" in df.columns:
        columns[f"promo_lag_{promo_lag}"] = F.lag("promo_intensity", promo_lag).over(w)
    return df.withColumns(columns)


def rolling_mean(
    col: str,
    size: int,
    keys: Sequence[str] = KEYS,
    min_periods: int | None = None,
    exclude_current: bool = False,
) -> Column:
    """Mean of the last ``size`` rows, NULL until ``min_periods`` of them hold a value."""
    last = -1 if exclude_current else 0
    frame = series_window(keys).rowsBetween(last - size + 1, last)
    return full_window_avg(F.col(col), frame, min_periods or size)


def add_rolling(
    df: DataFrame,
    windows: Sequence[int] = (7, 28),
    col: str = "sales",
    keys: Sequence[str] = KEYS,
    min_periods: int | None = None,
    exclude_current: bool = False,
) -> DataFrame:
    return df.withColumns(
        {
            f"rolling_mean_{n}": rolling_mean(col, n, keys, min_periods, exclude_current)
            for n in windows
        }
    )


def add_days_since(
    df: DataFrame,
    event: str = "promo_flag",
    out: str = "days_since_promo",
    keys: Sequence[str] = KEYS,
    default: int = 999,
) -> DataFrame:
    """Days since the last earlier date with the event, ``default`` where there is none.

    The latest event strictly before a day is a running maximum over a day-valued range frame
    that ends one day back, so it takes one pass per series.
    """
    series = ", ".join(f"`{k}`" for k in keys)
    last_event = F.expr(
        f"max(CASE WHEN `{event}` = 1 THEN date END) OVER (PARTITION BY {series} ORDER BY date"
        " RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL '1' DAY PRECEDING)"
    )
    return df.withColumn(out, F.coalesce(F.datediff("date", last_event), F.lit(default)))


def weather_quantiles(
    df: DataFrame,
    keys: Sequence[str] = KEYS,
    cold: float = 0.1,
    hot: float = 0.9,
    wet: float = 0.9,
) -> DataFrame:
    """Exact interpolated quantiles of temperature and precipitation per series."""
    wanted = quantile_columns(cold, hot, wet)
    return df.groupBy(*keys).agg(*(x.alias(n) for n, x in wanted.items()))


def quantile_columns(cold: float, hot: float, wet: float) -> dict[str, Column]:
    rain = F.col("avg_rainfall") + F.col("avg_snowfall")
    return {
        "temp_cold": F.percentile("avg_temperature", cold),
        "temp_hot": F.percentile("avg_temperature", hot),
        "precip_heavy": F.percentile(rain, wet),
    }


def extreme_flags(temperature: Column, precipitation: Column) -> dict[str, Column]:
    """Flags against the columns of :func:`weather_quantiles`."""
    return {
        "is_extreme_cold": flag(temperature < F.col("temp_cold")),
        "is_extreme_hot": flag(temperature > F.col("temp_hot")),
        "heavy_precip_flag": flag(precipitation > F.col("precip_heavy")),
    }


def add_weather(
    df: DataFrame,
    keys: Sequence[str] = KEYS,
    cold: float = 0.1,
    hot: float = 0.9,
    wet: float = 0.9,
    norm_window: int = 14,
    reference: DataFrame | None = None,
) -> DataFrame:
    """Temperature norm and deviation, precipitation and extreme-weather flags.

    Quantiles come from the frame itself, inside the window pass that the norm needs anyway,
    or from the rows of ``reference`` joined on the series.
    """
    temp = F.col("avg_temperature")
    rain = F.col("avg_rainfall") + F.col("avg_snowfall")
    norm = f"temp_rolling_avg_{norm_window}"
    windowed = {norm: rolling_mean("avg_temperature", norm_window, keys)}
    if reference is None:
        everything = whole(series_window(keys))
        wanted = quantile_columns(cold, hot, wet)
        windowed |= {name: x.over(everything) for name, x in wanted.items()}
        out = df.withColumns(windowed)
    else:
        out = df.withColumns(windowed).join(
            weather_quantiles(reference, keys, cold, hot, wet), list(keys), "left"
        )
    return out.withColumns(
        {
            "temp_deviation": temp - F.col(norm),
            "total_precipitation": rain,
            **extreme_flags(temp, rain),
        }
    ).drop("temp_cold", "temp_hot", "precip_heavy")


def engineer_features(
    panel: DataFrame, config: FeatureConfig = FeatureConfig(), keys: Sequence[str] = KEYS
) -> DataFrame:
    """All feature groups; those whose columns the panel lacks are left out."""
    out = add_temporal(panel)
    out = add_lags(out, config.lags, config.promo_lag, keys)
    out = add_rolling(
        out, config.rolling_windows, keys=keys, exclude_current=config.exclude_current
    )
    if "promo_flag" in panel.columns:
        out = add_days_since(out, keys=keys, default=config.no_promo_days)
    if "holiday_flag" in panel.columns:
        out = add_holiday_phases(out, config.holiday_pre, config.holiday_post)
    if {"avg_temperature", "avg_rainfall", "avg_snowfall"} <= set(panel.columns):
        out = add_weather(
            out,
            keys,
            config.cold_quantile,
            config.hot_quantile,
            config.wet_quantile,
            config.temp_norm_window,
        )
    return out
