"""Smoothing forecast plus residual forecast, never below zero."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleslane.config import EtsConfig
from saleslane.operators.ets import ets_forecast
from saleslane.operators.residual import ResidualModel, model_matrix

KEYS = ("category",)


def combine(
    smoothed: DataFrame, residuals: DataFrame, keys: Sequence[str] = KEYS
) -> DataFrame:
    """Add both forecasts step by step; a missing one leaves the sum NULL.

    A series that was never fitted is an error, not a missing forecast.
    """
    fitted = smoothed.select(*keys, "step", "ets_forecast", F.lit(True).alias("_fitted"))
    total = F.col("ets_forecast") + F.col("residual_forecast")
    unknown = F.raise_error(
        F.concat(F.lit("no fitted state for series "), F.concat_ws(" / ", *keys))
    )
    return (
        residuals.select(*keys, "step", "date", "residual_forecast")
        .join(fitted, [*keys, "step"], "left")
        .select(
            *keys,
            "step",
            "date",
            "ets_forecast",
            "residual_forecast",
            F.when(F.col("_fitted").isNull(), unknown.cast("double"))
            .when(total < 0, 0.0)
            .otherwise(total)
            .alias("final_forecast"),
        )
    )


def hybrid_forecast(
    state: DataFrame,
    model: ResidualModel,
    future: DataFrame,
    horizon: int = 30,
    keys: Sequence[str] = KEYS,
    spec: EtsConfig = EtsConfig(),
) -> DataFrame:
    if model is None:
        raise ValueError("no fitted residual model")
    residuals = model.predict(model_matrix(future, keys))
    return combine(ets_forecast(state, horizon, keys, spec), residuals, keys)
