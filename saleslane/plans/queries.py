"""Every operator as a query over the given tables.

Each query reads whole tables.  Doubles are rounded to six places at the end, because sums of
the same numbers in another order differ in the last bits.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saleslane.config import (
    BoostConfig,
    EtsConfig,
    PipelineConfig,
    SplitConfig,
    TuningConfig,
)
from saleslane.functions.dates import sku_key
from saleslane.functions.exprs import nan_to_null
from saleslane.operators import (
    ets,
    features,
    future,
    gapfill,
    holidays,
    hybrid,
    metrics,
    quality,
    reports,
    residual,
    rollup,
    spine,
    splits,
    tuning,
)
from saleslane.plans.durable import checkpoint_dir, durable
from saleslane.plans.pipeline import Run, prepare_panel, run_pipeline
from saleslane.sources import bridge, panels, published

FIXED = EtsConfig(alpha=0.2, beta=0.05, gamma=0.1)
SMALL_GRID = EtsConfig(
    grid_alpha=(0.05, 0.2, 0.5),
    grid_beta=(0.0, 0.05, 0.2),
    grid_gamma=(0.05, 0.1, 0.3),
    grid_phi=(0.9, 0.98),
    refine=False,
)
LAST = SplitConfig(train=None, val=30, test=30, anchor="end")
BOOST = BoostConfig()
TUNING = TuningConfig()
HORIZON = 30

Query = Callable[[SparkSession, str], DataFrame]


def tidy(df: DataFrame, places: int = 6) -> DataFrame:
    """Doubles, and arrays of doubles, rounded; adding 0 turns a negative zero into zero."""

    def rounded(field: T.StructField):
        c = F.col(field.name)
        if isinstance(field.dataType, T.DoubleType):
            return (F.round(c, places) + 0.0).alias(field.name)
        if field.dataType == T.ArrayType(T.DoubleType()):
            return F.transform(c, lambda x: F.round(x, places) + 0.0).alias(field.name)
        return c

    return df.select(*(rounded(f) for f in df.schema))


def sku_day(spark: SparkSession, sf: str) -> DataFrame:
    return bridge.sku_day_panel(bridge.lineitem(spark, sf))


def exog(spark: SparkSession, sf: str) -> DataFrame:
    return bridge.exog_panel(bridge.lineitem(spark, sf))


def filled(spark: SparkSession, sf: str) -> DataFrame:
    return gapfill.fill_low_stock(sku_day(spark, sf))


def panel(spark: SparkSession, sf: str) -> DataFrame:
    """Category-day rows without weather."""
    return rollup.rollup(filled(spark, sf))


def full_panel(spark: SparkSession, sf: str) -> DataFrame:
    return prepare_panel(sku_day(spark, sf), exog(spark, sf))


def feature_frame(spark: SparkSession, sf: str) -> DataFrame:
    return features.engineer_features(full_panel(spark, sf))


def ship_dates(spark: SparkSession, sf: str) -> DataFrame:
    return bridge.lineitem(spark, sf).select(F.to_date("l_shipdate").alias("date"))


def split_last(spark: SparkSession, sf: str, rows: DataFrame) -> DataFrame:
    return splits.date_split(
        rows, LAST.train, LAST.val, LAST.test, LAST.anchor, ship_dates(spark, sf)
    )


def labelled(spark: SparkSession, sf: str) -> DataFrame:
    return split_last(spark, sf, panel(spark, sf))


def backtest(spark: SparkSession, sf: str) -> DataFrame:
    return seasonal_naive(panel(spark, sf))


def seasonal_naive(rows: DataFrame) -> DataFrame:
    """Sales with the values of one and two weeks before as final and base forecasts."""
    lagged = features.add_lags(rows, (7, 14), promo_lag=None)
    return lagged.where("lag_14 is not null").select(
        "category", "date", "sales",
        F.col("lag_14").alias("ets_forecast"),
        (F.col("lag_7") - F.col("lag_14")).alias("residual_forecast"),
        F.col("lag_7").alias("final_forecast"),
    )


def fitted_history(spark: SparkSession, sf: str) -> DataFrame:
    """Features with the components of a fixed-parameter smoothing."""
    frame = durable(feature_frame(spark, sf))
    state = ets.ets_fit(frame, spec=FIXED)
    return ets.with_ets_components(frame, state, spec=FIXED)


def training_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return durable(residual.model_matrix(split_last(spark, sf, fitted_history(spark, sf))))


def fixed_forecast(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """The labelled panel and a smoothing forecast of its test days."""
    rows = durable(labelled(spark, sf).select("category", "date", "sales", "split"))
    history = splits.union_splits(rows, ("train", "val"))
    return rows, ets.ets_forecast(ets.ets_fit(history, spec=FIXED), HORIZON, spec=FIXED)


def promo_plan(spark: SparkSession, sf: str) -> DataFrame:
    """Promotion days of the last four weeks, planned again four weeks later."""
    return (
        splits.tail_per_series(panel(spark, sf), 28)
        .where("promo_flag = 1")
        .select("category", F.date_add("date", 28).alias("date"), "promo_intensity", "promo_flag")
    )


def weather_plan(spark: SparkSession, sf: str) -> DataFrame:
    """The weather of 52 weeks before as a forecast."""
    return exog(spark, sf).select(
        "category", F.date_add("date", 364).alias("date"), *future.WEATHER
    )


def run(spark: SparkSession, sf: str) -> Run:
    config = PipelineConfig(split=LAST, boost=BOOST, tuning=TUNING)
    return run_pipeline(sku_day(spark, sf), exog(spark, sf), config)


# ---------------------------------------------------------------------------------------
# Sources, filling and roll-up


def load_sku_day(spark, sf):
    return nan_to_null(sku_day(spark, sf))


def csv_round_trip(spark, sf):
    path = f"{checkpoint_dir(spark)}/sku-day-{uuid.uuid4().hex}"
    panels.write_panel(sku_day(spark, sf), path, "csv")
    return panels.read_sku_day(spark, path, "csv")


def panel_sink(spark, sf):
    path = f"{checkpoint_dir(spark)}/sku-day-{uuid.uuid4().hex}"
    panels.write_panel(sku_day(spark, sf), path, partition_by=["category"])
    return panels.read_sku_day(spark, path)


def panel_republish(spark, sf):
    """All months published, those from 1997 on again at doubled sales, then a write that fails."""
    path = f"{checkpoint_dir(spark)}/published-{uuid.uuid4().hex}"
    target = published.PublishedPanel(spark, path, ("category", "month"))
    rows = sku_day(spark, sf).withColumn("month", F.date_format("date", "yyyy-MM"))
    target.publish(rows)
    target.publish(rows.filter("date >= '1997-01-01'").withColumn("sales", F.col("sales") * 2))
    try:
        target.publish(rows.withColumn("sales", F.when(F.col("category").isNotNull(), F.raise_error(F.lit("damaged")).cast("double"))))
    except PySparkException as error:
        if "damaged" not in str(error):
            raise
    return target.read().drop("month")


def params_round_trip(spark, sf):
    path = f"{checkpoint_dir(spark)}/params-{uuid.uuid4().hex}"
    absent = panels.load_params(spark, path) is None
    row = sku_day(spark, sf).agg(F.countDistinct("sku_id").alias("series"), F.max("sales").alias("most")).first()
    panels.save_params(spark, {**row.asDict(), "absent_before": float(absent)}, path)
    saved = panels.load_params(spark, path)
    return spark.createDataFrame(sorted(saved.items()), "name string, value double")


def series_encoding(spark, sf):
    rows = residual.series_encoding(sku_day(spark, sf), ("sku_id",), "sales")
    return rows.select("sku_id", F.col("_fold").alias("fold"), F.col("_series_code").alias("code"))


def load_exog(spark, sf):
    return nan_to_null(exog(spark, sf))


def exog_round_trip(spark, sf):
    path = f"{checkpoint_dir(spark)}/exog-{uuid.uuid4().hex}"
    panels.write_panel(exog(spark, sf), path, "csv")
    return nan_to_null(panels.read_exog(spark, path, "csv"))


def duplicate_keys(spark, sf):
    lines = bridge.lineitem(spark, sf)
    rows = lines.select(F.col("l_returnflag").alias("category"), F.to_date("l_shipdate").alias("date"))
    return quality.duplicate_keys(rows)


def sku_keys(spark, sf):
    number = F.col("l_linenumber")
    lines = bridge.lineitem(spark, sf)
    return lines.groupBy(sku_key(F.col("l_returnflag"), number).alias("sku_key")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )


def interpolate_low_instock(spark, sf):
    return filled(spark, sf)


def interpolate_limit1(spark, sf):
    return gapfill.fill_low_stock(sku_day(spark, sf), limit=1)


def interpolate_long_gaps(spark, sf):
    return gapfill.fill_low_stock(sku_day(spark, sf), threshold=80.0, limit=2)


def interpolate_no_limit(spark, sf):
    return gapfill.fill_low_stock(sku_day(spark, sf), threshold=80.0, limit=None)


def fill_report(spark, sf):
    return gapfill.fill_report(interpolate_long_gaps(spark, sf))


def weighted_avg(spark, sf):
    return rollup.rollup(sku_day(spark, sf)).select(
        "category", "date", "instock_rate", "final_sku_price"
    )


def promo_intensity(spark, sf):
    return rollup.rollup(sku_day(spark, sf)).select(
        "category", "date", "promo_intensity", "promo_flag", "pct_skus_on_high_impact_promo"
    )


def null_profile(spark, sf):
    return quality.null_profile(feature_frame(spark, sf))


def valid_panel(spark, sf):
    return quality.is_valid(quality.validate_panel(panel(spark, sf)))


# ---------------------------------------------------------------------------------------
# Calendar and features


def holiday_calendar(spark, sf):
    years = bridge.lineitem(spark, sf).select(F.year("l_shipdate").alias("year")).distinct()
    return holidays.holiday_calendar(years).select("holiday_date", "name")


def holiday_flag(spark, sf):
    return holidays.with_holiday_flag(ship_dates(spark, sf).distinct())


def date_spine(spark, sf):
    return spine.densify(panel(spark, sf).select("category", "date", "sales"))


def temporal_features(spark, sf):
    dates = panel(spark, sf).select("category", "date")
    return features.add_temporal(dates)


def lag_features(spark, sf):
    rows = panel(spark, sf).select("category", "date", "sales", "promo_intensity")
    return features.add_lags(rows)


def rolling_features(spark, sf):
    return features.add_rolling(panel(spark, sf).select("category", "date", "sales"))


def days_since_promo(spark, sf):
    return features.add_days_since(panel(spark, sf).select("category", "date", "promo_flag"))


def holiday_features(spark, sf):
    return holidays.add_holiday_phases(exog(spark, sf).select("category", "date", "holiday_flag"))


def weather_quantiles(spark, sf):
    return features.weather_quantiles(exog(spark, sf))


def weather_features(spark, sf):
    return features.add_weather(exog(spark, sf).drop("holiday_flag"))


# ---------------------------------------------------------------------------------------
# Splits and matrices


def date_split(spark, sf):
    rows = splits.date_split(panel(spark, sf), dates=ship_dates(spark, sf))
    return rows.select("category", "date", "sales", "split")


def semi_join_dates(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    busy = orders.where("dayofmonth(o_orderdate) = 13").select(F.to_date("o_orderdate").alias("date"))
    return splits.semi_join_dates(panel(spark, sf).select("category", "date", "sales"), busy)


def union_splits(spark, sf):
    return splits.union_splits(labelled(spark, sf), ("train", "val")).select(
        "category", "date", "sales", "split"
    )


def expanding_folds(spark, sf):
    rows = panel(spark, sf).select("category", "date", "sales")
    return splits.expanding_folds(rows, anchor="end", dates=ship_dates(spark, sf))


def expanding_folds_start(spark, sf):
    rows = panel(spark, sf).select("category", "date", "sales")
    return splits.expanding_folds(rows, dates=ship_dates(spark, sf))


def fill_missing(spark, sf):
    rows = features.add_rolling(features.add_lags(panel(spark, sf)))
    cols = ["lag_7", "lag_28", "rolling_mean_28", "promo_lag_7"]
    return splits.fill_missing(rows, cols).select("category", "date", *cols)


def model_matrix(spark, sf):
    return residual.model_matrix(fitted_history(spark, sf))


def tail_per_series(spark, sf):
    return splits.tail_per_series(panel(spark, sf).select("category", "date", "sales"), 90)


def last_state(spark, sf):
    cols = ["sales", "promo_flag", "num_skus", "final_sku_price", "days_since_promo"]
    return splits.last_state(features.add_days_since(panel(spark, sf)), cols)


# ---------------------------------------------------------------------------------------
# Smoothing


def series_describe(spark, sf):
    return ets.series_describe(panel(spark, sf))


def moving_average_fit(spark, sf):
    return ets.moving_average_fit(panel(spark, sf))


def ets_fallback(spark, sf):
    """Weekly changes are partly negative or missing, which multiplicative seasons refuse."""
    rows = features.add_lags(panel(spark, sf), (7,), promo_lag=None)
    change = (F.col("sales") - F.col("lag_7")).alias("change")
    rows = durable(rows.select("category", "date", change))
    state = ets.ets_fit(rows, y="change", spec=FIXED)
    return ets.ets_components(rows, state, y="change", spec=FIXED)


def ets_fixed(spark, sf):
    return ets.ets_fit(panel(spark, sf), spec=FIXED)


def ets_fit(spark, sf):
    return ets.ets_fit(panel(spark, sf), spec=SMALL_GRID)


def ets_search(spark, sf):
    return ets.ets_fit(durable(panel(spark, sf).select("category", "date", "sales")))


def ets_components(spark, sf):
    rows = durable(panel(spark, sf).select("category", "date", "sales"))
    return ets.ets_components(rows, ets.ets_fit(rows, spec=FIXED), spec=FIXED)


def ets_forecast(spark, sf):
    return ets.ets_forecast(ets_fixed(spark, sf), HORIZON, spec=FIXED)


def ets_state_reload(spark, sf):
    path = f"{checkpoint_dir(spark)}/run-{uuid.uuid4().hex}"
    panels.write_panel(ets_fixed(spark, sf), f"{path}/ets_state")
    return ets.ets_forecast(panels.load_ets_state(spark, path), HORIZON, spec=FIXED)


def ets_fit_stats(spark, sf):
    return ets.ets_fit_stats(ets_components(spark, sf))


# ---------------------------------------------------------------------------------------
# Future rows and forecasts


def future_spine(spark, sf):
    return spine.future_spine(panel(spark, sf), HORIZON)


def future_lags(spark, sf):
    return future.future_lags(panel(spark, sf), HORIZON)


def future_promo_plan(spark, sf):
    return future.future_promo_plan(future_spine(spark, sf), durable(promo_plan(spark, sf)))


def climatology(spark, sf):
    history = exog(spark, sf)
    return future.climatology(history, spine.future_spine(history, HORIZON))


def future_weather(spark, sf):
    history = exog(spark, sf)
    return future.future_weather(history, spine.future_spine(history, HORIZON))


def future_weather_plan(spark, sf):
    history = exog(spark, sf)
    rows = spine.future_spine(history, HORIZON)
    return future.future_weather(history, rows, weather_plan(spark, sf))


def future_frame(spark, sf):
    return future.future_frame(durable(fitted_history(spark, sf)), HORIZON)


def residual_model(spark, sf):
    matrix = training_matrix(spark, sf)
    model = residual.fit_residual_model(matrix, BOOST, validation=F.col("split") == "val")
    return model.predict(matrix).select("category", "date", "ets_residual", "residual_forecast")


def residual_model_mae(spark, sf):
    matrix = training_matrix(spark, sf)
    model = residual.fit_residual_model(matrix, BOOST, validation=F.col("split") == "val")
    return residual.residual_mae(model, matrix)


def model_reload(spark, sf):
    """Whether a stored and reloaded model forecasts every row the same."""
    matrix = training_matrix(spark, sf)
    path = f"{checkpoint_dir(spark)}/model-{uuid.uuid4().hex}"
    model = residual.fit_residual_model(matrix, BOOST, validation=F.col("split") == "val")
    model.save(path)
    both = residual.load_residual_model(spark, path).predict(model.predict(matrix), "reloaded_forecast")
    return both.select("category", "date", (F.col("residual_forecast") == F.col("reloaded_forecast")).alias("same"))


def top_features(spark, sf):
    return residual.top_features(residual.fit_residual_model(training_matrix(spark, sf), BOOST), 20)


def tuning_trials(spark, sf):
    return tuning.tune(training_matrix(spark, sf), TUNING, tuning.SPACE, BOOST)


def hybrid_forecast(spark, sf):
    history = durable(fitted_history(spark, sf))
    model = residual.fit_residual_model(durable(residual.model_matrix(history)), BOOST)
    rows = future.future_frame(history, HORIZON)
    state = ets.ets_fit(history, spec=FIXED)
    return hybrid.hybrid_forecast(state, model, rows, HORIZON, spec=FIXED)


def hybrid_combine(spark, sf):
    """Weekly changes as residual forecasts that often outweigh the base, so sums below zero occur."""
    rows = backtest(spark, sf).withColumn("step", F.row_number().over(Window.partitionBy("category").orderBy("date")))
    change = rows.select("category", "step", "date", (F.col("residual_forecast") - F.col("ets_forecast")).alias("residual_forecast"))
    return hybrid.combine(rows.select("category", "step", "ets_forecast"), change)


def pipeline_forecast(spark, sf):
    return run(spark, sf).forecast


def pipeline_metrics(spark, sf):
    return run(spark, sf).metrics


# ---------------------------------------------------------------------------------------
# Scores and reports


def eval_join(spark, sf):
    rows, forecast = fixed_forecast(spark, sf)
    test = splits.union_splits(rows, ("test",)).select("category", "date", "sales")
    return metrics.eval_join(test, forecast)


def plot_forecast_actual(spark, sf):
    rows, forecast = fixed_forecast(spark, sf)
    evaluated = metrics.eval_join(splits.union_splits(rows, ("test",)), forecast)
    train = splits.union_splits(rows, ("train",))
    return reports.plot_forecast_actual(train, evaluated, predicted="ets_forecast")


def forecast_metrics(spark, sf):
    return metrics.forecast_metrics(backtest(spark, sf), rounded=False)


def metrics_by_category(spark, sf):
    return metrics.forecast_metrics(backtest(spark, sf))


def metrics_overall(spark, sf):
    return metrics.metrics_overall(backtest(spark, sf))


def metrics_with_total(spark, sf):
    return metrics.metrics_with_total(backtest(spark, sf))


def target_verdict(spark, sf):
    return metrics.target_verdict(metrics_by_category(spark, sf))


def component_metrics(spark, sf):
    return metrics.component_metrics(backtest(spark, sf))


def component_improvement(spark, sf):
    return metrics.component_improvement(component_metrics(spark, sf))


def component_frame(spark, sf):
    return reports.component_frame(backtest(spark, sf))


def residual_frame(spark, sf):
    return reports.residual_frame(backtest(spark, sf))


def residual_summary(spark, sf):
    return reports.residual_summary(residual_frame(spark, sf))


def residual_histogram(spark, sf):
    return reports.residual_histogram(durable(residual_frame(spark, sf)))


def metrics_long(spark, sf):
    return reports.metrics_long(metrics_by_category(spark, sf))


def run_summary(spark, sf):
    rows = durable(panel(spark, sf).select("category", "date", "sales"))
    scored = durable(metrics.forecast_metrics(seasonal_naive(rows)))
    return reports.run_summary(sku_day(spark, sf), rows, scored)


_REGISTERED: dict[str, Query] = {
    "load_sku_day": load_sku_day,
    "csv_round_trip": csv_round_trip,
    "panel_sink": panel_sink,
    "panel_republish": panel_republish,
    "params_round_trip": params_round_trip,
    "series_encoding": series_encoding,
    "ets_state_reload": ets_state_reload,
    "load_exog": load_exog,
    "exog_round_trip": exog_round_trip,
    "duplicate_keys": duplicate_keys,
    "sku_keys": sku_keys,
    "input_profile": lambda s, d: rollup.input_profile(sku_day(s, d)),
    "low_instock_stats": lambda s, d: gapfill.low_stock_stats(sku_day(s, d)),
    "interpolate_low_instock": interpolate_low_instock,
    "interpolate_limit1": interpolate_limit1,
    "interpolate_long_gaps": interpolate_long_gaps,
    "interpolate_no_limit": interpolate_no_limit,
    "fill_report": fill_report,
    "category_rollup": panel,
    "weighted_avg": weighted_avg,
    "promo_intensity": promo_intensity,
    "panel_with_exog": full_panel,
    "panel_profile": lambda s, d: rollup.panel_profile(panel(s, d)),
    "mean_of_sku_means": lambda s, d: rollup.mean_of_sku_means(sku_day(s, d)),
    "event_shares": lambda s, d: rollup.event_shares(sku_day(s, d)),
    "weather_shares": lambda s, d: rollup.weather_shares(exog(s, d)),
    "validate_panel": lambda s, d: quality.validate_panel(panel(s, d)),
    "valid_panel": valid_panel,
    "date_continuity": lambda s, d: quality.date_continuity(panel(s, d)),
    "null_profile": null_profile,
    "holiday_calendar": holiday_calendar,
    "holiday_flag": holiday_flag,
    "date_spine": date_spine,
    "temporal_features": temporal_features,
    "lag_features": lag_features,
    "rolling_features": rolling_features,
    "days_since_promo": days_since_promo,
    "holiday_features": holiday_features,
    "weather_quantiles": weather_quantiles,
    "weather_features": weather_features,
    "engineer_features": feature_frame,
    "date_split": date_split,
    "semi_join_dates": semi_join_dates,
    "union_splits": union_splits,
    "expanding_folds": expanding_folds,
    "expanding_folds_start": expanding_folds_start,
    "fill_missing": fill_missing,
    "model_matrix": model_matrix,
    "tail_per_series": tail_per_series,
    "last_state": last_state,
    "series_describe": series_describe,
    "moving_average_fit": moving_average_fit,
    "ets_fallback": ets_fallback,
    "ets_fixed": ets_fixed,
    "ets_fit": ets_fit,
    "ets_search": ets_search,
    "ets_components": ets_components,
    "ets_forecast": ets_forecast,
    "ets_fit_stats": ets_fit_stats,
    "future_spine": future_spine,
    "future_lags": future_lags,
    "future_promo_plan": future_promo_plan,
    "climatology": climatology,
    "future_weather": future_weather,
    "future_weather_plan": future_weather_plan,
    "future_frame": future_frame,
    "residual_model": residual_model,
    "residual_model_mae": residual_model_mae,
    "model_reload": model_reload,
    "top_features": top_features,
    "tuning_trials": tuning_trials,
    "hybrid_combine": hybrid_combine,
    "hybrid_forecast": hybrid_forecast,
    "pipeline_forecast": pipeline_forecast,
    "pipeline_metrics": pipeline_metrics,
    "eval_join": eval_join,
    "plot_forecast_actual": plot_forecast_actual,
    "forecast_metrics": forecast_metrics,
    "metrics_by_category": metrics_by_category,
    "metrics_overall": metrics_overall,
    "metrics_with_total": metrics_with_total,
    "target_verdict": target_verdict,
    "component_metrics": component_metrics,
    "component_improvement": component_improvement,
    "component_frame": component_frame,
    "residual_frame": residual_frame,
    "residual_summary": residual_summary,
    "residual_histogram": residual_histogram,
    "metrics_long": metrics_long,
    "run_summary": run_summary,
}


def queries() -> dict[str, Query]:
    def finished(query: Query) -> Query:
        return lambda spark, sf_dir: tidy(query(spark, sf_dir))

    return {name: finished(query) for name, query in _REGISTERED.items()}
