"""The whole run, from SKU-day rows to scored forecasts."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleslane.config import BoostConfig, PipelineConfig
from saleslane.operators.ets import ets_fit, with_ets_components
from saleslane.operators.features import engineer_features
from saleslane.operators.future import future_frame
from saleslane.operators.gapfill import fill_low_stock
from saleslane.operators.hybrid import hybrid_forecast
from saleslane.operators.metrics import component_metrics, eval_join, forecast_metrics
from saleslane.operators.quality import validate_panel
from saleslane.operators.reports import run_summary
from saleslane.operators.residual import (
    ResidualModel,
    fit_residual_model,
    load_residual_model,
    merge_params,
    model_matrix,
    top_features,
)
from saleslane.operators.rollup import join_exog, rollup
from saleslane.operators.splits import date_split, union_splits
from saleslane.operators.tuning import SPACE, best_params, tune
from saleslane.plans.durable import checkpoint_dir
from saleslane.plans.store import StageStore, content_key, hash_of
from saleslane.sources.panels import load_params, save_params, write_panel
from saleslane.sources.published import PublishedPanel


@dataclass(frozen=True)
class Run:
    """Everything a run produced; the frames are lazy but for the stored stages."""

    sku_day: DataFrame
    panel: DataFrame
    validation: DataFrame
    features: DataFrame
    history: DataFrame
    state: DataFrame
    model: ResidualModel
    forecast: DataFrame
    evaluated: DataFrame
    metrics: DataFrame
    components: DataFrame
    summary: DataFrame
    trials: DataFrame | None = None


def prepare_panel(
    sku_day: DataFrame, exog: DataFrame | None, config: PipelineConfig = PipelineConfig()
) -> DataFrame:
    """Fill low-stock days, roll up and join the exogenous columns."""
    aggregation = config.aggregation
    filled = fill_low_stock(
        sku_day, aggregation.instock_threshold, aggregation.interpolation_limit
    )
    panel = rollup(filled, config.keys, aggregation.promo_threshold)
    return panel if exog is None else join_exog(panel, exog, config.keys)


def run_pipeline(
    sku_day: DataFrame,
    exog: DataFrame | None = None,
    config: PipelineConfig = PipelineConfig(),
    promo_plan: DataFrame | None = None,
    weather: DataFrame | None = None,
    params_path: str | None = None,
    space: dict = SPACE,
    store: StageStore | None = None,
) -> Run:
    """Prepare, split, fit, forecast and score.

    Every frame that several later steps read is a stage, a stored table that cuts the lineage.
    With a ``store`` finished stages of an earlier run over the same inputs and parameters are read
    back, so a killed run resumes and a second one fits nothing; without it stages are this run's own.
    Tuned parameters are saved to ``params_path``; without tuning they are read from there.
    """
    spark, keys, split = sku_day.sparkSession, config.keys, config.split
    store = store or StageStore(spark, f"{checkpoint_dir(spark)}/run-{uuid.uuid4().hex}")
    sku_day_key = content_key(sku_day)
    panel_key = hash_of("panel", sku_day_key, exog and content_key(exog), keys, config.aggregation)
    panel = store.table("panel", panel_key, lambda: prepare_panel(sku_day, exog, config))

    features_key = hash_of("features", panel_key, config.features, split)
    features = store.table(
        "features",
        features_key,
        lambda: date_split(
            engineer_features(panel, config.features, keys),
            split.train,
            split.val,
            split.test,
            split.anchor,
            dates=sku_day.dropna(subset=[*keys]),
        ),
    )
    fitted_rows = union_splits(features, ("train", "val"))
    test = union_splits(features, ("test",))

    state_key = hash_of("state", features_key, config.ets)
    state = store.table("state", state_key, lambda: ets_fit(fitted_rows, keys, "sales", config.ets))
    history = store.table(
        "history", hash_of("history", state_key), lambda: with_ets_components(fitted_rows, state, keys, "sales", config.ets)
    )
    matrix = store.table("matrix", hash_of("matrix", state_key), lambda: model_matrix(history, keys))

    trials, tuned = None, None
    if config.tuning.enabled:
        trials_key = hash_of("trials", state_key, config.tuning, config.boost, sorted(space.items()))
        trials = store.table("trials", trials_key, lambda: tune(matrix, config.tuning, space, config.boost, keys))
        tuned = best_params(trials)
        if params_path:
            save_params(spark, tuned, params_path)
    elif params_path:
        tuned = load_params(spark, params_path)
    boost: BoostConfig = merge_params(config.boost, tuned)
    model_key = hash_of("model", state_key, boost)
    is_val = F.col("split") == "val"
    model_path = store.path_of("model", model_key, lambda path: fit_residual_model(matrix, boost, keys, is_val).save(path))
    model = load_residual_model(spark, model_path)

    horizon = config.horizon or split.test
    plans = [df and content_key(df) for df in (promo_plan, weather)]

    def forecast_rows() -> DataFrame:
        future = future_frame(history, horizon, keys, promo_plan, weather, config.features)
        return hybrid_forecast(state, model, future, horizon, keys, config.ets)

    forecast_key = hash_of("forecast", model_key, horizon, plans)
    forecast = store.table("forecast", forecast_key, forecast_rows)
    evaluated = store.table("evaluated", hash_of("evaluated", forecast_key), lambda: eval_join(test, forecast, keys))
    metrics = forecast_metrics(evaluated, keys=keys, m=config.ets.period)
    return Run(
        sku_day=sku_day,
        panel=panel,
        validation=validate_panel(panel, keys),
        features=features,
        history=history,
        state=state,
        model=model,
        forecast=forecast,
        evaluated=evaluated,
        metrics=metrics,
        components=component_metrics(evaluated, keys=keys),
        summary=run_summary(sku_day, features, metrics, config.targets, keys),
        trials=trials,
    )


def save_run(run: Run, path: str, fmt: str = "parquet") -> None:
    """Write the tables, the smoothing state and the residual model of a run."""
    tables = {
        "sku_day": run.sku_day,
        "category_day": run.panel,
        "features": run.features,
        "forecast": run.forecast,
        "metrics": run.metrics,
        "component_metrics": run.components,
        "feature_importance": top_features(run.model, 20),
        "summary": run.summary,
    }
    for name, df in tables.items():
        write_panel(df, f"{path}/{name}", fmt)
    write_panel(run.state, f"{path}/ets_state", "parquet")
    run.model.save(f"{path}/residual_model")


def publish_run(run: Run, path: str, by: tuple[str, ...] = ("date",)) -> None:
    """Publish the panel, features and forecast of a run under ``path``.

    A later run replaces only the partitions that it has rows for; a table changes as a whole, and a
    failed run leaves what was there.
    """
    for name, df in {"category_day": run.panel, "features": run.features, "forecast": run.forecast}.items():
        PublishedPanel(df.sparkSession, f"{path}/{name}", by).publish(df)
