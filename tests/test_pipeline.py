from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from saleslane.config import BoostConfig, EtsConfig, PipelineConfig, SplitConfig, TuningConfig
from saleslane.operators.residual import load_residual_model
from saleslane.plans import pipeline
from saleslane.plans.queries import exog, sku_day
from saleslane.plans.store import StageStore, content_key
from saleslane.sources.panels import load_params

SF_DIR = "/root/testdata/sf0.001"
CONFIG = PipelineConfig(
    split=SplitConfig(train=None, val=20, test=14, anchor="end"),
    ets=EtsConfig(alpha=0.2, beta=0.05, gamma=0.1),
    boost=BoostConfig(rounds=2, max_depth=2, patience=2),
    tuning=TuningConfig(trials=1, folds=1, min_train=500),
)


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    small = {"max_depth": ("int", 1, 2), "rounds": ("int", 1, 2)}
    path = str(tmp_path_factory.mktemp("run"))
    out = pipeline.run_pipeline(
        sku_day(spark, SF_DIR), exog(spark, SF_DIR), CONFIG, params_path=f"{path}/params", space=small, store=StageStore(spark, f"{path}/store")
    )
    return out, path


def test_forecast_has_a_row_per_series_and_day(run):
    forecast = run[0].forecast.toPandas()
    assert len(forecast) == 3 * 14 and forecast["step"].max() == 14
    assert (forecast["final_forecast"] >= 0).all()
    total = (forecast["ets_forecast"] + forecast["residual_forecast"]).clip(lower=0)
    assert (forecast["final_forecast"] - total).abs().max() < 1e-9


def test_run_is_scored_saved_and_reloaded(spark, run):
    result, path = run
    assert result.metrics.count() == 3 and result.components.count() == 3
    assert result.trials.count() == 1
    assert set(load_params(spark, f"{path}/params")) == {"max_depth", "rounds"}
    pipeline.save_run(result, f"{path}/out")
    assert spark.read.parquet(f"{path}/out/forecast").count() == 42
    assert spark.read.parquet(f"{path}/out/ets_state").count() == 3
    assert load_residual_model(spark, f"{path}/out/residual_model").rounds == result.model.rounds
    assert result.validation.count() == 7 and result.summary.count() > 10


def test_a_second_run_fits_nothing_and_a_killed_one_resumes(spark, run, monkeypatch, tmp_path):
    result, path = run
    small = {"max_depth": ("int", 1, 2), "rounds": ("int", 1, 2)}

    def forbidden(*a, **k):
        raise AssertionError("a finished stage was run again")

    inputs = sku_day(spark, SF_DIR).repartition(5), exog(spark, SF_DIR).repartition(2)
    store = StageStore(spark, f"{path}/store")
    with monkeypatch.context() as patch:
        for name in ("prepare_panel", "ets_fit", "with_ets_components", "model_matrix", "tune", "fit_residual_model", "hybrid_forecast", "eval_join"):
            patch.setattr(pipeline, name, forbidden)
        again = pipeline.run_pipeline(*inputs, CONFIG, space=small, store=store)
    order = ["category", "date"]
    assert again.forecast.orderBy(*order).collect() == result.forecast.orderBy(*order).collect()
    before = store.stages().count()
    with monkeypatch.context() as patch:
        patch.setattr(pipeline, "fit_residual_model", forbidden)
        # Other boosting parameters repeat the search and the fit, at which this run dies.
        other = replace(CONFIG, boost=replace(CONFIG.boost, learning_rate=0.2))
        with pytest.raises(AssertionError, match="again"):
            pipeline.run_pipeline(*inputs, other, space=small, store=store)
    assert store.stages().count() == before + 1
    with monkeypatch.context() as patch:
        for name in ("prepare_panel", "ets_fit", "tune"):
            patch.setattr(pipeline, name, forbidden)
        assert pipeline.run_pipeline(*inputs, other, space=small, store=store).forecast.count() == 42
    # Saved parameters take the place of the search.
    fixed = replace(CONFIG, tuning=replace(CONFIG.tuning, enabled=False))
    with monkeypatch.context() as patch:
        patch.setattr(pipeline, "tune", forbidden)
        reused = pipeline.run_pipeline(*inputs, fixed, params_path=f"{path}/params", store=store)
    assert reused.trials is None and reused.model.grown == result.model.grown
    copy = StageStore(spark, str(tmp_path / "s"))
    copy.table("t", "k", lambda: spark.range(3))
    copy.remove()
    assert not (tmp_path / "s").exists() and copy.stages().count() == 0
    changed = inputs[0].withColumn("sales", F.when(F.col("sales") > 0, F.col("sales") + 1).otherwise(F.col("sales")))
    assert content_key(inputs[0]) == content_key(sku_day(spark, SF_DIR)) != content_key(changed)
