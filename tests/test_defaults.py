"""Registered model queries run the whole default job."""

from saleslane.config import BoostConfig, EtsConfig, TuningConfig
from saleslane.operators.tuning import SPACE
from saleslane.plans import queries


def test_registered_model_queries_use_the_defaults(spark, monkeypatch):
    tuned, fitted, runs = [], [], []
    monkeypatch.setattr(queries, "training_matrix", lambda *a: None)
    monkeypatch.setattr(queries, "sku_day", lambda *a: None)
    monkeypatch.setattr(queries, "exog", lambda *a: None)
    monkeypatch.setattr(queries.tuning, "tune", lambda *a: tuned.append(a))
    monkeypatch.setattr(queries.residual, "fit_residual_model", lambda matrix, boost, **k: fitted.append(boost))
    monkeypatch.setattr(queries.residual, "residual_mae", lambda *a: None)
    monkeypatch.setattr(queries.residual, "top_features", lambda *a: None)
    monkeypatch.setattr(queries, "run_pipeline", lambda sku_day, exog, config: runs.append(config))
    queries.tuning_trials(spark, "")
    queries.residual_model_mae(spark, "")
    queries.top_features(spark, "")
    queries.run(spark, "")
    assert tuned == [(None, TuningConfig(), SPACE, BoostConfig())]
    assert fitted == [BoostConfig()] * 2
    assert (runs[0].boost, runs[0].tuning, runs[0].ets) == (BoostConfig(), TuningConfig(), EtsConfig())
