import random

import pytest
from pyspark.sql import functions as F

from saleslane.config import BoostConfig, EtsConfig, TuningConfig
from saleslane.operators import hybrid, residual, tuning
from tests.helpers import day

SMALL = BoostConfig(rounds=4, learning_rate=0.5, max_depth=2, feature_fraction=1.0, row_fraction=1.0)


@pytest.fixture(scope="module")
def matrix(spark):
    rng = random.Random(1)
    rows = []
    for c in ("A", "B"):
        for i in range(120):
            promo = int(rng.random() < 0.3)
            noise = rng.uniform(-0.5, 0.5)
            split = "train" if i < 100 else "val"
            rows.append((c, day(i), rng.random(), promo, 10.0 * promo + noise, split))
    schema = "category string, date date, noise double, promo_flag int, ets_residual double, split string"
    return spark.createDataFrame(rows, schema).coalesce(1).cache()


def test_planted_signal_is_found(matrix):
    model = residual.fit_residual_model(matrix, SMALL, validation=F.col("split") == "val")
    mae = {r["split"]: r for r in residual.residual_mae(model, matrix).collect()}
    assert mae["val"]["mae"] < 0.5 * mae["val"]["mae_of_zero"]
    top = residual.top_features(model, 1).first()
    assert top["feature"] == "promo_flag" and top["importance"] > 0.9


def test_reloaded_model_predicts_the_same(spark, matrix, tmp_path):
    model = residual.fit_residual_model(matrix, SMALL)
    model.save(str(tmp_path / "m"))
    again = residual.load_residual_model(spark, str(tmp_path / "m"))

    def predicted(m):
        return [r[0] for r in m.predict(matrix).orderBy("category", "date").select("residual_forecast").collect()]

    assert predicted(model) == predicted(again) and again.features == model.features
    assert again.grown == model.grown and again.cuts == model.cuts


@pytest.mark.parametrize("most", [1024, 6])
def test_many_series_and_a_planted_group_of_them(spark, monkeypatch, tmp_path, most):
    # Every third of 30 series is 8 higher: no threshold on an arbitrary order of names finds that.
    monkeypatch.setattr(residual.series_codes, "__defaults__", (residual.KEYS, most))
    rng = random.Random(3)
    names = [f"s{rng.random()}" for _ in range(30)]
    rows = [(c, day(i), rng.random(), 8.0 * (k % 3 == 0) + rng.uniform(-1, 1)) for k, c in enumerate(names) for i in range(20)]
    many = spark.createDataFrame(rows, "category string, date date, noise double, ets_residual double")
    model = residual.fit_residual_model(many, BoostConfig(**{**SMALL.__dict__, "rounds": 12}))
    top = residual.top_features(model, 1).first()
    assert top["feature"] == "category" and top["importance"] > 0.9
    error = F.abs(F.col("ets_residual") - F.col("residual_forecast"))
    assert model.predict(many).agg(F.avg(error)).first()[0] < 0.7
    model.save(str(tmp_path / "m"))
    again = residual.load_residual_model(spark, str(tmp_path / "m"))
    stranger = spark.createDataFrame([("new", day(0), None, 0.0)], many.schema)
    assert again.predict(many.union(stranger)).where("residual_forecast is null").count() == 0


def test_encoding_leaves_out_the_rows_own_dates(spark):
    rows = [("A", day(28 * i + k), float(10**i)) for i in range(5) for k in (0, 1)] + [("B", day(0), 7.0), ("C", day(3), None)]
    df = spark.createDataFrame(rows, "category string, date date, ets_residual double")
    folds = {r.date: r.f for r in df.select("date", residual.fold_of(F.col("date")).alias("f")).collect()}
    got = {(r.category, r._fold): r._series_code for r in residual.series_encoding(df).collect()}
    for fold in range(5):
        rest = [y for c, d, y in rows if c == "A" and folds[d] != fold]
        assert got[("A", fold)] == pytest.approx(sum(rest) / len(rest))
    assert got[("A", -1)] == pytest.approx(2222.2)
    assert {got[("B", f)] for f in range(5)} == {0.0, 7.0} and got[("B", folds[day(0)])] == 0.0
    assert not any(c == "C" for c, _ in got)


def test_trees_after_the_best_round_are_dropped(matrix):
    held = F.col("split") == "val"
    config = BoostConfig(**{**SMALL.__dict__, "rounds": 60, "patience": 3})
    model = residual.fit_residual_model(matrix, config, validation=held)
    errors = model.validation_errors
    assert model.rounds == residual.best_round(errors, 3) and len(errors) == min(60, model.rounds + 3)
    shorter = residual.fit_residual_model(matrix, BoostConfig(**{**config.__dict__, "rounds": model.rounds}), validation=held)
    assert shorter.grown.trees == model.grown.trees


def test_patience():
    assert residual.best_round([5, 4, 3, 3.5, 3.4, 1], 2) == 3
    assert residual.best_round([5, 4, 3, 3.5, 3.4, 1], 9) == 6
    assert residual.best_round([5], 3) == 1


def test_features_and_matrix(spark):
    schema = "category string, date date, sales double, lag_7 double, num_skus int, ets_residual double, x int"
    df = spark.createDataFrame(
        [("A", day(0), 1.0, None, 3, 0.1, 1), ("A", day(1), 1.0, 4.0, 3, None, None)], schema
    )
    assert residual.feature_columns(df) == ["category", "lag_7", "x"]
    got = residual.model_matrix(df).orderBy("date").collect()
    assert [r["lag_7"] for r in got] == [4.0, 4.0] and [r["x"] for r in got] == [1, 1]


def test_tuned_values_replace_defaults():
    merged = residual.merge_params(BoostConfig(), {"rounds": 77.0, "learning_rate": 0.2, "unknown": 1})
    assert (merged.rounds, merged.learning_rate, merged.max_depth) == (77, 0.2, 5)


def test_search_is_seeded_and_stays_in_its_space():
    a, b = (tuning.sample_params(tuning.SPACE, 20, 42) for _ in range(2))
    assert a == b and len(a) == 20
    for params in a:
        for name, (_, low, high) in tuning.SPACE.items():
            assert low <= params[name] <= high


def test_trials_cover_all_folds(matrix):
    space = {"max_depth": ("int", 1, 2), "rounds": ("int", 1, 2)}
    trials = tuning.tune(
        matrix, TuningConfig(trials=2, folds=2, min_train=80, val=15), space, SMALL
    )
    rows = trials.collect()
    assert {(r["trial"], r["fold"]) for r in rows} == {(0, 0), (0, 1), (1, 0), (1, 1)}
    assert all(r["mae"] is not None for r in rows)
    assert set(tuning.best_params(trials)) == {"max_depth", "rounds"}


def test_forecast_is_never_negative_and_needs_a_state(spark):
    schema = "category string, step int, date date, {} double"
    smoothed = spark.createDataFrame([("A", 1, day(1), 5.0), ("A", 2, day(2), 5.0)], schema.format("ets_forecast"))
    extra = spark.createDataFrame([("A", 1, day(1), -9.0), ("A", 2, day(2), None)], schema.format("residual_forecast"))
    got = hybrid.combine(smoothed, extra).orderBy("step").collect()
    assert [r["final_forecast"] for r in got] == [0.0, None]
    stranger = spark.createDataFrame([("Z", 1, day(1), 1.0)], schema.format("residual_forecast"))
    with pytest.raises(Exception, match="no fitted state for series Z"):
        hybrid.combine(smoothed, stranger).collect()
    with pytest.raises(ValueError, match="no fitted residual model"):
        hybrid.hybrid_forecast(smoothed, None, extra, spec=EtsConfig())
