import itertools
import math
import random

import numpy as np
import pandas as pd
import pytest

from saleslane.config import EtsConfig
from saleslane.operators import ets, smoothing
from tests.helpers import ordered, same, series


def wave(seed, n=60):
    rng = random.Random(seed)
    return [
        50 + 0.3 * i + 12 * math.sin(2 * math.pi * i / 7) + rng.uniform(-4, 4) for i in range(n)
    ]


def recursion(y, spec, alpha, beta, gamma, phi):
    """Textbook smoothing with numbers and full histories; returns fits, levels and state."""
    m = spec.period
    first, second = np.mean(y[:m]), np.mean(y[m : 2 * m])
    level, fits, levels = first, [], []
    trend = {"add": (second - first) / m, "mul": (second / first) ** (1 / m), None: None}[spec.trend]
    season = {
        "mul": [v / first for v in y[:m]], "add": [v - first for v in y[:m]], None: [],
    }[spec.seasonal]
    phi = phi if spec.damped and spec.trend else 1.0
    for t, v in enumerate(y):
        base = {None: level, "add": level + phi * (trend or 0), "mul": level * (trend or 1) ** phi}[spec.trend]
        s = season[t] if season else None
        fits.append({None: base, "add": base + (s or 0), "mul": base * (s or 1)}[spec.seasonal])
        clean = {None: v, "add": v - (s or 0), "mul": v / (s or 1)}[spec.seasonal]
        new = alpha * clean + (1 - alpha) * base
        if season:
            raw = v / base if spec.seasonal == "mul" else v - base
            season.append(gamma * raw + (1 - gamma) * s)
        if spec.trend == "add":
            trend = beta * (new - level) + (1 - beta) * phi * trend
        elif spec.trend == "mul":
            trend = beta * new / level + (1 - beta) * trend**phi
        level = new
        levels.append(level)
    return fits, levels, level, trend, season[-m:]


VARIANTS = list(itertools.product(["add", "mul", None], ["add", "mul", None], [True, False]))


@pytest.mark.parametrize("trend,seasonal,damped", VARIANTS)
def test_variants_match_the_textbook(spark, trend, seasonal, damped):
    spec = EtsConfig(trend=trend, seasonal=seasonal, damped=damped, alpha=0.3, beta=0.1, gamma=0.2)
    y = wave(1)
    df = series(spark, y)
    state = ets.ets_fit(df, spec=spec)
    fits, levels, level, b, season = recursion(y, spec, 0.3, 0.1, 0.2, 0.98)
    got = ordered(ets.ets_components(df, state, spec=spec))
    same(got["ets_fitted"], fits)
    same(got["ets_level"], levels)
    same(got["ets_residual"], np.array(y) - np.array(fits))
    row = state.first()
    assert not row["fallback"] and row["n"] == len(y)
    same([row["level"], row["sse"]], [level, sum((a - f) ** 2 for a, f in zip(y, fits))])
    same(row["season"], season)

    forecast = ordered(ets.ets_forecast(state, 10, spec=spec), "step")
    phi = 0.98 if damped and trend else 1.0
    for h in range(1, 11):
        damping = sum(phi**i for i in range(1, h + 1))
        base = {None: level, "add": level + (b or 0) * damping, "mul": level * (b or 1) ** damping}[trend]
        s = season[(h - 1) % 7] if season else None
        want = {None: base, "add": base + (s or 0), "mul": base * (s or 1)}[seasonal]
        same([forecast["ets_forecast"].iloc[h - 1]], [want])


def test_grid_winner_has_the_least_error_and_refining_helps(spark):
    spec = EtsConfig(grid_alpha=(0.1, 0.4), grid_beta=(0.0, 0.1), grid_gamma=(0.1, 0.3),
                     grid_phi=(0.9, 0.98), refine=False)
    y = wave(2)
    row = ets.ets_fit(series(spark, y), spec=spec).first()

    def sse(*params):
        fits = recursion(y, spec, *params)[0]
        return sum((a - f) ** 2 for a, f in zip(y, fits))

    grid = itertools.product(spec.grid_alpha, spec.grid_beta, spec.grid_gamma, spec.grid_phi)
    best = min(grid, key=lambda p: (sse(*p), p))
    assert (row["alpha"], row["beta"], row["gamma"], row["phi"]) == best
    finer = EtsConfig(**{**spec.__dict__, "refine": True})
    refined = ets.ets_fit(series(spark, y), spec=finer).first()
    assert refined["sse"] <= row["sse"]
    same([refined["sse"]], [sse(refined["alpha"], refined["beta"], refined["gamma"], refined["phi"])])


def test_partly_given_parameters_are_searched(spark):
    assert not EtsConfig(alpha=0.2, beta=0.1).is_fixed


@pytest.mark.parametrize(
    "y", [wave(3, 13), [0.0] + wave(3, 20), wave(3, 20) + [None], [-5.0] * 20],
    ids=["short", "zero", "missing", "negative"],
)
def test_fallback_is_a_trailing_mean(spark, y):
    spec = EtsConfig(alpha=0.2, beta=0.1, gamma=0.1)
    df = series(spark, y)
    state = ets.ets_fit(df, spec=spec)
    assert state.first()["fallback"]
    got = ordered(ets.ets_components(df, state, spec=spec))
    want = pd.Series(y, dtype=float).rolling(7, min_periods=1).mean()
    same(got["ets_fitted"], want)
    same(got["ets_fitted"], ordered(ets.moving_average_fit(df))["ets_fitted"])
    forecast = ordered(ets.ets_forecast(state, 3, spec=spec), "step")
    same(forecast["ets_forecast"], [want.iloc[-1]] * 3)


def test_series_longer_than_a_batch_and_any_layout(spark):
    spec = EtsConfig(alpha=0.3, beta=0.1, gamma=0.2)
    df = series(spark, wave(4, 90))
    for i, name in enumerate("BCDEF"):
        df = df.unionByName(series(spark, wave(5 + i, 30 + 9 * i), name))
    df = df.unionByName(series(spark, wave(9, 5), "short"))
    whole = ordered(ets.ets_components(df, ets.ets_fit(df, spec=spec), spec=spec))
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "4")
    try:
        mixed = df.repartition(5)
        small = ordered(ets.ets_components(mixed, ets.ets_fit(mixed, spec=spec), spec=spec))
    finally:
        spark.conf.set(key, before)
    assert len(whole) == df.count()
    pd.testing.assert_frame_equal(whole, small)


def test_statistics_and_join(spark):
    spec = EtsConfig(alpha=0.3, beta=0.1, gamma=0.2)
    df = series(spark, wave(6))
    state = ets.ets_fit(df, spec=spec)
    joined = ordered(ets.with_ets_components(df, state, spec=spec))
    residual = joined["sales"] - joined["ets_fitted"]
    same(joined["ets_residual"], residual)
    row = ets.ets_fit_stats(ets.ets_components(df, state, spec=spec)).first()
    same([row["mse"], row["mae"]], [(residual**2).mean(), residual.abs().mean()])
    same([row["mape"]], [(residual / joined["sales"]).abs().mean() * 100])
    described = ets.series_describe(df).first()
    same([described["std"]], [joined["sales"].std(ddof=0)])


def test_early_abandonment_finds_the_winner_of_the_full_search_in_fewer_steps():
    values = [np.array(wave(s, 200 + 70 * s)) for s in range(4)] + [np.array([7.0] * 40)]
    for spec, share in ((EtsConfig(refine=False), 0.7), (EtsConfig(), 1.0), (EtsConfig(trend="mul", seasonal="add", refine=False), 0.9)):
        with np.errstate(all="ignore"):
            pruned, few = smoothing.search(spec, values)
            full, many = smoothing.search(spec, values, prune=False)
            alone = [smoothing.search(spec, [v])[0][0] for v in values]
        assert pruned == full == alone and few < share * many


def test_rows_keep_their_columns_and_series_without_a_state(spark):
    spec = EtsConfig(alpha=0.3, beta=0.1, gamma=0.2)
    df = series(spark, wave(6)).unionByName(series(spark, wave(7), "B")).selectExpr("*", "named_struct('k', 1) AS extra", "sales AS ets_fitted")
    state = ets.ets_fit(df.where("category = 'A'"), spec=spec)
    got = ets.with_ets_components(df, state, spec=spec)
    assert got.columns == ["category", "date", "sales", "extra", "ets_fitted", "ets_residual", "ets_level"]
    assert got.where("ets_level is null").select("category").distinct().collect() == [("B",)] and got.count() == df.count()
    assert {r[0] for r in ets.ets_components(df, state, spec=spec).select("category").collect()} == {"A"}
