import random

import numpy as np
import pandas as pd

from saleslane.operators import metrics, reports
from tests.helpers import day, ordered, same

SCHEMA = "category string, date date, sales double, ets_forecast double, final_forecast double"


def frame(spark, values, category="A"):
    rows = [(category, day(i), *map(lambda v: None if v is None else float(v), r)) for i, r in enumerate(values)]
    return spark.createDataFrame(rows, SCHEMA)


def random_values(seed, n=40):
    rng = random.Random(seed)
    return [(rng.uniform(0, 50), rng.uniform(0, 50), rng.uniform(0, 50)) for _ in range(n)]


def scores(a, p, m=7):
    a, p = np.array(a), np.array(p)
    used = a > 1e-10
    mae = np.abs(a - p).mean()
    return {
        "mape": np.abs((a - p)[used] / a[used]).mean() * 100,
        "mae": mae,
        "rmse": np.sqrt(((a - p) ** 2).mean()),
        "mase": mae / np.abs(a[m:] - a[:-m]).mean(),
        "bias_pct": (p.sum() - a.sum()) / a.sum() * 100,
        "r2": 1 - ((a - p) ** 2).sum() / ((a - a.mean()) ** 2).sum(),
        "mean_actual": a.mean(),
        "mean_predicted": p.mean(),
    }


def test_scores_equal_numpy(spark):
    values = random_values(1)
    values[5] = (0.0, 3.0, 4.0)  # a zero actual leaves the percentage error
    other = random_values(2)
    df = frame(spark, values).unionByName(frame(spark, other, "B")).repartition(7)
    got = {r["category"]: r for r in metrics.forecast_metrics(df, rounded=False).collect()}
    for name, v in (("A", values), ("B", other)):
        want = scores([x[0] for x in v], [x[2] for x in v])
        same([got[name][k] for k in want], list(want.values()))
        assert got[name]["n_samples"] == 40
    total = {r["is_total"]: r for r in metrics.metrics_with_total(df).where("is_total = 1").collect()}
    overall = metrics.metrics_overall(df).first().asDict()
    assert {k: total[1][k] for k in overall} == overall
    a, b = values, other
    pooled = scores([x[0] for x in a + b], [x[2] for x in a + b])
    assert overall["mae"] == round(pooled["mae"], 2)
    naive = [abs(v[i][0] - v[i - 7][0]) for v in (a, b) for i in range(7, 40)]
    assert overall["mase"] == round(pooled["mae"] / np.mean(naive), 3)


def test_undefined_scores_are_null(spark):
    flat = metrics.forecast_metrics(frame(spark, [(5, 4, 4)] * 10)).first()
    assert flat["mase"] is None and flat["r2"] is None and flat["mae"] == 1.0
    short = metrics.forecast_metrics(frame(spark, random_values(3, 7))).first()
    assert short["mase"] is None and short["mape"] is not None
    zeros = metrics.forecast_metrics(frame(spark, [(0, 1, 1)] * 9)).first()
    assert zeros["mape"] is None and zeros["bias_pct"] is None
    hole = random_values(4)
    hole[3] = (hole[3][0], 1.0, None)
    row = metrics.forecast_metrics(frame(spark, hole)).first()
    assert row["mae"] is None and row["mape"] is None and row["mase"] is None
    assert row["mean_predicted"] is None and row["mean_actual"] is not None


def test_component_gains(spark):
    df = frame(spark, [(10, 8, 9), (10, 12, 10)])
    row = metrics.component_metrics(df).first()
    assert (row["ets_mae"], row["final_mae"], row["mae_improvement_pct"]) == (2.0, 0.5, 75.0)
    exact = metrics.component_metrics(frame(spark, [(10, 10, 9)] * 3))
    assert exact.first()["mae_improvement_pct"] == 0.0
    assert metrics.component_improvement(exact).first()["avg_mape_improvement_pct"] == 0.0


def test_verdict_and_long_form(spark):
    df = frame(spark, [(10 + i % 3, 0, 10 + i % 3) for i in range(20)])
    scored = metrics.forecast_metrics(df)
    verdict = metrics.target_verdict(scored).first()
    assert verdict["targets_met"] and verdict["n_series"] == 1
    long = {r["metric"]: r["target"] for r in reports.metrics_long(scored).collect()}
    assert long == {"mape": 20.0, "mae": None, "mase": 1.0, "bias_pct": 0.0}


def test_missing_forecast_days_stay_in_the_evaluation(spark):
    df = frame(spark, random_values(5, 3))
    forecast = df.select("category", "date", "final_forecast").where(f"date <> date'{day(1)}'")
    got = ordered(metrics.eval_join(df.drop("final_forecast", "ets_forecast"), forecast))
    assert got["final_forecast"].isna().tolist() == [False, True, False]


def test_residual_reports(spark):
    values = random_values(6, 200)
    values[0] = (0.0, 0.0, 1.0)
    residuals = reports.residual_frame(frame(spark, values))
    pdf = ordered(residuals)
    assert pd.isna(pdf["ape"].iloc[0]) and pdf["ape"].notna().sum() == 199
    counts, edges = np.histogram(pdf["residual"], bins=30)
    got = ordered(reports.residual_histogram(residuals), "bin").set_index("bin")
    assert got["n_rows"].to_dict() == {i: int(c) for i, c in enumerate(counts) if c}
    same([got["bin_start"].iloc[0]], [edges[0]])
    flat = reports.residual_histogram(reports.residual_frame(frame(spark, [(5, 0, 4)] * 6))).collect()
    assert [(r["bin"], r["n_rows"]) for r in flat] == [(15, 6)]
    summary = reports.residual_summary(residuals).first()
    same([summary["std_residual"]], [pdf["residual"].std(ddof=0)])


def test_plot_frame_and_summary(spark):
    df = frame(spark, random_values(7, 120))
    train = df.where(f"date < date'{day(100)}'")
    test = df.where(f"date >= date'{day(100)}'")
    plot = reports.plot_forecast_actual(train, test)
    assert plot.where("part = 'train'").count() == 90 and plot.where("part = 'test'").count() == 20
    assert {r["forecast_start"] for r in plot.collect()} == {day(100)}
    summary = reports.run_summary(df, df, metrics.forecast_metrics(df))
    items = {(r["section"], r["item"]): r["value"] for r in summary.collect()}
    assert items[("data", "panel_rows")] == "120" and ("targets", "status") in items
