import datetime as dt
import random

import pandas as pd

from saleslane.operators import future, spine
from tests.helpers import day, ordered, same, series

WEATHER = "category string, date date, avg_temperature double, avg_rainfall double, avg_snowfall double"


def weather(spark, n, start, category="A", seed=1):
    rng = random.Random(seed)
    rows = [
        (category, day(i, start), rng.uniform(20, 90), rng.random(), rng.random()) for i in range(n)
    ]
    return spark.createDataFrame(rows, WEATHER)


def test_lags_repeat_the_last_actual(spark):
    history = series(spark, range(1, 21)).selectExpr("*", "sales / 100 AS promo_intensity")
    got = ordered(future.future_lags(history, 30), "step")
    y = list(range(1, 21))
    for k in (7, 14, 28):
        want = [None if 20 + i - k < 0 else y[min(20 + i - k, 19)] for i in range(30)]
        same(got[f"lag_{k}"], want)
    same(got["promo_lag_7"], [(14 + i) / 100 if i < 7 else None for i in range(30)])


def test_climatology_equals_a_loop_and_stops_at_new_year(spark):
    history = weather(spark, 700, dt.date(2019, 1, 20))
    rows = spine.future_spine(history, 30)
    got = ordered(future.climatology(history, rows), "step")
    past = ordered(history)
    past["doy"] = pd.to_datetime(past["date"]).dt.dayofyear
    for r in got.itertuples():
        doy = pd.Timestamp(r.date).dayofyear
        near = past[(past["doy"] >= doy - 7) & (past["doy"] <= doy + 7)]
        same([r.avg_temperature, r.avg_snowfall], [near["avg_temperature"].mean(), near["avg_snowfall"].mean()])
    assert pd.Timestamp(got["date"].iloc[0]) == pd.Timestamp("2020-12-20")
    wrapped = ordered(future.climatology(history, rows, wrap=True), "step")
    assert abs(wrapped["avg_temperature"] - got["avg_temperature"]).max() > 1e-6


def test_climatology_without_neighbours(spark):
    history = weather(spark, 20, dt.date(2020, 3, 1))
    rows = spark.createDataFrame(
        [("A", 1, dt.date(2020, 9, 1))], "category string, step int, date date"
    )
    row = future.climatology(history, rows).first()
    same([row["avg_temperature"]], [ordered(history)["avg_temperature"].mean()])
    assert (row["avg_rainfall"], row["avg_snowfall"]) == (0.0, 0.0)


def test_plan_covers_some_series_only(spark):
    history = series(spark, range(5)).unionByName(series(spark, range(5), "B"))
    rows = spine.future_spine(history, 3)
    plan = spark.createDataFrame(
        [("A", day(6), 0.7, 1)],
        "category string, date date, promo_intensity double, promo_flag int",
    )
    got = ordered(future.future_promo_plan(rows, plan), "category", "step")
    same(got["promo_intensity"], [None, 0.7, None, 0, 0, 0])
    same(got["promo_flag"], [None, 1, None, 0, 0, 0])
    none = ordered(future.future_promo_plan(rows), "category", "step")
    assert (none["promo_flag"] == 0).all()


def test_weather_forecast_replaces_climatology(spark):
    history = weather(spark, 60, dt.date(2020, 1, 1)).unionByName(
        weather(spark, 60, dt.date(2020, 1, 1), "B", 2)
    )
    rows = spine.future_spine(history, 5)
    plan = weather(spark, 5, dt.date(2020, 3, 1), "B", 3)
    got = ordered(future.future_weather(history, rows, plan), "category", "step")
    same(got["avg_temperature"][5:], ordered(plan)["avg_temperature"])
    norm = got["avg_temperature"][5:].rolling(14, min_periods=1).mean()
    same(got["temp_rolling_avg_14"][5:], norm)
    assert got["avg_temperature"][:5].notna().all()


def test_frame_freezes_the_last_state(spark):
    history = series(spark, range(1, 31)).selectExpr(
        "*", "sales * 2 AS rolling_mean_7", "sales * 3 AS rolling_mean_28",
        "sales + 1 AS final_sku_price", "0.1 AS promo_intensity", "4 AS days_since_promo",
        "7.5 AS ets_level",
    )
    got = ordered(future.future_frame(history, 4), "step")
    assert got["rolling_mean_7"].tolist() == [60.0] * 4
    assert got["days_since_promo"].tolist() == [5, 6, 7, 8]
    assert got["num_skus"].tolist() == [10.0] * 4
    assert (got["holiday_flag"] == -100).all() and (got["instock_rate"] == 95.0).all()
    assert (got["ets_level"] == 7.5).all() and (got["pct_skus_on_high_impact_promo"] == 0).all()
    assert [str(d)[:10] for d in got["date"]] == [str(day(30 + i)) for i in range(4)]
