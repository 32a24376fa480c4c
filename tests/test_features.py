import datetime as dt
import random

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from saleslane.config import FeatureConfig
from saleslane.functions.dates import TEMPORAL, sku_key, temporal_columns
from saleslane.operators import features, holidays, spine
from tests.helpers import day, ordered, same, series


def test_temporal_features_equal_pandas(spark):
    dates = pd.date_range("2019-12-20", "2026-02-01")
    df = spark.createDataFrame([(d.date(),) for d in dates], "date date")
    got = ordered(features.add_temporal(df), "date")
    iso = dates.isocalendar().week.astype(int).to_numpy()
    same(got["day_of_week"], dates.dayofweek)
    same(got["week_of_year"], iso)
    same(got["day_of_year"], dates.dayofyear)
    same(got["week_of_month"], (dates.day - 1) // 7 + 1)
    same(got["is_weekend"], dates.dayofweek >= 5)
    same(got["week_of_year_sin"], np.sin(2 * np.pi * iso / 52))
    same(got["day_of_year_cos"], np.cos(2 * np.pi * dates.dayofyear / 365.25))
    assert list(temporal_columns(F.col("date"))) == list(TEMPORAL)
    week53 = got[got["date"] == dt.date(2020, 12, 30)].iloc[0]
    assert week53["week_of_year"] == 53


def test_lags_and_rolling_means_equal_pandas(spark):
    rng = random.Random(1)
    values = [None if rng.random() < 0.1 else rng.uniform(1, 9) for _ in range(60)]
    df = series(spark, values).unionByName(series(spark, values[::-1], "B"))
    got = ordered(features.add_rolling(features.add_lags(df, (7, 14), None), (7,)))
    for _, part in got.groupby("category"):
        s = part["sales"]
        same(part["lag_7"], s.shift(7))
        same(part["lag_14"], s.shift(14))
        same(part["rolling_mean_7"], s.rolling(7, min_periods=7).mean())
    shifted = ordered(features.add_rolling(df, (7,), exclude_current=True))
    part = shifted[shifted["category"] == "A"]
    same(part["rolling_mean_7"], part["sales"].shift(1).rolling(7, min_periods=7).mean())


def test_lags_are_positional_unless_densified(spark):
    df = series(spark, range(12)).where(f"date <> date'{day(3)}'")
    positional = ordered(features.add_lags(df, (7,), None))
    assert positional["lag_7"].iloc[-1] == 4 - 0.0 and positional["date"].iloc[-1] == day(11)
    dense = ordered(features.add_lags(spine.densify(df), (7,), None))
    assert len(dense) == 12 and dense["lag_7"].iloc[-1] == 4
    assert pd.isna(dense["lag_7"].iloc[10])


def test_days_since_promo(spark):
    flags = series(spark, [1, 0, 0, 1, 1, 0], col="promo_flag")
    got = ordered(features.add_days_since(flags))
    assert got["days_since_promo"].tolist() == [999, 1, 2, 3, 1, 1]


def test_weather_flags_use_exact_quantiles(spark):
    rng = random.Random(2)
    rows = [("A", day(i), rng.uniform(20, 90), rng.random(), rng.random()) for i in range(80)]
    df = spark.createDataFrame(
        rows, "category string, date date, avg_temperature double, avg_rainfall double, avg_snowfall double"
    )
    got = ordered(features.add_weather(df))
    temp, rain = got["avg_temperature"], got["avg_rainfall"] + got["avg_snowfall"]
    same(got["is_extreme_cold"], temp < temp.quantile(0.1))
    same(got["is_extreme_hot"], temp > temp.quantile(0.9))
    same(got["heavy_precip_flag"], rain > rain.quantile(0.9))
    same(got["temp_deviation"], temp - temp.rolling(14, min_periods=14).mean())
    against = ordered(features.add_weather(df, reference=df.where(f"date < date'{day(40)}'")))
    same(against["is_extreme_hot"], temp > temp[:40].quantile(0.9))


def test_feature_groups_follow_the_columns(spark):
    plain = features.engineer_features(series(spark, range(30)), FeatureConfig(lags=(3,)))
    assert "lag_3" in plain.columns and "rolling_mean_7" in plain.columns
    assert not {"is_pre_holiday", "temp_deviation", "days_since_promo"} & set(plain.columns)


def test_holiday_flag_equals_a_loop(spark):
    years = range(2019, 2026)
    fixed = [dt.date(y, m, d) for y in years for m, d in ((1, 1), (7, 4), (12, 25))]
    thanksgiving = []
    for y in years:
        thursdays = [d for d in (dt.date(y, 11, 1 + i) for i in range(30)) if d.weekday() == 3]
        thanksgiving.append(thursdays[3])
    listed = fixed + thanksgiving
    dates = [d.date() for d in pd.date_range("2020-01-01", "2024-12-31")]

    def nearest(d):
        best = min(range(len(listed)), key=lambda i: (abs((listed[i] - d).days), i))
        away = (listed[best] - d).days
        return away if -5 <= away <= 14 else -100

    df = spark.createDataFrame([(d,) for d in dates], "date date")
    got = ordered(holidays.with_holiday_flag(df), "date")
    assert got["holiday_flag"].tolist() == [nearest(d) for d in dates]
    phases = ordered(holidays.add_holiday_phases(holidays.with_holiday_flag(df)), "date")
    assert (phases["is_holiday_peak"].sum()) == 4 * 5
    assert ((phases["holiday_flag"] == 8) & (phases["is_pre_holiday"] == 1)).sum() == 0


def test_holidays_of_any_year_are_found(spark):
    df = spark.createDataFrame([(dt.date(2050, 12, 25),), (dt.date(1901, 12, 24),), (None,)], "date date")
    got = {str(r.date): r.holiday_flag for r in holidays.with_holiday_flag(df).collect()}
    assert got == {"2050-12-25": 0, "1901-12-24": 1, "None": -100}


def test_missing_holiday_flag_gives_zero_phases(spark):
    df = spark.createDataFrame([(day(0), None)], "date date, holiday_flag int")
    row = holidays.add_holiday_phases(df).first()
    assert (row["is_pre_holiday"], row["is_holiday_peak"], row["is_post_holiday"]) == (0, 0, 0)


def test_keys_are_padded(spark):
    df = spark.createDataFrame([("Bakery", 7)], "c string, i int")
    assert df.select(sku_key(F.col("c"), F.col("i"))).first()[0] == "Bakery_SKU_007"
