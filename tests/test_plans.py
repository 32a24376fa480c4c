"""Shapes of the physical plans that the operators promise."""

import re

import pytest

from saleslane.config import EtsConfig
from saleslane.operators import ets, features, future, gapfill, holidays, metrics, rollup, splits
from tests.helpers import SKU_SCHEMA, day, series, sku_rows


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def count(df, pattern):
    return len(re.findall(pattern, plan(df)))


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """A panel with weather, read back from files so that plans start at a scan."""
    path = str(tmp_path_factory.mktemp("plans") / "panel")
    rows = [
        ("A", day(i), float(i + 1), 0.1, int(i % 5 == 0), -100, 50.0, 0.0, 0.0) for i in range(40)
    ]
    schema = (
        "category string, date date, sales double, promo_intensity double, promo_flag int,"
        " holiday_flag int, avg_temperature double, avg_rainfall double, avg_snowfall double"
    )
    spark.createDataFrame(rows, schema).write.parquet(path)
    return spark.read.parquet(path)


def test_gap_filling_shuffles_once_and_sorts_twice(spark):
    filled = gapfill.fill_low_stock(spark.createDataFrame(sku_rows("a", [90.0, 1.0]), SKU_SCHEMA))
    assert count(filled, "Exchange hash") == 1 and count(filled, r" Sort \[") == 2


def test_all_features_share_one_shuffle_and_one_sort(stored):
    wide = features.engineer_features(stored)
    assert count(wide, "Exchange hash") == 1 and count(wide, r" Sort \[") == 1


def test_roll_up_combines_before_the_shuffle(spark):
    rolled = rollup.rollup(spark.createDataFrame(sku_rows("a", [90.0]), SKU_SCHEMA))
    assert "partial_sum" in plan(rolled) and count(rolled, "Exchange hash") == 1


def test_tails_are_cut_before_the_shuffle(stored):
    assert re.search(r"Exchange hash[\s\S]*WindowGroupLimit", plan(splits.tail_per_series(stored, 5)))


def test_only_tables_of_dates_are_broadcast_without_measured_sizes(spark, stored):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        exog = stored.select("category", "date", "avg_temperature", "holiday_flag")
        assert count(rollup.join_exog(stored.select("category", "date"), exog), "BroadcastExchange") == 0
        assert count(future.future_frame(stored), "BroadcastExchange") == 0
        assert count(holidays.with_holiday_flag(stored.drop("holiday_flag")), "BroadcastExchange") == 0
        assert count(splits.date_split(stored, 5, 5, 5), "BroadcastExchange") >= 1
    finally:
        spark.conf.set(key, before)


def test_no_plan_compares_all_rows_with_all_rows(spark, stored):
    state = ets.ets_fit(stored, spec=EtsConfig(alpha=0.1, beta=0.1, gamma=0.1))
    frames = [
        future.future_frame(stored), ets.ets_forecast(state), splits.expanding_folds(stored, 2, 10, 5),
        holidays.with_holiday_flag(series(spark, [1])),
        metrics.metrics_with_total(stored.selectExpr("*", "sales + 1 AS final_forecast")),
    ]
    assert not any(count(f, "CartesianProduct|NestedLoop") for f in frames)
