import datetime as dt

from saleslane.operators import quality, rollup
from saleslane.operators.gapfill import fill_low_stock
from tests.helpers import SKU_SCHEMA, day, ordered, series, sku_rows


def frame(spark, rows):
    return spark.createDataFrame(rows, SKU_SCHEMA)


def test_weighted_means_and_promo_share(spark):
    rows = sku_rows("a", [90.0], [30.0], promo=[1], price=[2.0])
    rows += sku_rows("b", [70.0], [10.0], promo=[0], price=[6.0])
    r = rollup.rollup(frame(spark, rows)).first()
    assert (r["sales"], r["instock_rate"], r["final_sku_price"]) == (40.0, 85.0, 3.0)
    assert (r["promo_intensity"], r["promo_flag"], r["num_skus"]) == (0.75, 1, 2)
    assert (r["high_impact_promo"], r["pct_skus_on_high_impact_promo"]) == (1, 0.5)


def test_day_without_sales_uses_plain_means(spark):
    rows = sku_rows("a", [90.0], [0.0], price=[2.0]) + sku_rows("b", [70.0], [0.0], price=[4.0])
    r = rollup.rollup(frame(spark, [*rows])).first()
    assert (r["sales"], r["instock_rate"], r["final_sku_price"]) == (0.0, 80.0, 3.0)
    assert (r["promo_intensity"], r["promo_flag"]) == (0.0, 0)


def test_unfilled_sku_hides_the_means_but_not_the_sum(spark):
    rows = sku_rows("good", [90.0] * 2, [5.0, 7.0]) + sku_rows("bad", [1.0] * 2)
    got = ordered(rollup.rollup(fill_low_stock(frame(spark, rows))))
    assert got["sales"].tolist() == [5.0, 7.0]
    assert got["instock_rate"].isna().all() and got["final_sku_price"].isna().all()


def test_rows_without_keys_are_dropped(spark):
    rows = sku_rows("a", [90.0]) + [(day(0), "x", None, 1.0, 90.0, 0, 1.0), (None, "x", "A", 1.0, 90.0, 0, 1.0)]
    assert rollup.rollup(frame(spark, rows)).count() == 1


def test_exog_join_keeps_unmatched_days(spark):
    panel = series(spark, [1, 2, 3])
    exog = spark.createDataFrame(
        [("A", day(1), 50.0, 0.0, 0.0, -100)],
        "category string, date date, avg_temperature double, avg_rainfall double,"
        " avg_snowfall double, holiday_flag int",
    )
    got = ordered(rollup.join_exog(panel, exog))
    assert got["avg_temperature"].isna().tolist() == [True, False, True]


def test_profiles(spark):
    rows = sku_rows("a", [90.0, 50.0], [2.0, 4.0]) + sku_rows("b", [90.0], [9.0], category="B")
    df = frame(spark, rows)
    p = rollup.input_profile(df).first()
    assert (p["n_rows"], p["n_categories"], p["n_skus"], p["last_date"]) == (3, 2, 2, day(1))
    assert rollup.mean_of_sku_means(df).first()[0] == 6.0
    assert abs(rollup.event_shares(df).first()["low_stock_rate"] - 1 / 3) < 1e-12


def test_validation_reports_every_check(spark):
    panel = rollup.rollup(frame(spark, sku_rows("a", [90.0, 80.0])))
    report = {r["check"]: r for r in quality.validate_panel(panel).collect()}
    assert all(r["passed"] for r in report.values()) and len(report) == 7
    assert quality.is_valid(quality.validate_panel(panel)).first()["valid"]

    broken = panel.selectExpr("category", "date", "-sales AS sales", "null AS instock_rate",
                              "2.0 AS promo_intensity", "promo_flag", "num_skus")
    report = {r["check"]: (r["passed"], r["n_bad"]) for r in quality.validate_panel(broken).collect()}
    assert report["required_columns"] == (False, 1)
    assert report["sales_not_negative"] == (False, 2)
    assert report["instock_rate_in_range"] == (False, 2)
    assert report["promo_intensity_in_range"] == (False, 2)
    without = quality.validate_panel(panel.drop("promo_intensity")).collect()
    assert {r["check"]: r["passed"] for r in without}["promo_intensity_in_range"] is False


def test_continuity_and_null_profile(spark):
    df = series(spark, [1, None, 3, 4]).where(f"date <> date'{day(2)}'")
    row = quality.date_continuity(df).first()
    assert (row["expected_days"], row["actual_days"], row["complete"]) == (4, 3, False)
    assert [tuple(r) for r in quality.null_profile(df).collect()] == [("sales", 1)]
    assert isinstance(day(0), dt.date)
