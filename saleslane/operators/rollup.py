"""Roll-up of SKU-day rows to one row per series and day, and panel profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleslane.functions.exprs import flag, ratio_or_zero, total, weighted_avg

EXOG_COLUMNS = ("avg_temperature", "avg_rainfall", "avg_snowfall", "holiday_flag")


def rollup(
    sku_day: DataFrame, keys: Sequence[str] = ("category",), promo_threshold: float = 0.2
) -> DataFrame:
    """Sum sales, weight rates and prices by sales and derive the promotion measures.

    Rows without a key are dropped.  All aggregates have partial forms, so a category that
    holds a large share of the rows arrives at the shuffle as one row per day and map task.
    """
    sales, promo = F.col("sales"), F.col("high_impact_promo")
    keyed = sku_day.dropna(subset=[*keys, "date"])
    return (
        keyed.groupBy(*keys, "date")
        .agg(
            total(sales).alias("sales"),
            weighted_avg(F.col("instock_rate"), sales).alias("instock_rate"),
            F.coalesce(F.sum(promo), F.lit(0)).alias("high_impact_promo"),
            weighted_avg(F.col("final_sku_price"), sales).alias("final_sku_price"),
            F.count("sku_id").alias("num_skus"),
            total(sales * promo).alias("_promo_sales"),
        )
        .withColumn("promo_intensity", ratio_or_zero(F.col("_promo_sales"), sales))
        .withColumn("promo_flag", flag(F.col("promo_intensity") > promo_threshold))
        .withColumn(
            "pct_skus_on_high_impact_promo",
            ratio_or_zero(promo.cast("double"), F.col("num_skus")),
        )
        .drop("_promo_sales")
    )


def join_exog(panel: DataFrame, exog: DataFrame, keys: Sequence[str] = ("category",)) -> DataFrame:
    """Left join of the weather and holiday columns on the series and day.

    The exogenous table grows with the number of series, so no broadcast is forced: adaptive
    execution broadcasts it where its measured size allows and merges sorted sides otherwise.
    """
    wanted = [c for c in EXOG_COLUMNS if c in exog.columns]
    return panel.join(exog.select(*keys, "date", *wanted), [*keys, "date"], "left")


def panel_profile(panel: DataFrame, keys: Sequence[str] = ("category",)) -> DataFrame:
    measures = {
        "sales_mean": F.avg("sales"),
        "sales_std": F.stddev_samp("sales"),
        "sales_min": F.min("sales"),
        "sales_max": F.max("sales"),
        "instock_rate_mean": F.avg("instock_rate"),
        "promo_intensity_mean": F.avg("promo_intensity"),
        "pct_skus_on_high_impact_promo_mean": F.avg("pct_skus_on_high_impact_promo"),
        "num_skus_mean": F.avg("num_skus"),
    }
    return panel.groupBy(*keys).agg(*(F.bround(x, 2).alias(n) for n, x in measures.items()))


def input_profile(sku_day: DataFrame) -> DataFrame:
    """Rows, date range and distinct keys.

    Counting two distinct keys in one aggregation would copy every row once per key; the keys
    are de-duplicated by one grouped pass first, and only its output is expanded.
    """
    per_pair = sku_day.groupBy("category", "sku_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("date").alias("lo"), F.max("date").alias("hi")
    )
    return per_pair.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.min("lo").alias("first_date"),
        F.max("hi").alias("last_date"),
        F.countDistinct("category").alias("n_categories"),
        F.countDistinct("sku_id").alias("n_skus"),
    )


def mean_of_sku_means(sku_day: DataFrame, col: str = "sales") -> DataFrame:
    return (
        sku_day.dropna(subset=["sku_id"])
        .groupBy("sku_id")
        .agg(F.avg(col).alias("m"))
        .agg(F.avg("m").alias(f"mean_of_sku_mean_{col}"))
    )


def event_shares(sku_day: DataFrame, threshold: float = 60.0) -> DataFrame:
    return sku_day.agg(
        F.avg("high_impact_promo").alias("promo_rate"),
        F.avg("instock_rate").alias("mean_instock_rate"),
        F.avg(flag(F.col("instock_rate") < threshold)).alias("low_stock_rate"),
    )


def weather_shares(exog: DataFrame) -> DataFrame:
    return exog.agg(
        F.avg("avg_temperature").alias("mean_temperature"),
        F.avg(flag(F.col("avg_rainfall") > 0)).alias("rainy_share"),
        F.avg(flag(F.col("avg_snowfall") > 0)).alias("snowy_share"),
        F.avg(flag(F.col("holiday_flag") != -100)).alias("holiday_share"),
    )
