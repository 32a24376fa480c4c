"""Sales panels derived from the order-line table.

A return flag is a category and a flag with a line number is a SKU, so the panels have one
row per SKU and ship day.  Both derivations are one grouped aggregation; its partial sums are
taken map-side, so a flag or a day that holds a large share of the lines does no harm.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saleslane.functions.exprs import flag
from saleslane.operators.holidays import with_holiday_flag


# Fixed value: prices are taken net of a sales tax of 7.23 percent.
SALES_TAX = 1.0723


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet")


def sku_day_panel(lines: DataFrame) -> DataFrame:
    tax_points = F.rint(F.col("l_tax") * 100).cast("bigint")
    revenue = F.col("l_extendedprice") * (1 - F.col("l_discount")) / SALES_TAX
    # The key is built after grouping by its parts, once per group instead of once per line.
    sku_id = F.concat_ws("_", "category", F.col("l_linenumber").cast("string"))
    return (
        lines.groupBy(
            F.to_date("l_shipdate").alias("date"),
            F.col("l_returnflag").alias("category"),
            "l_linenumber",
        )
        .agg(
            F.sum("l_quantity").alias("sales"),
            (100.0 - 6.0 * F.sum(tax_points).cast("double") / F.count(F.lit(1))).alias(
                "instock_rate"
            ),
            F.max(flag(F.col("l_discount") >= 0.095)).alias("high_impact_promo"),
            F.try_divide(F.sum(revenue), F.sum("l_quantity")).alias("final_sku_price"),
        )
        .select(
            "date", sku_id.alias("sku_id"), "category", "sales", "instock_rate",
            "high_impact_promo", "final_sku_price",
        )
    )


def exog_panel(lines: DataFrame) -> DataFrame:
    """Category-day weather that follows the seasons, with the holiday flag."""
    day_of_year = F.dayofyear("date")
    season = 60.0 + 30.0 * F.sin(2 * math.pi * (day_of_year - 100) / 365.25)
    weather = (
        lines.groupBy(F.to_date("l_shipdate").alias("date"), F.col("l_returnflag").alias("category"))
        .agg(F.sum("l_partkey").alias("k"))
        .withColumn("season", season)
        .select(
            "date",
            "category",
            F.least(
                F.lit(100.0),
                F.greatest(F.lit(20.0), F.round("season", 1) + (F.col("k") % 21) - 10),
            ).alias("avg_temperature"),
            F.when(F.col("k") % 5 == 0, (F.col("k") % 97).cast("double") / 100.0)
            .otherwise(0.0)
            .alias("avg_rainfall"),
            F.when(
                (F.col("season") < 35.0) & (F.col("k") % 7 == 0),
                (F.col("k") % 31).cast("double") / 20.0,
            )
            .otherwise(0.0)
            .alias("avg_snowfall"),
        )
    )
    return with_holiday_flag(weather)
