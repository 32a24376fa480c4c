"""Schemas of the input panels."""

from pyspark.sql import types as T

SKU_DAY = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("sku_id", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("sales", T.DoubleType()),
        T.StructField("instock_rate", T.DoubleType()),
        T.StructField("high_impact_promo", T.IntegerType()),
        T.StructField("final_sku_price", T.DoubleType()),
    ]
)

EXOG = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("category", T.StringType()),
        T.StructField("avg_temperature", T.DoubleType()),
        T.StructField("avg_rainfall", T.DoubleType()),
        T.StructField("avg_snowfall", T.DoubleType()),
        T.StructField("holiday_flag", T.IntegerType()),
    ]
)

PROMO_PLAN = T.StructType(
    [
        T.StructField("category", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField("promo_intensity", T.DoubleType()),
        T.StructField("promo_flag", T.IntegerType()),
    ]
)

WEATHER_PLAN = T.StructType(
    [
        T.StructField("category", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField("avg_temperature", T.DoubleType()),
        T.StructField("avg_rainfall", T.DoubleType()),
        T.StructField("avg_snowfall", T.DoubleType()),
    ]
)
