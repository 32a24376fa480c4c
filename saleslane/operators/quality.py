"""Checks and profiles of a rolled-up panel."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REQUIRED = (
    "category", "date", "sales", "instock_rate",
    "promo_intensity", "promo_flag", "final_sku_price", "num_skus",
)


def validate_panel(panel: DataFrame, keys: Sequence[str] = ("category",)) -> DataFrame:
    """One row ``(check, passed, n_bad)`` per check, all counted in one pass.

    Range checks count a missing value as bad.  A missing column fails its checks instead of
    raising, and shows up under ``required_columns``.
    """
    required = list(dict.fromkeys([*keys, *(c for c in REQUIRED if c != "category")]))
    missing = [c for c in required if c not in panel.columns]

    def bad(column: str, cond):
        return F.count(F.lit(1)) if column in missing else F.count_if(cond)

    def outside(column: str, low: float, high: float):
        return ~F.coalesce(F.col(column).between(low, high), F.lit(False))

    checks = {"required_columns": F.lit(len(missing)).cast("bigint")}
    for c in (*keys, "date", "sales"):
        checks[f"{c}_not_null"] = bad(c, F.col(c).isNull())
    checks["sales_not_negative"] = bad("sales", F.col("sales") < 0)
    checks["instock_rate_in_range"] = bad("instock_rate", outside("instock_rate", 0, 100))
    checks["promo_intensity_in_range"] = bad("promo_intensity", outside("promo_intensity", 0, 1))

    counted = panel.agg(*(x.alias(n) for n, x in checks.items()))
    return counted.unpivot([], list(checks), "check", "n_bad").select(
        "check", (F.col("n_bad") == 0).alias("passed"), "n_bad"
    )


def is_valid(report: DataFrame) -> DataFrame:
    return report.agg(F.bool_and("passed").alias("valid"))


def date_continuity(panel: DataFrame, keys: Sequence[str] = ("category",)) -> DataFrame:
    """Calendar days spanned against rows present, per series; a warning, not a check."""
    return (
        panel.groupBy(*keys)
        .agg(
            (F.datediff(F.max("date"), F.min("date")) + 1).alias("expected_days"),
            F.count("date").alias("actual_days"),
        )
        .withColumn("complete", F.col("expected_days") == F.col("actual_days"))
    )


def null_profile(df: DataFrame) -> DataFrame:
    """Columns that contain NULLs with their counts, counted in one pass."""
    counted = df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in df.columns))
    return counted.unpivot([], df.columns, "column_name", "n_null").where("n_null > 0")


def duplicate_keys(df: DataFrame, keys: Sequence[str] = ("category",)) -> DataFrame:
    """Series and dates that more than one row stands for, with the number of rows."""
    counted = df.groupBy(*keys, "date").agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.where("n_rows > 1")
