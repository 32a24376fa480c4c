"""Holiday calendar and the signed distance to the nearest holiday."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saleslane.functions.dates import FIXED_HOLIDAYS, fourth_thursday, holiday_phase_columns

NO_HOLIDAY = -100


def year_range(spark: SparkSession, first_year: int, last_year: int) -> DataFrame:
    return spark.range(first_year, last_year + 1).select(F.col("id").cast("int").alias("year"))


def holiday_calendar(years: DataFrame) -> DataFrame:
    """Rows ``(holiday_date, name, list_order)`` for every row of ``years(year)``."""
    fixed = [
        F.struct(
            F.make_date("year", F.lit(month), F.lit(day)).alias("holiday_date"),
            F.lit(name).alias("name"),
            (F.col("year") * 10 + rank).alias("list_order"),
        )
        for rank, (name, (month, day)) in enumerate(FIXED_HOLIDAYS.items())
    ]
    thanksgiving = F.struct(
        fourth_thursday(F.col("year")).alias("holiday_date"),
        F.lit("thanksgiving").alias("name"),
        # The moving holiday is listed after all fixed ones, which decides ties.
        (F.col("year") * 10 + 100_000).alias("list_order"),
    )
    return years.select(F.inline(F.array(*fixed, thanksgiving)))


def holiday_flags(calendar: DataFrame, before: int = 14, after: int = 5) -> DataFrame:
    """One row ``(date, holiday_flag)`` for every date inside a holiday's window.

    Each holiday is spread over the days within reach of it, so the nearest-holiday lookup is
    an equi-join on the date instead of a comparison of every date with every holiday.  A date
    whose nearest holiday lies outside ``[-after, before]`` gets no row.
    """
    reach = max(before, after)
    spread = calendar.select(
        F.explode(
            F.sequence(F.date_sub("holiday_date", reach), F.date_add("holiday_date", reach))
        ).alias("date"),
        "holiday_date",
        "list_order",
    ).withColumn("distance", F.datediff("holiday_date", "date"))
    nearest = spread.groupBy("date").agg(
        F.min_by("distance", F.struct(F.abs("distance"), "list_order")).alias("holiday_flag")
    )
    return nearest.where(F.col("holiday_flag").between(-after, before))


def holiday_flag(df: DataFrame, calendar: DataFrame, before: int = 14, after: int = 5) -> DataFrame:
    """Add ``holiday_flag``: days to the nearest holiday inside its window, else -100."""
    return (
        df.join(holiday_flags(calendar, before, after), "date", "left")
        .withColumn("holiday_flag", F.coalesce("holiday_flag", F.lit(NO_HOLIDAY)))
    )


def years_of(df: DataFrame) -> DataFrame:
    """The calendar years that the dates span, with one more on each side; one pass, one row a year."""
    span = df.agg(F.min(F.year("date")).alias("low"), F.max(F.year("date")).alias("high"))
    return span.select(F.explode(F.sequence(F.col("low") - 1, F.col("high") + 1)).alias("year"))


def with_holiday_flag(df: DataFrame, before: int = 14, after: int = 5) -> DataFrame:
    """:func:`holiday_flag` for the built-in calendar of the years that occur in ``df``."""
    return holiday_flag(df, holiday_calendar(years_of(df)), before, after)


def add_holiday_phases(df: DataFrame, pre: int = 7, post: int = 5) -> DataFrame:
    return df.withColumns(holiday_phase_columns(F.col("holiday_flag"), pre, post))
