"""Calendar expressions of a date column."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from saleslane.functions.exprs import flag

# Length of each cycle in its own unit.
CYCLES = {"day_of_week": 7.0, "week_of_year": 52.0, "month": 12.0, "day_of_year": 365.25}

# Holidays on the same month and day of every year.
FIXED_HOLIDAYS = {"new_year": (1, 1), "independence_day": (7, 4), "christmas": (12, 25)}


def temporal_columns(d: Column) -> dict[str, Column]:
    """The 14 calendar features: six plain ones and a sine and cosine per cycle."""
    plain = {
        "day_of_week": F.weekday(d),
        "week_of_year": F.weekofyear(d),
        "month": F.month(d),
        "day_of_year": F.dayofyear(d),
        "week_of_month": F.floor((F.dayofmonth(d) - 1) / 7).cast("int") + 1,
        "is_weekend": flag(F.weekday(d) >= 5),
    }
    cyclic = {}
    for name, length in CYCLES.items():
        angle = F.lit(2 * math.pi) * plain[name] / F.lit(length)
        cyclic[f"{name}_sin"] = F.sin(angle)
        cyclic[f"{name}_cos"] = F.cos(angle)
    return {**plain, **cyclic}


TEMPORAL = (
    "day_of_week", "week_of_year", "month", "day_of_year", "week_of_month", "is_weekend",
    *(f"{cycle}_{wave}" for cycle in CYCLES for wave in ("sin", "cos")),
)


def fourth_thursday(year: Column) -> Column:
    """Thanksgiving: the fourth Thursday of November."""
    november = F.make_date(year, F.lit(11), F.lit(1))
    return F.date_add(F.next_day(F.date_sub(november, 1), "THU"), 21)


def holiday_phase_columns(holiday_flag: Column, pre: int, post: int) -> dict[str, Column]:
    return {
        "is_pre_holiday": flag(holiday_flag.between(1, pre)),
        "is_holiday_peak": flag(holiday_flag == 0),
        "is_post_holiday": flag(holiday_flag.between(-post, -1)),
    }


def days_between(end: Column, start: Column) -> Column:
    return F.datediff(end, start)


def sku_key(category: Column, number: Column) -> Column:
    """Key such as ``Bakery_SKU_007``."""
    return F.format_string("%s_SKU_%03d", category, number)
