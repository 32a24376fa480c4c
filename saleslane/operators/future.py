"""Feature rows for the days after the history, for all series at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleslane.config import FeatureConfig
from saleslane.functions.dates import temporal_columns
from saleslane.functions.exprs import series_window, up_to_now
from saleslane.operators.features import extreme_flags, quantile_columns, weather_quantiles
from saleslane.operators.holidays import NO_HOLIDAY, add_holiday_phases
from saleslane.operators.spine import future_spine
from saleslane.operators.splits import last_state, tail_per_series

KEYS = ("category",)
WEATHER = ("avg_temperature", "avg_rainfall", "avg_snowfall")

# Assumptions about the future.
ASSUMED_INSTOCK = 95.0
ASSUMED_NUM_SKUS = 10.0

LAST_DAY = 366
_SUM = "decimal(30,12)"


def recent_values(history: DataFrame, n: int, cols: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Per series a map from the position before the end (1 = last row) to its values.

    At most ``n`` rows of a series are kept, and they are picked before the shuffle.
    """
    recent = tail_per_series(history.select(*keys, "date", *cols), n, keys)
    place = F.row_number().over(series_window(keys, descending=True))
    entry = F.struct(place.alias("place"), F.struct(*cols).alias("values"))
    return (
        recent.select(*keys, entry.alias("entry"))
        .groupBy(*keys)
        .agg(F.map_from_entries(F.collect_list("entry")).alias("recent"))
    )


def future_lags(
    history: DataFrame,
    horizon: int,
    lags: Sequence[int] = (7, 14, 28),
    promo_lag: int = 7,
    keys: Sequence[str] = KEYS,
) -> DataFrame:
    """Lagged sales and promotion intensity of every future step.

    A sales lag that would reach past the history repeats the last actual; a promotion lag is
    NULL there.  Both are NULL where the history is too short.
    """
    cols = [c for c in ("sales", "promo_intensity") if c in history.columns]
    recent = recent_values(history, max(*lags, promo_lag), cols, keys)
    rows = future_spine(history, horizon, keys).join(recent, list(keys), "left")
    return rows.withColumns(lag_columns(F.col("step"), lags, promo_lag, cols)).drop("recent")


def lag_columns(
    step: Column, lags: Sequence[int], promo_lag: int, cols: Sequence[str]
) -> dict[str, Column]:
    """Lags of a step out of its series' ``recent`` map."""

    def value(place: Column, col: str) -> Column:
        return F.try_element_at("recent", place)[col]

    out = {f"lag_{k}": value(F.greatest(k + 1 - step, F.lit(1)), "sales") for k in lags}
    if "promo_intensity" in cols:
        place = promo_lag + 1 - step
        out[f"promo_lag_{promo_lag}"] = F.when(place >= 1, value(place, "promo_intensity"))
    return out


def climate_by_day(history: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Per series ``climate``, the running weather sums and counts up to each day of the year 0..366.

    Rows are reduced to sums per day of the year, at most 366 per series whatever the history
    holds, and these to one array, so the sum over any window is the difference of two entries.
    Running sums are decimals of twelve places: a difference is exact, and a dry window is 0.
    """
    sums = {f"s_{c}": F.coalesce(F.sum(c), F.lit(0.0)).cast(_SUM) for c in WEATHER}
    counts = {f"n_{c}": F.count(c) for c in WEATHER} | {"n_rows": F.count(F.lit(1))}
    by_day = history.groupBy(*keys, F.dayofyear("date").alias("doy")).agg(
        *(x.alias(n) for n, x in (sums | counts).items())
    )
    w = series_window(keys, "doy")
    so_far = [F.sum(c).over(up_to_now(w)).cast(_SUM if c in sums else "bigint").alias(c) for c in sums | counts]
    days_held = F.lead("doy", 1, LAST_DAY + 1).over(w) - F.col("doy")
    none = F.struct(*(F.lit(0).cast(_SUM if c in sums else "bigint").alias(c) for c in sums | counts))
    running = by_day.select(*keys, F.struct("doy", days_held.alias("days"), F.struct(*so_far).alias("sums")).alias("entry"))
    entries = F.sort_array(F.collect_list("entry"))
    held = F.flatten(F.transform("entries", lambda e: F.array_repeat(e["sums"], e["days"])))
    out = running.groupBy(*keys).agg(entries.alias("entries")).select(
        *keys, F.concat(F.array_repeat(none, F.col("entries")[0]["doy"]), held).alias("climate")
    )
    whole_year = F.get("climate", F.lit(LAST_DAY))
    mean = F.try_divide(whole_year["s_avg_temperature"].cast("double"), whole_year["n_avg_temperature"])
    return out.withColumn("mean_temp", mean)


def _near_weather(date: Column, reach: int, wrap: bool) -> dict[str, Column]:
    """Weather around the day of the year of ``date`` from two entries of ``climate``.

    A window that wraps over the year's end takes the entries of its second part as well.
    """
    if wrap and 2 * reach >= LAST_DAY:
        raise ValueError(f"a window of {reach} days on either side meets itself")
    doy = F.dayofyear(date)

    def part(first: Column, last: Column):
        upto, before = F.get("climate", last), F.get("climate", first - 1)
        return lambda name: upto[name] - before[name]

    year = F.lit(LAST_DAY)
    inside = part(F.greatest(doy - reach, F.lit(1)), F.least(doy + reach, year))
    early = part(LAST_DAY + doy - reach, year)
    late = part(F.lit(1), doy + reach - LAST_DAY)

    def pooled(name: str) -> Column:
        if not wrap:
            return inside(name)
        return F.when(doy <= reach, inside(name) + early(name)).when(doy + reach > year, inside(name) + late(name)).otherwise(inside(name))

    otherwise = dict.fromkeys(WEATHER, F.lit(0.0)) | {"avg_temperature": F.col("mean_temp")}
    means = {c: F.try_divide(pooled(f"s_{c}").cast("double"), pooled(f"n_{c}")) for c in WEATHER}
    return {c: F.when(pooled("n_rows") > 0, means[c]).otherwise(otherwise[c]) for c in WEATHER}


def climatology(
    history: DataFrame,
    future: DataFrame,
    keys: Sequence[str] = KEYS,
    reach: int = 7,
    wrap: bool = False,
) -> DataFrame:
    """Mean weather of the history's days within ``reach`` days of the year, per future row.

    Each future row takes the difference of two entries of its series' running sums, so there is
    one join on the series and no comparison of rows with rows.  Without a neighbour the
    temperature is the history's mean and the rest is 0.  Windows stop at the year's ends
    unless ``wrap`` is set.
    """
    rows = future.join(climate_by_day(history, keys), list(keys), "left")
    return rows.withColumns(_near_weather(F.col("date"), reach, wrap)).drop("climate", "mean_temp")


def _planned(
    rows: DataFrame, plan: DataFrame, cols: Sequence[str], keys: Sequence[str]
) -> DataFrame:
    """Join a plan by series and day; ``_has_plan`` tells whether the series has any row."""
    covered = plan.select(*keys).distinct().withColumn("_has_plan", F.lit(True))
    return rows.join(covered, list(keys), "left").join(
        plan.select(*keys, "date", *(F.col(c).alias(f"_plan_{c}") for c in cols)),
        [*keys, "date"],
        "left",
    )


def future_promo_plan(
    future: DataFrame, plan: DataFrame | None = None, keys: Sequence[str] = KEYS
) -> DataFrame:
    """``promo_intensity`` and ``promo_flag`` from a plan, 0 for series without one."""
    none = {"promo_intensity": F.lit(0.0), "promo_flag": F.lit(0)}
    if plan is None:
        return future.withColumns(none)
    planned = _planned(future, plan, list(none), keys)
    return planned.withColumns(
        {c: F.when(F.col("_has_plan"), F.col(f"_plan_{c}")).otherwise(v) for c, v in none.items()}
    ).drop("_has_plan", *(f"_plan_{c}" for c in none))


def future_weather(
    history: DataFrame,
    future: DataFrame,
    forecast: DataFrame | None = None,
    keys: Sequence[str] = KEYS,
    config: FeatureConfig = FeatureConfig(),
    wrap: bool = False,
) -> DataFrame:
    """Weather features of future rows ``(keys, step, date)``.

    Weather comes from a forecast for the series that have one and from the climatology of
    the history otherwise.  The temperature norm runs over the future rows only and accepts
    partial windows; the extreme flags compare with the history's quantiles.
    """
    rows = climatology(history, future, keys, wrap=wrap)
    quantiles = weather_quantiles(
        history, keys, config.cold_quantile, config.hot_quantile, config.wet_quantile
    )
    rows = _forecast_weather(rows, forecast, keys).join(quantiles, list(keys), "left")
    return _derived_weather(rows, keys, config)


def _forecast_weather(
    rows: DataFrame, forecast: DataFrame | None, keys: Sequence[str]
) -> DataFrame:
    if forecast is None:
        return rows
    planned = _planned(rows, forecast, WEATHER, keys)
    return planned.withColumns(
        {c: F.when(F.col("_has_plan"), F.col(f"_plan_{c}")).otherwise(F.col(c)) for c in WEATHER}
    ).drop("_has_plan", *(f"_plan_{c}" for c in WEATHER))


def _derived_weather(rows: DataFrame, keys: Sequence[str], config: FeatureConfig) -> DataFrame:
    """Norm, deviation, precipitation and extremes of rows that carry their quantiles."""
    n = config.temp_norm_window
    norm = f"temp_rolling_avg_{n}"
    temp, rain = F.col("avg_temperature"), F.col("avg_rainfall") + F.col("avg_snowfall")
    frame = series_window(keys).rowsBetween(1 - n, 0)
    return (
        rows.withColumn(norm, F.avg(temp).over(frame))
        .withColumns(
            {
                "temp_deviation": temp - F.col(norm),
                "total_precipitation": rain,
                **extreme_flags(temp, rain),
            }
        )
        .drop("temp_cold", "temp_hot", "precip_heavy")
    )


def future_frame(
    history: DataFrame,
    horizon: int = 30,
    keys: Sequence[str] = KEYS,
    promo_plan: DataFrame | None = None,
    weather: DataFrame | None = None,
    config: FeatureConfig = FeatureConfig(),
    wrap: bool = False,
) -> DataFrame:
    """All feature columns for steps ``1..horizon`` of every series.

    Three aggregations reduce the history to one row per series each: its last state with the
    quantiles, its recent values, and its climate.  They are joined on the series, the values
    of all steps are looked up there, and only these are spread out: neither the recent values nor
    the climate is carried by the exploded rows or into the joins with the plans.
    """
    keys = list(keys)
    rolling = [f"rolling_mean_{n}" for n in config.rolling_windows]
    frozen = [*rolling, "days_since_promo", "num_skus", "ets_level", "final_sku_price"]
    kept = [c for c in frozen if c in history.columns]
    has_weather = set(WEATHER) <= set(history.columns)

    extra = (
        quantile_columns(config.cold_quantile, config.hot_quantile, config.wet_quantile)
        if has_weather
        else {}
    )
    cols = [c for c in ("sales", "promo_intensity") if c in history.columns]
    depth = max(*config.lags, config.promo_lag)
    rows = last_state(history, kept, keys, extra)
    rows = rows.join(recent_values(history, depth, cols, keys), keys, "left")
    if has_weather:
        rows = rows.join(climate_by_day(history, keys), keys, "left")

    def day(step: Column) -> Column:
        date = F.date_add("last_date", step)
        found = lag_columns(step, config.lags, config.promo_lag, cols)
        if has_weather:
            found |= _near_weather(date, 7, wrap)
        return F.struct(step.alias("step"), date.alias("date"), *(c.alias(n) for n, c in found.items()))

    days = F.transform(F.sequence(F.lit(1), F.lit(horizon)), day)
    rows = rows.withColumn("_days", days).drop("recent", "climate", "mean_temp")
    rows = rows.select(*(c for c in rows.columns if c != "_days"), F.inline("_days"))
    rows = rows.withColumns({c: F.col(f"last_{c}") for c in kept})
    if "days_since_promo" in kept:
        rows = rows.withColumn("days_since_promo", F.col("days_since_promo") + F.col("step"))
    if "num_skus" not in kept:
        rows = rows.withColumn("num_skus", F.lit(ASSUMED_NUM_SKUS))
    rows = rows.drop("n_rows", "last_date", *(f"last_{c}" for c in kept))

    rows = future_promo_plan(rows, promo_plan, keys)
    rows = rows.withColumns(
        {
            **temporal_columns(F.col("date")),
            "pct_skus_on_high_impact_promo": F.lit(0.0),
            "high_impact_promo": F.lit(0.0),
            "instock_rate": F.lit(ASSUMED_INSTOCK),
            "holiday_flag": F.lit(NO_HOLIDAY),
        }
    )
    rows = add_holiday_phases(rows, config.holiday_pre, config.holiday_post)
    if has_weather:
        rows = _derived_weather(_forecast_weather(rows, weather, keys), keys, config)
    return rows
