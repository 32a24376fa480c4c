"""DuckDB SQL with the same results as the queries, written without sharing their plans."""

from __future__ import annotations

from saleslane.config import EtsConfig
from saleslane.plans.queries import FIXED, HORIZON, SMALL_GRID

# Common table expressions by name: those they read, and their text.
_CTE: dict[str, tuple[str, str]] = {}


def _r(columns: str) -> str:
    """Rounded columns; adding 0 turns a negative zero into zero."""
    return ", ".join(f"round({c}, 6) + 0e0 AS {c}" for c in columns.split())


def _with(names: str, final: str) -> str:
    ordered: list[str] = []

    def visit(name: str):
        for needed in _CTE[name][0].split():
            visit(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names.split():
        visit(name)
    recursive = "RECURSIVE " if any("UNION ALL" in _CTE[n][1] for n in ordered) else ""
    body = ",\n".join(f"{n} AS ({_CTE[n][1]})" for n in ordered)
    return f"WITH {recursive}{body}\n{final}"


# ---------------------------------------------------------------------------------------
# Panels

_CTE["sku_day"] = ("", """
    SELECT CAST(l_shipdate AS DATE) AS date,
           concat(l_returnflag, '_', CAST(l_linenumber AS VARCHAR)) AS sku_id,
           l_returnflag AS category,
           SUM(l_quantity) AS sales,
           100e0 - 6e0 * CAST(SUM(CAST(ROUND(l_tax * 100) AS BIGINT)) AS DOUBLE) / COUNT(*)
               AS instock_rate,
           MAX(CASE WHEN l_discount >= 0.095e0 THEN 1 ELSE 0 END) AS high_impact_promo,
           SUM(l_extendedprice * (1 - l_discount) / 1.0723e0) / SUM(l_quantity) AS final_sku_price
    FROM lineitem GROUP BY 1, 2, 3""")

_CTE["weather"] = ("", """
    SELECT date, category,
           LEAST(100e0, GREATEST(20e0, ROUND(st, 1) + (k % 21) - 10)) AS avg_temperature,
           CASE WHEN k % 5 = 0 THEN CAST(k % 97 AS DOUBLE) / 100e0 ELSE 0e0 END AS avg_rainfall,
           CASE WHEN st < 35e0 AND k % 7 = 0 THEN CAST(k % 31 AS DOUBLE) / 20e0 ELSE 0e0 END
               AS avg_snowfall
    FROM (SELECT CAST(l_shipdate AS DATE) AS date, l_returnflag AS category,
                 CAST(SUM(l_partkey) AS BIGINT) AS k,
                 60e0 + 30e0 * SIN(2 * PI() * (dayofyear(CAST(l_shipdate AS DATE)) - 100) / 365.25e0)
                     AS st
          FROM lineitem GROUP BY 1, 2, 4)""")

_HOLIDAYS = """
    SELECT make_date(y, 1, 1) AS holiday_date, 'new_year' AS name FROM {years}
    UNION SELECT make_date(y, 7, 4), 'independence_day' FROM {years}
    UNION SELECT make_date(y, 12, 25), 'christmas' FROM {years}
    UNION SELECT make_date(y, 11, 1)
                 + CAST((11 - isodow(make_date(y, 11, 1))) % 7 + 21 AS INTEGER), 'thanksgiving'
    FROM {years}"""

_CTE["years"] = ("", "SELECT CAST(unnest(range(1991, 2006)) AS INTEGER) AS y")
_CTE["holidays"] = ("years", _HOLIDAYS.format(years="years"))
_CTE["ship_dates"] = ("", "SELECT DISTINCT CAST(l_shipdate AS DATE) AS date FROM lineitem")
_CTE["flags"] = ("holidays ship_dates", """
    SELECT date, CAST(CASE WHEN dist BETWEEN -5 AND 14 THEN dist ELSE -100 END AS INTEGER)
                     AS holiday_flag
    FROM (SELECT date, holiday_date - date AS dist,
                 row_number() OVER (PARTITION BY date
                                    ORDER BY abs(holiday_date - date), name = 'thanksgiving',
                                             holiday_date) AS rn
          FROM ship_dates CROSS JOIN holidays)
    WHERE rn = 1""")
_CTE["exog"] = ("weather flags", "SELECT w.*, f.holiday_flag FROM weather w JOIN flags f USING (date)")


def _gapfill(threshold: float, limit: int | None) -> tuple[str, str]:
    far = 10**9 if limit is None else limit
    columns = ("sales", "instock_rate", "final_sku_price")

    def value(c: str) -> str:
        return f"""CASE WHEN NOT has_low OR NOT low THEN e.{c}
                        WHEN pp IS NULL THEN CASE WHEN np - e.p <= {far} THEN b.{c} END
                        WHEN np IS NULL THEN a.{c}
                        ELSE a.{c} + (b.{c} - a.{c}) * step / (np - pp) END"""

    filled = ", ".join(f"{value(c)} AS {c}" for c in columns)
    text = f"""
    SELECT date, sku_id, category, sales,
           CASE WHEN instock_rate < {threshold} THEN {threshold}e0 ELSE instock_rate END
               AS instock_rate,
           high_impact_promo, final_sku_price, fill_kind
    FROM (SELECT e.date, e.sku_id, e.category, e.high_impact_promo, {filled},
                 CASE WHEN NOT has_low OR NOT low THEN 'observed'
                      WHEN pp IS NULL AND np IS NULL THEN 'unfilled'
                      WHEN e.p - pp <= {far} OR np - e.p <= {far} THEN 'interpolated'
                      WHEN pp IS NULL THEN 'unfilled' ELSE 'forward_filled' END AS fill_kind
          FROM (SELECT *, CASE WHEN p - pp <= {far} OR np - p <= {far} THEN p - pp
                               ELSE {far} END AS step
                FROM (SELECT *, bool_or(low) OVER (PARTITION BY sku_id) AS has_low,
                             max(CASE WHEN NOT low THEN p END) OVER
                                 (PARTITION BY sku_id ORDER BY p ROWS UNBOUNDED PRECEDING) AS pp,
                             min(CASE WHEN NOT low THEN p END) OVER
                                 (PARTITION BY sku_id ORDER BY p
                                  ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS np
                      FROM (SELECT *, coalesce(instock_rate < {threshold}, false) AS low,
                                   row_number() OVER (PARTITION BY sku_id ORDER BY date) AS p
                            FROM sku_day))) e
          LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY sku_id ORDER BY date) AS p
                     FROM sku_day) a ON a.sku_id = e.sku_id AND a.p = e.pp
          LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY sku_id ORDER BY date) AS p
                     FROM sku_day) b ON b.sku_id = e.sku_id AND b.p = e.np)"""
    return "sku_day", text


_CTE["filled"] = _gapfill(60, 7)
_CTE["filled_limit1"] = _gapfill(60, 1)
_CTE["filled_long"] = _gapfill(80, 2)
_CTE["filled_free"] = _gapfill(80, None)


def _rollup(source: str) -> tuple[str, str]:
    def weighted(c: str) -> str:
        return f"""CASE WHEN SUM(sales) > 0
                        THEN CASE WHEN COUNT({c} + sales) = COUNT(*)
                                  THEN SUM({c} * sales) / SUM(sales) END
                        ELSE AVG({c}) END AS {c}"""

    text = f"""
    SELECT category, date, sales, instock_rate, high_impact_promo, final_sku_price, num_skus,
           promo_intensity,
           CASE WHEN promo_intensity > 0.2e0 THEN 1 ELSE 0 END AS promo_flag,
           CASE WHEN num_skus > 0 THEN CAST(high_impact_promo AS DOUBLE) / num_skus ELSE 0e0 END
               AS pct_skus_on_high_impact_promo
    FROM (SELECT *, CASE WHEN sales > 0 THEN on_promo / sales ELSE 0e0 END AS promo_intensity
          FROM (SELECT category, date, coalesce(SUM(sales), 0e0) AS sales,
                       {weighted("instock_rate")},
                       CAST(SUM(high_impact_promo) AS BIGINT) AS high_impact_promo,
                       {weighted("final_sku_price")},
                       COUNT(sku_id) AS num_skus,
                       coalesce(SUM(sales * high_impact_promo), 0e0) AS on_promo
                FROM {source} GROUP BY category, date))"""
    return source, text


_CTE["panel"] = _rollup("filled")
_CTE["raw_panel"] = _rollup("sku_day")
_CTE["full_panel"] = ("panel exog", """
    SELECT p.*, e.avg_temperature, e.avg_rainfall, e.avg_snowfall, e.holiday_flag
    FROM panel p LEFT JOIN exog e ON e.date = p.date AND e.category = p.category""")

PANEL = (
    "category, date, " + _r("sales instock_rate final_sku_price promo_intensity "
    "pct_skus_on_high_impact_promo") + ", high_impact_promo, num_skus, promo_flag"
)
WEATHER = _r("avg_temperature avg_rainfall avg_snowfall")
SKU_DAY = f"date, sku_id, category, {_r('sales instock_rate final_sku_price')}, high_impact_promo"

# ---------------------------------------------------------------------------------------
# Features


def _temporal(d: str) -> dict[str, str]:
    plain = {
        "day_of_week": f"CAST(isodow({d}) - 1 AS INTEGER)",
        "week_of_year": f"CAST(weekofyear({d}) AS INTEGER)",
        "month": f"CAST(month({d}) AS INTEGER)",
        "day_of_year": f"CAST(dayofyear({d}) AS INTEGER)",
        "week_of_month": f"CAST((day({d}) - 1) // 7 + 1 AS INTEGER)",
        "is_weekend": f"CASE WHEN isodow({d}) >= 6 THEN 1 ELSE 0 END",
    }
    lengths = {"day_of_week": 7, "week_of_year": 52, "month": 12, "day_of_year": 365.25}
    for name, length in lengths.items():
        angle = f"2 * pi() * {plain[name]} / {length}e0"
        plain[f"{name}_sin"] = f"round(sin({angle}), 6) + 0e0"
        plain[f"{name}_cos"] = f"round(cos({angle}), 6) + 0e0"
    return plain


TEMPORAL = ", ".join(f"{x} AS {n}" for n, x in _temporal("date").items())
_W = "OVER (PARTITION BY category ORDER BY date)"


def _frame(n: int) -> str:
    return f"OVER (PARTITION BY category ORDER BY date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def _mean(c: str, n: int) -> str:
    return f"CASE WHEN count({c}) {_frame(n)} = {n} THEN avg({c}) {_frame(n)} END"


LAGS = (
    ", ".join(f"lag(sales, {k}) {_W} AS lag_{k}" for k in (7, 14, 28))
    + f", lag(promo_intensity, 7) {_W} AS promo_lag_7"
)
ROLLING = ", ".join(f"{_mean('sales', n)} AS rolling_mean_{n}" for n in (7, 28))
SINCE = """CAST(coalesce(date - max(CASE WHEN promo_flag = 1 THEN date END) OVER
               (PARTITION BY category ORDER BY date
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 999) AS INTEGER)
           AS days_since_promo"""
PHASES = """CASE WHEN holiday_flag BETWEEN 1 AND 7 THEN 1 ELSE 0 END AS is_pre_holiday,
            CASE WHEN holiday_flag = 0 THEN 1 ELSE 0 END AS is_holiday_peak,
            CASE WHEN holiday_flag BETWEEN -5 AND -1 THEN 1 ELSE 0 END AS is_post_holiday"""

_CTE["quantiles"] = ("exog", """
    SELECT category, quantile_cont(avg_temperature, 0.1) AS temp_cold,
           quantile_cont(avg_temperature, 0.9) AS temp_hot,
           quantile_cont(avg_rainfall + avg_snowfall, 0.9) AS precip_heavy
    FROM exog GROUP BY category""")
EXTREMES = """CASE WHEN avg_temperature < temp_cold THEN 1 ELSE 0 END AS is_extreme_cold,
              CASE WHEN avg_temperature > temp_hot THEN 1 ELSE 0 END AS is_extreme_hot,
              CASE WHEN total_precipitation > precip_heavy THEN 1 ELSE 0 END AS heavy_precip_flag"""
_CTE["weather_feats"] = ("exog quantiles", f"""
    SELECT *, avg_temperature - temp_rolling_avg_14 AS temp_deviation, {EXTREMES}
    FROM (SELECT e.*, avg_rainfall + avg_snowfall AS total_precipitation,
                 {_mean('avg_temperature', 14)} AS temp_rolling_avg_14
          FROM exog e) JOIN quantiles USING (category)""")
_CTE["features"] = ("full_panel weather_feats", f"""
    SELECT f.*, w.temp_rolling_avg_14, w.temp_deviation, w.total_precipitation,
           w.is_extreme_cold, w.is_extreme_hot, w.heavy_precip_flag
    FROM (SELECT *, {TEMPORAL}, {LAGS}, {ROLLING}, {SINCE}, {PHASES} FROM full_panel) f
    LEFT JOIN weather_feats w USING (category, date)""")

_LAG_COLUMNS = "lag_7 lag_14 lag_28 promo_lag_7"
_ROLLING_COLUMNS = "rolling_mean_7 rolling_mean_28"
_WEATHER_COLUMNS = (
    "avg_temperature avg_rainfall avg_snowfall temp_rolling_avg_14 temp_deviation total_precipitation"
)
_EXTREME_NAMES = "is_extreme_cold, is_extreme_hot, heavy_precip_flag"
_PHASE_NAMES = "is_pre_holiday, is_holiday_peak, is_post_holiday"
_TEMPORAL_NAMES = ", ".join(_temporal("date"))
FEATURES = (
    f"{PANEL}, holiday_flag, {_TEMPORAL_NAMES}, {_r(_LAG_COLUMNS)}, {_r(_ROLLING_COLUMNS)}, "
    f"days_since_promo, {_PHASE_NAMES}, {_r(_WEATHER_COLUMNS)}, {_EXTREME_NAMES}"
)

# ---------------------------------------------------------------------------------------
# Splits

_CTE["ranks"] = ("panel", """
    SELECT date, row_number() OVER (ORDER BY date) - 1 AS rnk, count(*) OVER () AS n
    FROM (SELECT DISTINCT date FROM panel)""")
_CTE["last_split"] = ("ranks", """
    SELECT date, CASE WHEN rnk < n - 60 THEN 'train' WHEN rnk < n - 30 THEN 'val' ELSE 'test' END
                     AS split
    FROM ranks""")
_CTE["labelled"] = ("panel last_split", "SELECT p.*, s.split FROM panel p JOIN last_split s USING (date)")


def _filled_forward(c: str) -> str:
    """Forward, then backward, then 0; the rest of the series is searched for the first value."""
    return f"""coalesce(
        last_value({c} IGNORE NULLS) OVER (PARTITION BY category ORDER BY date
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
        first_value({c} IGNORE NULLS) OVER (PARTITION BY category ORDER BY date
            ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0) AS {c}"""


# ---------------------------------------------------------------------------------------
# Smoothing


def _smoothing(name: str, source: str, spec: EtsConfig) -> None:
    """Damped additive trend with multiplicative seasons of seven, one row per step."""
    if spec.is_fixed:
        axes = [[spec.alpha], [spec.beta], [spec.gamma], [spec.fixed_phi]]
    else:
        axes = [spec.grid_alpha, spec.grid_beta, spec.grid_gamma, spec.grid_phi]
    lists = [f"unnest([{', '.join(f'{v}e0' for v in axis)}])" for axis in axes]
    _CTE[f"{name}_y"] = (source, f"""
        SELECT category, date, sales AS y,
               row_number() OVER (PARTITION BY category ORDER BY date) AS t
        FROM {source}""")
    _CTE[f"{name}_grid"] = ("", f"""
        SELECT a, b, g, phi FROM (SELECT {lists[0]} AS a), (SELECT {lists[1]} AS b),
                                 (SELECT {lists[2]} AS g), (SELECT {lists[3]} AS phi)""")
    _CTE[f"{name}_init"] = (f"{name}_y", f"""
        SELECT category, avg(CASE WHEN t <= 7 THEN y END) AS l0,
               (avg(CASE WHEN t > 7 THEN y END) - avg(CASE WHEN t <= 7 THEN y END)) / 7 AS b0,
               list(y ORDER BY t) FILTER (t <= 7) AS ys
        FROM {name}_y WHERE t <= 14 GROUP BY category""")
    _CTE[f"{name}_rec"] = (f"{name}_init {name}_grid", f"""
        SELECT category, a, b, g, phi, CAST(0 AS BIGINT) AS t, l0 AS lvl, b0 AS tr,
               list_transform(ys, lambda v: v / l0) AS s, CAST(NULL AS DOUBLE) AS fitted, 0e0 AS sse
        FROM {name}_init CROSS JOIN {name}_grid
        UNION ALL
        SELECT category, a, b, g, phi, t, l1, b * (l1 - lvl) + (1 - b) * drift,
               list_append(s[2:7], g * (y / base) + (1 - g) * s[1]),
               base * s[1], sse + (y - base * s[1]) * (y - base * s[1])
        FROM (SELECT *, a * (y / s[1]) + (1 - a) * base AS l1
              FROM (SELECT r.category, a, b, g, phi, o.t, lvl, s, sse, o.y, phi * tr AS drift,
                           lvl + phi * tr AS base
                    FROM {name}_rec r JOIN {name}_y o
                      ON o.category = r.category AND o.t = r.t + 1))""")
    _CTE[f"{name}_state"] = (f"{name}_rec", f"""
        SELECT r.category, a AS alpha, b AS beta, g AS gamma, phi, lvl AS level, tr AS trend,
               s AS season, sse, r.t AS n, o.date AS last_date, false AS fallback
        FROM {name}_rec r
        JOIN (SELECT category, max(t) AS t FROM {name}_y GROUP BY category) m
          ON m.category = r.category AND m.t = r.t
        JOIN {name}_y o ON o.category = r.category AND o.t = r.t
        QUALIFY row_number() OVER (PARTITION BY r.category ORDER BY sse, a, b, g, phi) = 1""")
    _CTE[f"{name}_comp"] = (f"{name}_rec {name}_y", f"""
        SELECT r.category, o.date, o.y AS actual, r.fitted AS ets_fitted,
               o.y - r.fitted AS ets_residual, r.lvl AS ets_level
        FROM {name}_rec r JOIN {name}_y o ON o.category = r.category AND o.t = r.t""")
    _CTE[f"{name}_fc"] = (f"{name}_state", f"""
        SELECT category, CAST(h AS INTEGER) AS step, last_date + CAST(h AS INTEGER) AS date,
               (level + trend * phi * (1 - pow(phi, h)) / (1 - phi)) * season[(h - 1) % 7 + 1]
                   AS ets_forecast
        FROM {name}_state CROSS JOIN (SELECT unnest(range(1, {HORIZON + 1})) AS h)""")


_CTE["history"] = ("labelled", "SELECT * FROM labelled WHERE split IN ('train', 'val')")
_smoothing("fx", "panel", FIXED)
_smoothing("gr", "panel", SMALL_GRID)
_smoothing("hs", "history", FIXED)

STATE = (
    f"category, {_r('alpha beta gamma phi level trend sse')}, n, last_date, fallback, "
    "list_transform(season, lambda v: round(v, 6) + 0e0) AS season"
)
COMPONENTS = f"category, date, {_r('actual ets_fitted ets_residual ets_level')}"

# ---------------------------------------------------------------------------------------
# Future rows

_CTE["spine"] = ("panel", f"""
    SELECT category, CAST(h AS INTEGER) AS step, d + CAST(h AS INTEGER) AS date
    FROM (SELECT category, max(date) AS d FROM panel GROUP BY category)
    CROSS JOIN (SELECT unnest(range(1, {HORIZON + 1})) AS h)""")
_CTE["numbered"] = ("panel", """
    SELECT category, sales, promo_intensity, count(*) OVER (PARTITION BY category) AS n,
           row_number() OVER (PARTITION BY category ORDER BY date) - 1 AS pos
    FROM panel""")


def _future_lags() -> str:
    parts = [
        f"(SELECT sales FROM numbered x WHERE x.category = s.category"
        f" AND x.pos = least(x.n + s.step - 1 - {k}, x.n - 1)) AS lag_{k}"
        for k in (7, 14, 28)
    ]
    parts.append(
        "(SELECT promo_intensity FROM numbered x WHERE x.category = s.category"
        " AND x.pos = x.n + s.step - 1 - 7) AS promo_lag_7"
    )
    return ", ".join(parts)


_CTE["flags_lags"] = ("spine numbered", f"SELECT s.*, {_future_lags()} FROM spine s")
_CTE["climate"] = ("spine exog", """
    SELECT s.category, s.step, s.date,
           coalesce(avg(e.avg_temperature), any_value(m.t)) AS avg_temperature,
           coalesce(avg(e.avg_rainfall), 0e0) AS avg_rainfall,
           coalesce(avg(e.avg_snowfall), 0e0) AS avg_snowfall
    FROM spine s
    LEFT JOIN exog e ON e.category = s.category
         AND dayofyear(e.date) BETWEEN dayofyear(s.date) - 7 AND dayofyear(s.date) + 7
    LEFT JOIN (SELECT category, avg(avg_temperature) AS t FROM exog GROUP BY category) m
         ON m.category = s.category
    GROUP BY 1, 2, 3""")
_CTE["planned_weather"] = ("spine exog", """
    SELECT s.category, s.step, s.date, e.avg_temperature, e.avg_rainfall, e.avg_snowfall
    FROM spine s LEFT JOIN exog e ON e.category = s.category AND e.date = s.date - 364""")


def _outlook(source: str) -> tuple[str, str]:
    return f"{source} quantiles", f"""
    SELECT *, avg_temperature - temp_rolling_avg_14 AS temp_deviation, {EXTREMES}
    FROM (SELECT *, avg_rainfall + avg_snowfall AS total_precipitation,
                 avg(avg_temperature) OVER (PARTITION BY category ORDER BY date
                     ROWS BETWEEN 13 PRECEDING AND CURRENT ROW) AS temp_rolling_avg_14
          FROM {source}) JOIN quantiles USING (category)"""


_CTE["outlook"] = _outlook("climate")
_CTE["planned_outlook"] = _outlook("planned_weather")
_OUTLOOK = f"category, step, date, {_r(_WEATHER_COLUMNS)}, {_EXTREME_NAMES}"

# ---------------------------------------------------------------------------------------
# Scores

_CTE["backtest"] = ("panel", f"""
    SELECT category, date, sales, ets_forecast, final_forecast - ets_forecast AS residual_forecast,
           final_forecast
    FROM (SELECT category, date, sales, lag(sales, 14) {_W} AS ets_forecast,
                 lag(sales, 7) {_W} AS final_forecast FROM panel)
    WHERE ets_forecast IS NOT NULL""")
_CTE["scored"] = ("backtest", f"""
    SELECT *, sales AS a, final_forecast AS p, abs(sales - lag(sales, 7) {_W}) AS naive
    FROM backtest""")


def _metrics(digits: bool) -> str:
    def out(x: str, places: int) -> str:
        return f"round_even({x}, {places}) + 0e0" if digits else f"round({x}, 6) + 0e0"

    return f"""CAST(count(*) AS BIGINT) AS n_samples,
        {out("avg(CASE WHEN a > 1e-10 THEN abs((a - p) / a) END) * 100", 2)} AS mape,
        {out("avg(abs(a - p))", 2)} AS mae,
        {out("sqrt(avg((a - p) * (a - p)))", 2)} AS rmse,
        {out("avg(abs(a - p)) / avg(naive)", 3)} AS mase,
        {out("(sum(p) - sum(a)) / sum(a) * 100", 2)} AS bias_pct,
        {out("1 - sum((a - p) * (a - p)) / (sum(a * a) - sum(a) * sum(a) / count(*))", 3)} AS r2,
        {out("avg(a)", 2)} AS mean_actual,
        {out("avg(p)", 2)} AS mean_predicted"""


_CTE["by_category"] = ("scored", f"SELECT category, {_metrics(True)} FROM scored GROUP BY category")
_CTE["components"] = ("backtest", """
    SELECT category, round_even(em, 2) + 0e0 AS ets_mae, round_even(ep, 2) + 0e0 AS ets_mape,
           round_even(fm, 2) + 0e0 AS final_mae, round_even(fp, 2) + 0e0 AS final_mape,
           round_even((em - fm) / em * 100, 2) + 0e0 AS mae_improvement_pct,
           round_even((ep - fp) / ep * 100, 2) + 0e0 AS mape_improvement_pct
    FROM (SELECT category, avg(abs(sales - ets_forecast)) AS em,
                 avg(abs((sales - ets_forecast) / sales)) * 100 AS ep,
                 avg(abs(sales - final_forecast)) AS fm,
                 avg(abs((sales - final_forecast) / sales)) * 100 AS fp
          FROM backtest GROUP BY category)""")
_CTE["residuals"] = ("backtest", """
    SELECT category, date, sales AS actual, final_forecast AS predicted,
           sales - final_forecast AS residual,
           CASE WHEN sales <> 0 THEN abs((sales - final_forecast) / sales) * 100 END AS ape
    FROM backtest""")
_CTE["verdict"] = ("by_category", """
    SELECT count(*) AS n_series, avg(mape) AS avg_mape, avg(mase) AS avg_mase,
           avg(mape) < 20 AS mape_met, avg(mase) < 1 AS mase_met,
           avg(mape) < 20 AND avg(mase) < 1 AS targets_met
    FROM by_category""")


def _validation() -> str:
    checks = {
        "category_not_null": "category IS NULL",
        "date_not_null": "date IS NULL",
        "sales_not_null": "sales IS NULL",
        "sales_not_negative": "sales < 0",
        "instock_rate_in_range": "NOT coalesce(instock_rate BETWEEN 0 AND 100, false)",
        "promo_intensity_in_range": "NOT coalesce(promo_intensity BETWEEN 0 AND 1, false)",
    }
    parts = ['SELECT \'required_columns\' AS "check", CAST(0 AS BIGINT) AS n_bad']
    parts += [f"SELECT '{n}', count(*) FILTER ({c}) FROM panel" for n, c in checks.items()]
    return " UNION ".join(parts)


_CTE["checks"] = ("panel", _validation())


def _null_counts() -> str:
    names = ["lag_7", "lag_14", "lag_28", "promo_lag_7", "rolling_mean_7", "rolling_mean_28",
             "temp_rolling_avg_14", "temp_deviation"]
    return " UNION ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS n_null FROM features"
        for c in names
    )


def _fold_sql() -> str:
    return """
    SELECT p.category, p.date, round(p.sales, 6) + 0e0 AS sales, CAST(f AS INTEGER) AS fold,
           CASE WHEN rnk < n - (3 - f) * 30 THEN 'train' ELSE 'val' END AS role
    FROM panel p JOIN ranks USING (date) CROSS JOIN (SELECT unnest([0, 1, 2]) AS f)
    WHERE rnk < n - (2 - f) * 30"""


_MATRIX_GAPS = [
    "final_sku_price", "promo_intensity", "pct_skus_on_high_impact_promo",
    "avg_temperature", "avg_rainfall", "avg_snowfall", "lag_7", "lag_14", "lag_28", "promo_lag_7",
    "rolling_mean_7", "rolling_mean_28", "temp_rolling_avg_14", "temp_deviation",
    "total_precipitation", "ets_level",
]
_CTE["modelled"] = ("features fx_comp", """
    SELECT f.*, c.ets_fitted, c.ets_residual, c.ets_level
    FROM features f LEFT JOIN fx_comp c USING (category, date)""")
_CTE["matrix"] = ("modelled", f"""
    SELECT category, date, promo_flag, holiday_flag, {_TEMPORAL_NAMES}, days_since_promo,
           {_PHASE_NAMES}, {_EXTREME_NAMES}, ets_residual,
           {", ".join(_filled_forward(c) for c in _MATRIX_GAPS)}
    FROM modelled""")
_CTE["ends"] = ("modelled", """
    SELECT category, max_by(rolling_mean_7, date) AS rolling_mean_7,
           max_by(rolling_mean_28, date) AS rolling_mean_28,
           max_by(days_since_promo, date) AS since, max_by(num_skus, date) AS num_skus,
           max_by(ets_level, date) AS ets_level, max_by(final_sku_price, date) AS final_sku_price
    FROM modelled GROUP BY category""")

_SUMMARY = """
    SELECT 'data' AS section, 'sku_day_rows' AS item, CAST(count(*) AS VARCHAR) AS value FROM sku_day
    UNION ALL SELECT 'data', 'panel_rows', CAST(count(*) AS VARCHAR) FROM panel
    UNION ALL SELECT 'data', 'first_date', CAST(min(date) AS VARCHAR) FROM panel
    UNION ALL SELECT 'data', 'last_date', CAST(max(date) AS VARCHAR) FROM panel
    UNION ALL SELECT 'metrics', category || ' ' || metric, CAST(value AS VARCHAR)
              FROM (UNPIVOT (SELECT category, mape, mae, mase, bias_pct, r2 FROM by_category)
                    ON mape, mae, mase, bias_pct, r2 INTO NAME metric VALUE value)
    UNION ALL SELECT 'targets', 'avg_mape', CAST(round_even(avg_mape, 2) AS VARCHAR) FROM verdict
    UNION ALL SELECT 'targets', 'avg_mase', CAST(round_even(avg_mase, 3) AS VARCHAR) FROM verdict
    UNION ALL SELECT 'targets', 'status', CASE WHEN targets_met THEN 'met' ELSE 'not met' END
              FROM verdict"""


def _plain_sql() -> dict[str, str]:
    fill = f"SELECT {SKU_DAY}, fill_kind FROM "
    cal = _HOLIDAYS.format(
        years="(SELECT DISTINCT CAST(year(l_shipdate) AS INTEGER) AS y FROM lineitem)"
    )
    return {
        "load_sku_day": _with("sku_day", f"SELECT {SKU_DAY} FROM sku_day"),
        "load_exog": _with("exog", f"SELECT category, date, {WEATHER}, holiday_flag FROM exog"),
        "sku_keys": "SELECT l_returnflag || '_SKU_' || lpad(CAST(l_linenumber AS VARCHAR), 3, '0')"
        " AS sku_key, count(*) AS n_rows FROM lineitem GROUP BY 1",
        "input_profile": _with("sku_day", """SELECT count(*) AS n_rows, min(date) AS first_date,
            max(date) AS last_date, count(DISTINCT category) AS n_categories,
            count(DISTINCT sku_id) AS n_skus FROM sku_day"""),
        "low_instock_stats": _with("sku_day", """SELECT count(*) AS n_rows,
            count(*) FILTER (instock_rate < 60) AS n_low,
            round(100e0 * count(*) FILTER (instock_rate < 60) / count(*), 6) + 0e0 AS pct_low
            FROM sku_day"""),
        "interpolate_low_instock": _with("filled", fill + "filled"),
        "interpolate_limit1": _with("filled_limit1", fill + "filled_limit1"),
        "interpolate_long_gaps": _with("filled_long", fill + "filled_long"),
        "interpolate_no_limit": _with("filled_free", fill + "filled_free"),
        "fill_report": _with("filled_long",
            "SELECT fill_kind, count(*) AS n_rows FROM filled_long GROUP BY 1"),
        "category_rollup": _with("panel", f"SELECT {PANEL} FROM panel"),
        "weighted_avg": _with("raw_panel",
            f"SELECT category, date, {_r('instock_rate final_sku_price')} FROM raw_panel"),
        "promo_intensity": _with("raw_panel", f"""SELECT category, date, promo_flag,
            {_r('promo_intensity pct_skus_on_high_impact_promo')} FROM raw_panel"""),
        "panel_with_exog": _with("full_panel",
            f"SELECT {PANEL}, {WEATHER}, holiday_flag FROM full_panel"),
        "panel_profile": _with("panel", """SELECT category,
            round_even(avg(sales), 2) AS sales_mean, round_even(stddev_samp(sales), 2) AS sales_std,
            round_even(min(sales), 2) AS sales_min, round_even(max(sales), 2) AS sales_max,
            round_even(avg(instock_rate), 2) AS instock_rate_mean,
            round_even(avg(promo_intensity), 2) AS promo_intensity_mean,
            round_even(avg(pct_skus_on_high_impact_promo), 2) AS pct_skus_on_high_impact_promo_mean,
            round_even(avg(num_skus), 2) AS num_skus_mean FROM panel GROUP BY category"""),
        "mean_of_sku_means": _with("sku_day", """SELECT round(avg(m), 6) AS mean_of_sku_mean_sales
            FROM (SELECT avg(sales) AS m FROM sku_day GROUP BY sku_id)"""),
        "event_shares": _with("sku_day", """SELECT round(avg(high_impact_promo), 6) AS promo_rate,
            round(avg(instock_rate), 6) AS mean_instock_rate,
            round(avg(CASE WHEN instock_rate < 60 THEN 1 ELSE 0 END), 6) AS low_stock_rate
            FROM sku_day"""),
        "weather_shares": _with("exog", """SELECT round(avg(avg_temperature), 6) AS mean_temperature,
            round(avg(CASE WHEN avg_rainfall > 0 THEN 1 ELSE 0 END), 6) AS rainy_share,
            round(avg(CASE WHEN avg_snowfall > 0 THEN 1 ELSE 0 END), 6) AS snowy_share,
            round(avg(CASE WHEN holiday_flag <> -100 THEN 1 ELSE 0 END), 6) AS holiday_share
            FROM exog"""),
        "validate_panel": _with("checks",
            'SELECT "check", n_bad = 0 AS passed, n_bad FROM checks'),
        "valid_panel": _with("checks", "SELECT bool_and(n_bad = 0) AS valid FROM checks"),
        "date_continuity": _with("panel", """SELECT category,
            CAST(max(date) - min(date) + 1 AS INTEGER) AS expected_days,
            count(*) AS actual_days, max(date) - min(date) + 1 = count(*) AS complete
            FROM panel GROUP BY category"""),
        "null_profile": _with("features",
            f"SELECT * FROM ({_null_counts()}) WHERE n_null > 0"),
        "holiday_calendar": cal,
        "holiday_flag": _with("flags", "SELECT date, holiday_flag FROM flags"),
        "date_spine": _with("panel", """SELECT s.category, s.date, round(p.sales, 6) + 0e0 AS sales
            FROM (SELECT category, CAST(unnest(generate_series(min(date), max(date),
                         INTERVAL 1 DAY)) AS DATE) AS date FROM panel GROUP BY category) s
            LEFT JOIN panel p ON p.category = s.category AND p.date = s.date"""),
        "temporal_features": _with("panel", f"SELECT category, date, {TEMPORAL} FROM panel"),
        "lag_features": _with("panel", f"""SELECT category, date,
            {_r('sales promo_intensity ' + _LAG_COLUMNS)} FROM (SELECT *, {LAGS} FROM panel)"""),
        "rolling_features": _with("panel", f"""SELECT category, date,
            {_r('sales ' + _ROLLING_COLUMNS)} FROM (SELECT *, {ROLLING} FROM panel)"""),
        "days_since_promo": _with("panel", f"SELECT category, date, promo_flag, {SINCE} FROM panel"),
        "holiday_features": _with("exog",
            f"SELECT category, date, holiday_flag, {PHASES} FROM exog"),
        "weather_quantiles": _with("quantiles",
            f"SELECT category, {_r('temp_cold temp_hot precip_heavy')} FROM quantiles"),
        "weather_features": _with("weather_feats",
            f"SELECT category, date, {_r(_WEATHER_COLUMNS)}, {_EXTREME_NAMES} FROM weather_feats"),
        "engineer_features": _with("features", f"SELECT {FEATURES} FROM features"),
        "date_split": _with("panel ranks", f"""SELECT category, date, {_r('sales')},
            CASE WHEN rnk < 1000 THEN 'train' WHEN rnk < 1030 THEN 'val' ELSE 'test' END AS split
            FROM panel JOIN ranks USING (date) WHERE rnk < 1060"""),
        "semi_join_dates": _with("panel", f"""SELECT category, date, {_r('sales')} FROM panel
            WHERE date IN (SELECT CAST(o_orderdate AS DATE) FROM orders WHERE day(o_orderdate) = 13)"""),
        "union_splits": _with("labelled", f"""SELECT category, date, {_r('sales')}, split
            FROM labelled WHERE split <> 'test'"""),
        "expanding_folds": _with("panel ranks", _fold_sql()),
        "fill_missing": _with("panel", f"""SELECT category, date,
            {_r('lag_7 lag_28 rolling_mean_28 promo_lag_7')} FROM (SELECT category, date,
            {", ".join(_filled_forward(c) for c in
                       ("lag_7", "lag_28", "rolling_mean_28", "promo_lag_7"))}
            FROM (SELECT *, {LAGS}, {ROLLING} FROM panel))"""),
        "model_matrix": _with("matrix", f"""SELECT category, date, promo_flag, holiday_flag,
            {_TEMPORAL_NAMES}, days_since_promo, {_PHASE_NAMES}, {_EXTREME_NAMES},
            {_r('ets_residual ' + ' '.join(_MATRIX_GAPS))} FROM matrix"""),
        "tail_per_series": _with("panel", f"""SELECT category, date, {_r('sales')} FROM panel
            QUALIFY row_number() OVER (PARTITION BY category ORDER BY date DESC) <= 90"""),
        "last_state": _with("panel", f"""SELECT category, n_rows, last_date,
            round(x.sales, 6) AS last_sales, x.promo_flag AS last_promo_flag,
            x.num_skus AS last_num_skus, round(x.final_sku_price, 6) AS last_final_sku_price,
            x.days_since_promo AS last_days_since_promo
            FROM (SELECT *, max(date) OVER (PARTITION BY category) AS last_date,
                         count(*) OVER (PARTITION BY category) AS n_rows
                  FROM (SELECT *, {SINCE} FROM panel)) x WHERE x.date = x.last_date"""),
        "series_describe": _with("panel", """SELECT category, count(*) AS n, min(date) AS first_date,
            max(date) AS last_date, round(avg(sales), 6) AS mean, round(stddev_pop(sales), 6) AS std
            FROM panel GROUP BY category"""),
        "moving_average_fit": _with("panel", f"""SELECT {COMPONENTS} FROM (SELECT category, date,
            sales AS actual, avg(sales) {_frame(7)} AS ets_fitted,
            sales - avg(sales) {_frame(7)} AS ets_residual, avg(sales) {_frame(7)} AS ets_level
            FROM panel)"""),
        "ets_fallback": _with("panel", f"""SELECT {COMPONENTS} FROM (SELECT category, date,
            d AS actual, avg(d) {_frame(7)} AS ets_fitted, d - avg(d) {_frame(7)} AS ets_residual,
            avg(d) {_frame(7)} AS ets_level
            FROM (SELECT *, sales - lag(sales, 7) {_W} AS d FROM panel))"""),
        "ets_fixed": _with("fx_state", f"SELECT {STATE} FROM fx_state"),
        "ets_fit": _with("gr_state", f"SELECT {STATE} FROM gr_state"),
        "ets_components": _with("fx_comp", f"SELECT {COMPONENTS} FROM fx_comp"),
        "ets_forecast": _with("fx_fc",
            f"SELECT category, step, date, {_r('ets_forecast')} FROM fx_fc"),
        "ets_fit_stats": _with("fx_comp", f"""SELECT category, {_r('mse rmse mae mape')}
            FROM (SELECT category, avg(pow(ets_residual, 2)) AS mse,
                         sqrt(avg(pow(ets_residual, 2))) AS rmse, avg(abs(ets_residual)) AS mae,
                         avg(abs(ets_residual / actual)) * 100 AS mape
                  FROM fx_comp GROUP BY category)"""),
        "future_spine": _with("spine", "SELECT * FROM spine"),
        "future_lags": _with("flags_lags",
            f"SELECT category, step, date, {_r(_LAG_COLUMNS)} FROM flags_lags"),
        "future_promo_plan": _with("panel spine", """SELECT s.category, s.step, s.date,
            round(CASE WHEN c.category IS NULL THEN 0e0 ELSE p.promo_intensity END, 6)
                AS promo_intensity,
            CASE WHEN c.category IS NULL THEN 0 ELSE p.promo_flag END AS promo_flag
            FROM spine s
            LEFT JOIN (SELECT category, date + 28 AS date, promo_intensity, promo_flag
                       FROM (SELECT *, row_number() OVER
                                 (PARTITION BY category ORDER BY date DESC) AS rn FROM panel)
                       WHERE rn <= 28 AND promo_flag = 1) p
              ON p.category = s.category AND p.date = s.date
            LEFT JOIN (SELECT DISTINCT category
                       FROM (SELECT *, row_number() OVER
                                 (PARTITION BY category ORDER BY date DESC) AS rn FROM panel)
                       WHERE rn <= 28 AND promo_flag = 1) c ON c.category = s.category"""),
        "climatology": _with("climate", f"SELECT category, step, date, {WEATHER} FROM climate"),
        "future_weather": _with("outlook", f"SELECT {_OUTLOOK} FROM outlook"),
        "future_weather_plan": _with("planned_outlook", f"SELECT {_OUTLOOK} FROM planned_outlook"),
        "future_frame": _with("flags_lags ends outlook", f"""
            SELECT f.category, f.step, f.date, {TEMPORAL.replace("(date)", "(f.date)")
                                                 .replace("(day(date)", "(day(f.date)")},
                   {_r(_LAG_COLUMNS)},
                   round(e.rolling_mean_7, 6) AS rolling_mean_7,
                   round(e.rolling_mean_28, 6) AS rolling_mean_28,
                   0e0 AS promo_intensity, 0 AS promo_flag,
                   CAST(since + f.step AS INTEGER) AS days_since_promo,
                   0e0 AS pct_skus_on_high_impact_promo, 0e0 AS high_impact_promo,
                   e.num_skus AS num_skus, 95e0 AS instock_rate, -100 AS holiday_flag,
                   0 AS is_pre_holiday, 0 AS is_holiday_peak, 0 AS is_post_holiday,
                   {_r(_WEATHER_COLUMNS)}, {_EXTREME_NAMES},
                   round(e.ets_level, 6) AS ets_level,
                   round(e.final_sku_price, 6) AS final_sku_price
            FROM flags_lags f JOIN ends e ON e.category = f.category
            JOIN outlook o ON o.category = f.category AND o.step = f.step"""),
        "eval_join": _with("labelled hs_fc", """SELECT l.category, l.date,
            round(l.sales, 6) + 0e0 AS sales, round(f.ets_forecast, 6) + 0e0 AS ets_forecast
            FROM labelled l LEFT JOIN hs_fc f ON f.category = l.category AND f.date = l.date
            WHERE l.split = 'test'"""),
        "plot_forecast_actual": _with("labelled hs_fc", """
            SELECT x.*, s.forecast_start FROM (
                SELECT category, date, 'train' AS part, round(sales, 6) + 0e0 AS sales,
                       CAST(NULL AS DOUBLE) AS forecast
                FROM (SELECT *, row_number() OVER (PARTITION BY category ORDER BY date DESC) AS rn
                      FROM labelled WHERE split = 'train') WHERE rn <= 90
                UNION ALL
                SELECT l.category, l.date, 'test', round(l.sales, 6) + 0e0,
                       round(f.ets_forecast, 6) + 0e0
                FROM labelled l LEFT JOIN hs_fc f ON f.category = l.category AND f.date = l.date
                WHERE l.split = 'test') x
            JOIN (SELECT category, min(date) AS forecast_start FROM labelled
                  WHERE split = 'test' GROUP BY category) s ON s.category = x.category"""),
        "forecast_metrics": _with("scored",
            f"SELECT category, {_metrics(False)} FROM scored GROUP BY category"),
        "metrics_by_category": _with("by_category", "SELECT * FROM by_category"),
        "metrics_overall": _with("scored", f"SELECT {_metrics(True)} FROM scored"),
        "metrics_with_total": _with("by_category", f"""SELECT *, 0 AS is_total FROM by_category
            UNION ALL SELECT NULL, {_metrics(True)}, 1 FROM scored"""),
        "target_verdict": _with("verdict", f"""SELECT n_series, {_r('avg_mape avg_mase')},
            mape_met, mase_met, targets_met FROM verdict"""),
        "component_metrics": _with("components", "SELECT * FROM components"),
        "component_improvement": _with("components", """SELECT
            round(avg(mae_improvement_pct), 6) + 0e0 AS avg_mae_improvement_pct,
            round(avg(mape_improvement_pct), 6) + 0e0 AS avg_mape_improvement_pct
            FROM components"""),
        "component_frame": _with("backtest", f"""SELECT category, date,
            {_r('sales ets_forecast residual_forecast final_forecast')} FROM backtest"""),
        "residual_frame": _with("residuals",
            f"SELECT category, date, {_r('actual predicted residual ape')} FROM residuals"),
        "residual_summary": _with("residuals", f"""SELECT category,
            {_r('mean_residual std_residual mean_ape scatter_min scatter_max')}
            FROM (SELECT category, avg(residual) AS mean_residual,
                         stddev_pop(residual) AS std_residual, avg(ape) AS mean_ape,
                         least(min(actual), min(predicted)) AS scatter_min,
                         greatest(max(actual), max(predicted)) AS scatter_max
                  FROM residuals GROUP BY category)"""),
        "residual_histogram": _with("residuals", """SELECT category, bin,
            round(lo + bin * ((hi - lo) / 30), 6) + 0e0 AS bin_start, count(*) AS n_rows
            FROM (SELECT category, lo, hi,
                         CAST(least(floor((residual - lo) * 30 / (hi - lo)), 29) AS INTEGER) AS bin
                  FROM residuals
                  JOIN (SELECT category, min(residual) AS lo, max(residual) AS hi
                        FROM residuals GROUP BY category) USING (category))
            GROUP BY category, lo, hi, bin"""),
        "metrics_long": _with("by_category", """SELECT category, metric, value,
            CASE metric WHEN 'mape' THEN 20e0 WHEN 'mase' THEN 1e0 WHEN 'bias_pct' THEN 0e0 END
                AS target
            FROM (UNPIVOT (SELECT category, mape, mae, mase, bias_pct FROM by_category)
                  ON mape, mae, mase, bias_pct INTO NAME metric VALUE value)"""),
        "run_summary": _with("sku_day panel by_category verdict", _SUMMARY),
    }


_SERIES_ENCODING = """
    SELECT a.sku_id, f.fold,
           round(CASE WHEN a.n > coalesce(p.n, 0)
                      THEN (a.s - coalesce(p.s, 0)) / (a.n - coalesce(p.n, 0)) ELSE 0 END, 6) + 0e0 AS code
    FROM (SELECT sku_id, sum(sales) AS s, count(*) AS n FROM sku_day GROUP BY 1) a
    CROSS JOIN (SELECT CAST(unnest(range(-1, 5)) AS INTEGER) AS fold) f
    LEFT JOIN (SELECT sku_id, (date_diff('day', DATE '1970-01-01', date) // 28) % 5 AS fold,
                      sum(sales) AS s, count(*) AS n FROM sku_day GROUP BY 1, 2) p
      ON a.sku_id = p.sku_id AND f.fold = p.fold"""


def oracle_sql() -> dict[str, str]:
    """SQL by query; what is written and read again must equal what was written."""
    plain = _plain_sql()
    return plain | {
        "csv_round_trip": plain["load_sku_day"],
        "panel_sink": plain["load_sku_day"],
        "panel_republish": _with("sku_day", f"""SELECT {SKU_DAY} FROM (SELECT * REPLACE (
            CASE WHEN date >= DATE '1997-01-01' THEN 2 * sales ELSE sales END AS sales) FROM sku_day)"""),
        "ets_state_reload": plain["ets_forecast"],
        "exog_round_trip": plain["load_exog"],
        "duplicate_keys": """SELECT l_returnflag AS category, CAST(l_shipdate AS DATE) AS date, count(*) AS n_rows
            FROM lineitem GROUP BY ALL HAVING count(*) > 1""",
        "expanding_folds_start": _with("panel ranks", """
            SELECT p.category, p.date, round(p.sales, 6) + 0e0 AS sales, CAST(f AS INTEGER) AS fold,
                   CASE WHEN rnk < 500 + f * 30 THEN 'train' ELSE 'val' END AS role
            FROM panel p JOIN ranks USING (date) CROSS JOIN (SELECT unnest([0, 1, 2]) AS f)
            WHERE rnk < 530 + f * 30 AND 530 + f * 30 <= n"""),
        "hybrid_combine": _with("backtest", f"""
            SELECT category, CAST(row_number() OVER (PARTITION BY category ORDER BY date) AS INTEGER) AS step, date,
                   {_r('ets_forecast')}, round(residual_forecast - ets_forecast, 6) + 0e0 AS residual_forecast,
                   round(greatest(residual_forecast, 0), 6) + 0e0 AS final_forecast
            FROM backtest"""),
        "model_reload": _with("features", "SELECT category, date, true AS same FROM features"),
        "series_encoding": _with("sku_day", _SERIES_ENCODING),
        "params_round_trip": _with("sku_day", """SELECT 'absent_before' AS name, 1e0 AS value UNION ALL
            SELECT 'most', max(sales) FROM sku_day UNION ALL
            SELECT 'series', CAST(count(DISTINCT sku_id) AS DOUBLE) FROM sku_day"""),
    }
