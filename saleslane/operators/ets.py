"""Exponential smoothing of every series in one distributed job.

Rows are hash-partitioned by series and sorted by day inside the partitions; the sort spills to
disk.  A task reads its partition in order and holds one block of series as arrays of numbers: eight
bytes a day and series, however many source rows a day stands for.  The whole search of a block,
grid and refinements, is one pass over the rows.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saleslane import config as _config
from saleslane.config import EtsConfig
from saleslane.functions.exprs import series_window, strict_avg
from saleslane.operators import smoothing as _smoothing
from saleslane.operators.smoothing import (
    BLOCK_PAIRS,
    grid,
    search,
    series_runs,
    step_pairs,
    trailing_means,
    usable,
)

# The code that runs inside tasks travels with them, so executors need no installed package.
for _module in (_config, _smoothing):
    cloudpickle.register_pickle_by_value(_module)

KEYS = ("category",)
PARAMS = ("alpha", "beta", "gamma", "phi")
FITTED = ("ets_fitted", "ets_residual", "ets_level")
#: Series, and values, of a block that is fitted together.
BLOCK_SERIES = 1024
BLOCK_VALUES = 1 << 20

_DOUBLE = T.DoubleType()
_STATE = (
    [T.StructField(p, _DOUBLE) for p in PARAMS]
    + [
        T.StructField("level", _DOUBLE),
        T.StructField("trend", _DOUBLE),
        T.StructField("season", T.ArrayType(_DOUBLE)),
        T.StructField("sse", _DOUBLE),
        T.StructField("n", T.LongType()),
        T.StructField("last_date", T.DateType()),
        T.StructField("fallback", T.BooleanType()),
    ]
)


def _in_series_order(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows dealt out by series and sorted; the given number keeps few series from sharing a task."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(parts, *keys).sortWithinPartitions(*keys, "date")


def ets_fit(
    df: DataFrame, keys: Sequence[str] = KEYS, y: str = "sales", spec: EtsConfig = EtsConfig()
) -> DataFrame:
    """One state row per series: parameters, final level, trend and season, error and size.

    Fixed parameters are used only if all three are given.  Otherwise a grid is searched for
    the least squared one-step error and, with ``spec.refine``, ever finer grids around each
    series' winner, which may lie anywhere between the bounds of the parameters.  Series that are too short, lack a value, are not positive under a
    multiplicative part or never give a finite error are marked ``fallback`` and keep a
    trailing mean as their level.
    """
    keys = list(keys)
    rows = df.select(*keys, "date", F.col(y).cast("double").alias("y"))
    schema = T.StructType([rows.schema[k] for k in keys] + _STATE)
    names = [f.name for f in schema]
    per_block = max(1, BLOCK_PAIRS // len(grid(spec)[0]))

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block in _blocks(_whole_series(batches, keys), per_block):
            good = [i for i, (_, values, _) in enumerate(block) if usable(spec, values)]
            with np.errstate(all="ignore"):
                states = dict(zip(good, search(spec, [block[i][1] for i in good])[0])) if good else {}
            rows = []
            for i, (key, values, last) in enumerate(block):
                state = states.get(i)
                row = {**dict(zip(keys, key)), "n": len(values), "last_date": last, "fallback": state is None}
                rows.append(row | (state or {"level": trailing_means(values, spec.period)[-1]}))
            yield pd.DataFrame({c: pd.Series([r.get(c) for r in rows], dtype=object) for c in names})

    return _in_series_order(rows, keys).mapInPandas(fit, schema)


def _whole_series(batches: Iterator[pd.DataFrame], keys: Sequence[str]) -> Iterator[tuple[tuple, np.ndarray, object]]:
    for key, runs in series_runs(batches, keys):
        parts, last = [], None
        for run in runs:
            parts.append(run["y"].to_numpy(dtype=float))
            last = run["date"].iloc[-1]
        yield key, np.concatenate(parts), last


def _blocks(series: Iterator[tuple], most: int) -> Iterator[list[tuple]]:
    """Lists of up to ``most`` series, or fewer once they hold many values; the second field has the values."""
    block, held = [], 0
    for one in series:
        block.append(one)
        held += len(one[1])
        if len(block) >= most or held >= BLOCK_VALUES:
            yield block
            block, held = [], 0
    if block:
        yield block


def _carried(
    df: DataFrame, state: DataFrame, keys: Sequence[str], y: str, spec: EtsConfig, how: str
) -> DataFrame:
    """The rows with all their columns and ``ets_fitted``, ``ets_residual``, ``ets_level`` in one pass."""
    keys, columns = list(keys), [c for c in df.columns if c not in FITTED]
    known = state.select(*keys, *(F.col(p).alias(f"_{p}") for p in PARAMS), F.col("fallback").alias("_fallback"))
    rows = df.select(*columns, F.col(y).cast("double").alias("_y")).join(known, keys, how).select(*columns, "_y", *(f"_{p}" for p in PARAMS), "_fallback")
    schema = rows.select(*columns).schema
    for name in FITTED:
        schema = schema.add(name, "double")

    def series(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for _, runs in itertools.groupby(_arrow_runs(batches, keys), key=lambda run: run[0]):
            parts = [part for _, part in runs]
            values = np.concatenate([p.column("_y").to_numpy(zero_copy_only=False).astype(float) for p in parts])
            yield parts, values, parts[0].select([f"_{p}" for p in PARAMS] + ["_fallback"]).slice(0, 1).to_pylist()[0]

    def components(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(series(batches), BLOCK_SERIES):
            fitted = [x for x in block if x[2]["_fallback"] is False]
            if fitted:
                params = [np.array([x[2][f"_{p}"] for x in fitted], dtype=float) for p in PARAMS]
                with np.errstate(all="ignore"):
                    steps = step_pairs(spec, [x[1] for x in fitted], np.arange(len(fitted)), params, record=True)
            place = 0
            for parts, values, known in block:
                if known["_fallback"] is None:
                    fits = levels = np.full(len(values), np.nan)
                elif known["_fallback"]:
                    fits = levels = np.array(trailing_means(values, spec.period), dtype=float)
                else:
                    fits, levels = (x[: len(values), place] for x in (steps.fitted, steps.levels))
                    place += 1
                at = 0
                for part in parts:
                    cut = slice(at, at + part.num_rows)
                    new = (fits[cut], values[cut] - fits[cut], levels[cut])
                    arrays = [*(part.column(c) for c in columns), *(pa.array(x, from_pandas=True) for x in new)]
                    yield pa.RecordBatch.from_arrays(arrays, names=[*columns, *FITTED])
                    at += part.num_rows

    return _in_series_order(rows, keys).mapInArrow(components, schema)


def _arrow_runs(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Sorted batches cut where the series changes."""
    for batch in batches:
        if batch.num_rows:
            codes = batch.select(list(keys)).to_pandas().groupby(list(keys), sort=False, dropna=False).ngroup().to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(codes)) + 1).tolist(), batch.num_rows]
            for start, end in zip(edges, edges[1:]):
                part = batch.slice(start, end - start)
                yield tuple(part.column(k)[0].as_py() for k in keys), part


def ets_components(
    df: DataFrame,
    state: DataFrame,
    keys: Sequence[str] = KEYS,
    y: str = "sales",
    spec: EtsConfig = EtsConfig(),
) -> DataFrame:
    """``actual``, ``ets_fitted``, ``ets_residual`` and ``ets_level`` of every row of a series with a state.

    Rows of fallback series are fitted by the trailing mean that includes the row itself.
    """
    rows = df.select(*keys, "date", F.col(y).cast("double").alias("actual"))
    return _carried(rows, state, keys, "actual", spec, "inner")


def with_ets_components(
    df: DataFrame,
    state: DataFrame,
    keys: Sequence[str] = KEYS,
    y: str = "sales",
    spec: EtsConfig = EtsConfig(),
) -> DataFrame:
    """The frame with fitted values, residuals and levels; they are missing where a series has no state."""
    return _carried(df, state, keys, y, spec, "left")


def moving_average_fit(
    df: DataFrame, keys: Sequence[str] = KEYS, y: str = "sales", period: int = 7
) -> DataFrame:
    """The fallback fit of every series: a trailing mean that accepts partial windows."""
    frame = series_window(keys).rowsBetween(1 - period, 0)
    mean = F.avg(y).over(frame)
    return df.select(
        *keys, "date", F.col(y).alias("actual"), mean.alias("ets_fitted"),
        (F.col(y) - mean).alias("ets_residual"), mean.alias("ets_level"),
    )


def series_describe(
    df: DataFrame, keys: Sequence[str] = KEYS, y: str = "sales"
) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        strict_avg(F.col(y)).alias("mean"),
        F.when(F.count(y) == F.count(F.lit(1)), F.stddev_pop(y)).alias("std"),
    )


def ets_fit_stats(components: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Errors per series; one missing residual makes its series' errors NULL, as one zero actual
    makes its percentage error."""
    residual = F.col("ets_residual")
    mse = strict_avg(residual * residual)
    return components.groupBy(*keys).agg(
        mse.alias("mse"),
        F.sqrt(mse).alias("rmse"),
        strict_avg(F.abs(residual)).alias("mae"),
        (strict_avg(F.abs(F.try_divide(residual, F.col("actual")))) * 100).alias("mape"),
    )


def ets_forecast(
    state: DataFrame,
    horizon: int = 30,
    keys: Sequence[str] = KEYS,
    spec: EtsConfig = EtsConfig(),
) -> DataFrame:
    """Rows ``(keys, step, date, ets_forecast)`` straight from the state table.

    The damped trend after ``h`` steps is a closed form, so no recursion is needed; fallback
    series repeat their last level.
    """
    steps = state.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    phi, h = F.col("phi"), F.col("step")
    damping = F.when(phi == 1, h.cast("double")).otherwise(
        F.try_divide(phi * (1 - F.pow(phi, h)), 1 - phi)
    )
    base = F.col("level")
    if spec.trend == "add":
        base = base + F.col("trend") * damping
    elif spec.trend == "mul":
        base = base * F.pow("trend", damping)
    index = F.get("season", (h - 1) % spec.period)
    if spec.seasonal == "mul":
        value = base * index
    elif spec.seasonal == "add":
        value = base + index
    else:
        value = base
    return steps.select(
        *keys,
        "step",
        F.date_add("last_date", h).alias("date"),
        F.when(F.col("fallback"), F.col("level")).otherwise(value).alias("ets_forecast"),
    )
