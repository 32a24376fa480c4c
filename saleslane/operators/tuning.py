"""Seeded random search of the boosting parameters over expanding folds."""

from __future__ import annotations

import math
import random
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleslane.config import BoostConfig, TuningConfig
from saleslane.operators.boosting import TASK_ROWS, TRAIN, VALIDATE, Fit, fit_all
from saleslane.operators.residual import KEYS, TARGET, bin_rows, merge_params
from saleslane.operators.splits import fold_table
from saleslane.plans.durable import durable

# Range of each parameter; "log" ranges are sampled on a log scale.
SPACE = {
    "num_leaves": ("int", 15, 127),
    "max_depth": ("int", 3, 10),
    "learning_rate": ("log", 0.01, 0.2),
    "min_rows_per_leaf": ("int", 10, 50),
    "feature_fraction": ("float", 0.5, 1.0),
    "row_fraction": ("float", 0.5, 1.0),
    "bagging_freq": ("int", 1, 10),
    "lambda_l1": ("log", 1e-8, 10.0),
    "lambda_l2": ("log", 1e-8, 10.0),
    "min_gain": ("float", 0.0, 15.0),
    "rounds": ("int", 50, 500),
}

TRIALS_SCHEMA = "trial int, fold int, params map<string,double>, mae double"


def sample_params(space: dict, n_trials: int, seed: int) -> list[dict[str, float]]:
    rng = random.Random(seed)

    def draw(kind: str, low: float, high: float) -> float:
        if kind == "int":
            return float(rng.randint(int(low), int(high)))
        if kind == "log":
            return math.exp(rng.uniform(math.log(low), math.log(high)))
        return rng.uniform(low, high)

    return [{name: draw(*limits) for name, limits in space.items()} for _ in range(n_trials)]


def tune(
    matrix: DataFrame,
    tuning: TuningConfig = TuningConfig(),
    space: dict = SPACE,
    defaults: BoostConfig = BoostConfig(),
    keys: Sequence[str] = KEYS,
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """Rows ``(trial, fold, params, mae)``: the validation error of every trial and fold.

    Rows are binned once for all fits, with their part in each fold beside them.  All fits run
    together: side by side in tasks while the rows fit into one, else in lockstep over all rows.
    """
    spark = matrix.sparkSession
    table = fold_table(matrix, tuning.folds, tuning.min_train, tuning.val, tuning.anchor)
    folds = [r["fold"] for r in table.select("fold").distinct().orderBy("fold").collect()]
    if not folds:
        raise ValueError("not enough dates for a single fold: lower min_train or val")
    code = F.when(F.col("role") == "val", VALIDATE).otherwise(TRAIN)
    roles = [f"_part_{i}" for i in folds]
    dates = table.groupBy("date").agg(
        *(F.coalesce(F.max(F.when(F.col("fold") == i, code)), F.lit(0)).alias(name) for i, name in zip(folds, roles, strict=True))
    )
    # One row per date: the calendar bounds what is broadcast.
    rows = durable(matrix.dropna(subset=[TARGET]).join(F.broadcast(dates), "date"))
    made = bin_rows(rows, F.lit(True), [F.col(name) for name in roles], defaults.max_bins, keys)
    trials = sample_params(space, tuning.trials, tuning.seed)
    jobs = [(t, place) for t in range(len(trials)) for place in range(len(folds))]
    fits = [Fit(merge_params(defaults, trials[t]), place) for t, place in jobs]
    grown = fit_all(made.rows, made.layout, fits, task_rows)
    found = [(t, folds[place], trials[t], g.mae) for (t, place), g in zip(jobs, grown, strict=True)]
    return spark.createDataFrame(found, TRIALS_SCHEMA)


def best_params(trials: DataFrame) -> dict[str, float]:
    """Parameters of the trial with the least mean error, the earliest on a tie."""
    means = trials.groupBy("trial").agg(
        F.avg("mae").alias("mae"), F.any_value("params").alias("params")
    )
    return dict(means.orderBy("mae", "trial").first()["params"])
