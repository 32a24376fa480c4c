"""One pooled boosted-tree model of the smoothing residuals of all series."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from saleslane.config import BoostConfig
from saleslane.functions.dates import TEMPORAL
from saleslane.operators.boosting import (
    TASK_ROWS,
    TRAIN,
    VALIDATE,
    Fit,
    Grown,
    Layout,
    Tree,
    best_round,
    binner,
    feature_cuts,
    fit_all,
    unit_of,
)
from saleslane.operators.splits import fill_missing
from saleslane.plans.durable import durable

KEYS = ("category",)
TARGET = "ets_residual"

# Columns that are identifiers, targets or diagnostics, not features.
EXCLUDED = (
    "date", "sales", "ets_fitted", "ets_residual", "actual", "holiday_name",
    "num_skus", "high_impact_promo", "instock_rate",
)
BOOKKEEPING = ("split", "step", "fold", "role")

NEVER_NULL = {
    *TEMPORAL,
    "is_pre_holiday", "is_holiday_peak", "is_post_holiday",
    "is_extreme_cold", "is_extreme_hot", "heavy_precip_flag",
    "promo_flag", "days_since_promo",
}


def feature_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Every column but keys' diagnostics, targets and bookkeeping, in frame order."""
    out = {*EXCLUDED, *BOOKKEEPING, *exclude}
    return [c for c in df.columns if c not in out]


def model_matrix(
    df: DataFrame, keys: Sequence[str] = KEYS, exclude: Sequence[str] = ()
) -> DataFrame:
    """Features without NULLs, with the date, target and split of each row if present.

    Gaps are filled within a series.  Columns that cannot be NULL by construction are left
    out of the window pass.
    """
    features = feature_columns(df, exclude)
    gaps = [c for c in features if c not in NEVER_NULL and c not in keys]
    carried = [c for c in ("date", TARGET, *BOOKKEEPING) if c in df.columns]
    return fill_missing(df, gaps, keys).select(*features, *carried)


#: Training dates are dealt to this many groups of blocks of so many days; see ``series_encoding``.
FOLDS = 5
FOLD_DAYS = 28
ALL_FOLDS = -1
#: Series that are nominal bins of their own; beyond that, bins hold series of like mean residual.
MAX_SERIES = 1024


@dataclass(frozen=True)
class ResidualModel:
    """A fitted model: trees over binned features, and the code (keys, _code) of each series."""

    keys: tuple[str, ...]
    features: tuple[str, ...]
    cuts: tuple[tuple[float, ...], ...]
    codes: DataFrame
    n_codes: int
    grown: Grown

    @property
    def rounds(self) -> int:
        return len(self.grown.trees)

    @property
    def validation_errors(self) -> list[float]:
        """Mean absolute error on the validation rows after every round that was grown."""
        return self.grown.errors

    def predict(self, matrix: DataFrame, out: str = "residual_forecast") -> DataFrame:
        columns, features = [c for c in matrix.columns if c != out], list(self.features)
        bins, grown = binner(list(self.cuts), self.n_codes), self.grown

        def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = bins(batch, features, "_code").astype(np.int64)
                total = np.full(batch.num_rows, grown.start)
                for tree in grown.trees:
                    total += tree.outputs(rows)
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), pa.array(total)], names=[*columns, out])

        coded = matrix.select(*columns).join(self.codes, list(self.keys), "left").select(*columns, "_code")
        return coded.mapInArrow(predicted, coded.drop("_code").schema.add(out, "double"))

    def nodes(self) -> DataFrame:
        """The trees as a table, one row per node."""
        names = ("feature", "cut", "codes", "left", "right", "value", "gain", "depth")
        rows = [
            (t, n, *values)
            for t, tree in enumerate(self.grown.trees)
            for n, values in enumerate(zip(*(getattr(tree, name) for name in names), strict=True))
        ]
        return SparkSession.active().createDataFrame(rows, NODES_SCHEMA)

    def save(self, path: str) -> None:
        spark = SparkSession.active()
        meta = [(list(self.keys), list(self.features), [list(c) for c in self.cuts], self.n_codes, self.rounds, self.grown.start, self.grown.errors)]
        spark.createDataFrame(meta, META_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{path}/meta")
        self.nodes().write.mode("overwrite").parquet(f"{path}/nodes")
        self.codes.write.mode("overwrite").parquet(f"{path}/codes")


NODES_SCHEMA = (
    "tree int, node int, feature int, cut int, codes array<int>, `left` int, `right` int, value double, gain double, depth int"
)
META_SCHEMA = (
    "keys array<string>, features array<string>, cuts array<array<double>>, n_codes int, rounds int, start double, errors array<double>"
)


def load_residual_model(spark: SparkSession, path: str) -> ResidualModel:
    """A stored model; its nodes are bounded by rounds and leaves, whatever it was trained on."""
    meta = spark.read.schema(META_SCHEMA).parquet(f"{path}/meta").first()
    trees = [Tree(*([] for _ in range(8))) for _ in range(meta["rounds"])]
    for row in spark.read.schema(NODES_SCHEMA).parquet(f"{path}/nodes").orderBy("tree", "node").collect():
        for name, values in vars(trees[row["tree"]]).items():
            values.append(row[name])
    grown = Grown(meta["start"], trees, list(meta["errors"]))
    codes = spark.read.parquet(f"{path}/codes")
    return ResidualModel(tuple(meta["keys"]), tuple(meta["features"]), tuple(map(tuple, meta["cuts"])), codes, meta["n_codes"], grown)


def fold_of(date: Column) -> Column:
    """The group of date blocks that a training row belongs to."""
    return F.pmod(F.floor(F.datediff(date, F.lit("1970-01-01").cast("date")) / FOLD_DAYS), F.lit(FOLDS)).cast("int")


def series_encoding(train: DataFrame, keys: Sequence[str] = KEYS, y: str = TARGET) -> DataFrame:
    """Rows (keys, _fold, _series_code): a series' mean residual without the dates of a fold.

    A training row takes the mean of the other folds, so its own residual, and those of the days
    around it, never reach its features.  The rows of fold ``ALL_FOLDS`` hold the mean of all
    training rows, for every other row.  The same for any number of series; a series that has no
    other fold gets 0.
    """
    keys = list(keys)
    known = train.filter(F.col(y).isNotNull())
    parts = known.groupBy(*keys, fold_of(F.col("date")).alias("_fold")).agg(
        F.sum(y).alias("part_sum"), F.count(F.lit(1)).alias("part_n")
    )
    folds = F.explode(F.sequence(F.lit(ALL_FOLDS), F.lit(FOLDS - 1))).alias("_fold")
    whole = parts.groupBy(*keys).agg(F.sum("part_sum").alias("all_sum"), F.sum("part_n").alias("all_n"))
    rest_sum = F.col("all_sum") - F.coalesce("part_sum", F.lit(0.0))
    rest_n = F.col("all_n") - F.coalesce("part_n", F.lit(0))
    code = F.when(rest_n > 0, rest_sum / rest_n).otherwise(0.0)
    return (
        whole.select(*keys, "all_sum", "all_n", folds)
        .join(parts, [*keys, "_fold"], "left")
        .select(*keys, "_fold", code.alias("_series_code"))
    )


def merge_params(defaults: BoostConfig, tuned: dict[str, float] | None) -> BoostConfig:
    """Tuned values over defaults, each with the type of the default it replaces."""
    known = {k: v for k, v in (tuned or {}).items() if hasattr(defaults, k)}
    return replace(defaults, **{k: type(getattr(defaults, k))(v) for k, v in known.items()})


def series_codes(train: DataFrame, keys: Sequence[str] = KEYS, most: int = MAX_SERIES) -> tuple[DataFrame, int]:
    """(keys, _code) of each series, and the number of codes, which is ``most`` at the most.

    Up to ``most`` series have a code of their own.  More series are cut into so many groups
    by their mean residual, which costs no more than one aggregation.
    """
    keys = list(keys)
    series = train.select(*keys).distinct()
    number = series.limit(most + 1).count()
    if number <= most:
        place = (F.row_number().over(Window.orderBy(*keys)) - 1).cast("int")
        return durable(series.select(*keys, place.alias("_code"))), number
    means = durable(series_encoding(train, keys).where(F.col("_fold") == ALL_FOLDS))
    edges = feature_cuts(means, ["_series_code"], most)[0]
    below = F.size(F.filter(F.array(*map(F.lit, edges)), lambda c: c < F.col("_series_code")))
    return durable(means.select(*keys, below.alias("_code"))), len(edges) + 1


@dataclass(frozen=True)
class Binned:
    """Rows ready for boosting, with all that turns other rows into the same bins."""

    rows: DataFrame
    layout: Layout
    features: tuple[str, ...]
    cuts: tuple[tuple[float, ...], ...]
    codes: DataFrame
    n_codes: int


def bin_rows(rows: DataFrame, train: Column, roles: Sequence[Column], max_bins: int, keys: Sequence[str] = KEYS) -> Binned:
    """Bin rows that have a target once; ``train`` says which of them set bins and series codes.

    ``roles`` gives each row's part (0, TRAIN or VALIDATE) in each of several splits.
    """
    features = [c for c in feature_columns(rows) if c not in keys and not c.startswith("_")]
    known = durable(rows.select(*rows.columns, *(r.alias(f"_role_{i}") for i, r in enumerate(roles)), train.alias("_train")))
    codes, n_codes = series_codes(known.where("_train"), keys)
    cuts = feature_cuts(known.where("_train"), features, max_bins)
    unit, _ = unit_of(known, TARGET)
    bins, names = binner(cuts, n_codes), [f"_role_{i}" for i in range(len(roles))]

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = [pa.array([x.tobytes() for x in bins(batch, features, "_code")], pa.binary())]
            parts = np.stack([batch.column(n).to_numpy(zero_copy_only=False) for n in names], axis=1).astype("<u1")
            cells.append(pa.array([x.tobytes() for x in parts], pa.binary()))
            yield pa.RecordBatch.from_arrays([*cells, batch.column("_y"), batch.column("_key")], names=["bins", "roles", "y", "key"])

    dated = [c for c in ("date",) if c in rows.columns]
    coded = known.join(codes, list(keys), "left").select(
        *features, *names, "_code", F.col(TARGET).cast("double").alias("_y"), F.xxhash64(*keys, *dated).alias("_key")
    )
    stored = durable(coded.mapInArrow(binned, "bins binary, roles binary, y double, key long"))
    layout = Layout((n_codes + 1, *(len(c) + 1 for c in cuts)), unit)
    return Binned(stored, layout, tuple(features), tuple(map(tuple, cuts)), codes, n_codes)


def fit_residual_model(
    matrix: DataFrame,
    config: BoostConfig = BoostConfig(),
    keys: Sequence[str] = KEYS,
    validation: Column | None = None,
    task_rows: int = TASK_ROWS,
) -> ResidualModel:
    """Fit one model over all series on the rows that are not ``validation``.

    With ``config.patience`` trees are added until the mean absolute error on the validation rows
    has not fallen for that many rounds; those after the best round are dropped.  No tree is
    grown twice.  Series are bins of a nominal feature.
    """
    held_out = F.lit(False) if validation is None else F.coalesce(validation, F.lit(False))
    role = F.when(held_out, VALIDATE).otherwise(TRAIN)
    made = bin_rows(matrix.dropna(subset=[TARGET]), ~held_out, [role], config.max_bins, keys)
    grown = fit_all(made.rows, made.layout, [Fit(config)], task_rows)[0]
    return ResidualModel(tuple(keys), made.features, made.cuts, made.codes, made.n_codes, grown)


def feature_importance(model: ResidualModel) -> DataFrame:
    """One row ``(feature, importance)`` per feature; importances are shares of all gains."""
    names = ["_".join(model.keys), *model.features]
    gains = [0.0] * len(names)
    for tree in model.grown.trees:
        for feature, gain in zip(tree.feature, tree.gain, strict=True):
            if feature >= 0:
                gains[feature] += gain
    whole = sum(gains) or 1.0
    return SparkSession.active().createDataFrame([(n, g / whole) for n, g in zip(names, gains, strict=True)], "feature string, importance double")


def top_features(model: ResidualModel, k: int = 20) -> DataFrame:
    return feature_importance(model).orderBy(F.desc("importance"), "feature").limit(k)


def residual_mae(model: ResidualModel, matrix: DataFrame) -> DataFrame:
    """Mean absolute error of the residual forecast per split, next to that of forecasting 0."""
    error = F.abs(F.col(TARGET) - F.col("residual_forecast"))
    return (
        model.predict(matrix.dropna(subset=[TARGET]))
        .groupBy("split")
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.avg(error).alias("mae"),
            F.avg(F.abs(TARGET)).alias("mae_of_zero"),
        )
    )
