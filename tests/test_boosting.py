import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from saleslane.config import BoostConfig, TuningConfig
from saleslane.operators import boosting, residual, tuning
from saleslane.operators.boosting import TRAIN, VALIDATE, Block, Fit, Layout
from tests.helpers import day


def block(n=300, seed=0):
    rng = np.random.default_rng(seed)
    bins = np.stack([rng.integers(0, 6, n), rng.integers(0, 8, n), rng.integers(0, 4, n)], axis=1)
    y = 5.0 * (bins[:, 0] % 2) + np.where(bins[:, 1] > 3, 3.0, 0.0) + rng.normal(0, 0.5, n)
    roles = np.where(rng.random((n, 2)) < 0.2, VALIDATE, TRAIN).astype("u1")
    return Block(bins.astype(np.int64), y, roles, rng.integers(0, 1 << 62, n).astype(np.uint64))


LAYOUT = Layout((7, 8, 4), 2.0**-30)
PLAIN = BoostConfig(rounds=5, max_depth=3, min_rows_per_leaf=5, feature_fraction=1.0, row_fraction=1.0, learning_rate=0.3, lambda_l1=0.5, lambda_l2=2.0)


def slow_tree(rows, bins, residual, config, depth=0):
    """A tree by plain search over all subsets of the nominal bins in their order and all cuts."""
    def pulled(x):
        return np.sign(x) * max(abs(x) - config.lambda_l1, 0)

    def worth(part):
        return pulled(residual[part].sum()) ** 2 / (len(part) + config.lambda_l2)

    value = config.learning_rate * pulled(residual[rows].sum()) / (len(rows) + config.lambda_l2)
    best = None
    if depth < config.max_depth:
        mean = {c: residual[rows[bins[rows, 0] == c]].sum() / ((bins[rows, 0] == c).sum() + 10) for c in sorted(set(bins[rows, 0].tolist()))}
        order = sorted(mean, key=lambda c: (mean[c], c))
        tests = [np.isin(bins[rows, 0], order[: i + 1]) for i in range(len(order))]
        tests += [bins[rows, f] <= cut for f in (1, 2) for cut in range(8)]
        for test in tests:
            a, b = rows[test], rows[~test]
            if min(len(a), len(b)) >= config.min_rows_per_leaf:
                gain = worth(a) + worth(b) - worth(rows)
                if gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                    best = gain, a, b
    out = np.zeros(len(residual))
    if best is None:
        out[rows] = value if depth else 0.0
        return out
    return slow_tree(best[1], bins, residual, config, depth + 1) + slow_tree(best[2], bins, residual, config, depth + 1)


def test_trees_equal_a_plain_search():
    rows = block()
    train = np.flatnonzero(rows.roles[:, 0] == TRAIN)
    model = boosting.grow_local(rows, LAYOUT, Fit(PLAIN))
    margin = np.full(len(rows.y), rows.y[train].mean())
    errors = []
    held = rows.roles[:, 0] == VALIDATE
    trees = boosting.grow_local(rows, LAYOUT, Fit(BoostConfig(**{**PLAIN.__dict__, "patience": None}))).trees
    for tree in trees:
        want = slow_tree(train, rows.bins, rows.y - margin, PLAIN)
        got = tree.outputs(rows.bins)
        assert got[train] == pytest.approx(want[train], abs=1e-6)
        margin = margin + got
        errors.append(np.abs(rows.y[held] - margin[held]).mean())
    assert model.errors == pytest.approx(errors, abs=1e-6)
    assert len(model.trees) == int(np.argmin(errors)) + 1


def test_leaves_are_limited_best_gains_first():
    config = BoostConfig(**{**PLAIN.__dict__, "num_leaves": 3, "max_depth": 6})
    for tree in boosting.grow_local(block(), LAYOUT, Fit(config)).trees:
        assert sum(f < 0 for f in tree.feature) <= 3


@pytest.mark.parametrize("parts", [1, 4])
def test_lockstep_and_side_by_side_grow_the_same(spark, monkeypatch, parts):
    monkeypatch.setattr(boosting, "STORED_TREES", 2)
    monkeypatch.setattr(boosting, "HISTOGRAM_BYTES", 16 * 19 * 3)
    rows = block(120)
    cells = [(bytearray(b.astype("<u2").tobytes()), float(y), bytearray(r.tobytes()), int(k)) for b, y, r, k in zip(rows.bins, rows.y, rows.roles, rows.key.astype(np.int64))]
    table = spark.createDataFrame(cells, "bins binary, y double, roles binary, key long").repartition(parts).cache()
    configs = [BoostConfig(rounds=4, max_depth=2, min_rows_per_leaf=5, seed=s, patience=p, row_fraction=0.7, bagging_freq=2) for s, p in ((1, 1), (2, None))]
    fits = [Fit(c, role) for c in configs for role in (0, 1)]
    together = boosting.fit_all(table, LAYOUT, fits, task_rows=0)
    assert together == boosting.fit_all(table, LAYOUT, fits)
    assert together == [boosting.grow_local(rows, LAYOUT, f) for f in fits]


def test_a_trial_of_the_search_equals_the_same_fit_alone(spark):
    rng = random.Random(1)
    rows = [(c, day(i), rng.random(), float(10 * (i % 3)) + rng.random()) for c in ("A", "B") for i in range(120)]
    matrix = spark.createDataFrame(rows, "category string, date date, x double, ets_residual double")
    search = TuningConfig(trials=3, folds=1, min_train=90, val=20)
    space = {"max_depth": ("int", 2, 4), "learning_rate": ("log", 0.05, 0.3)}
    base = BoostConfig(rounds=10, min_rows_per_leaf=5)
    trials = tuning.tune(matrix, search, space, base).collect()
    for trial in trials:
        alone = tuning.tune(matrix, TuningConfig(trials=1, folds=1, min_train=90, val=20), {}, residual.merge_params(base, trial["params"]))
        assert alone.first()["mae"] == trial["mae"]


def test_bins(spark):
    df = spark.createDataFrame([(float(i), None if i % 5 else 1.0) for i in range(100)], "a double, b double")
    cuts = boosting.feature_cuts(df, ["a", "b"], 4)
    assert cuts == [[24.0, 49.0, 74.0], [1.0]]
    batch = pa.RecordBatch.from_pydict({"a": [0.0, 24.0, 24.5, 99.0, None], "b": [1.0, 0.0, 2.0, None, 1.0], "c": [0, 1, None, 7, 7]})
    got = boosting.binner(cuts, 8)(batch, ["a", "b"], "c").tolist()
    assert got == [[0, 0, 0], [1, 0, 0], [8, 1, 1], [7, 3, 1], [7, 3, 0]]
