"""The exponential-smoothing recursion of many series and many candidates at once.

A pair is a series with one set of parameters.  All pairs of a block step together through the
positions of their series, so the work per position is a few operations on one array.
"""

from __future__ import annotations

import itertools
from collections import deque
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd

from saleslane.config import EtsConfig


def grid(spec: EtsConfig) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Candidate parameters in lexicographic order, which is also the order of ties."""
    if spec.is_fixed:
        axes = [(spec.alpha,), (spec.beta,), (spec.gamma,), (spec.fixed_phi,)]
    else:
        axes = [spec.grid_alpha, spec.grid_beta, spec.grid_gamma, spec.grid_phi]
    return _product(spec, axes)


def grid_around(spec: EtsConfig, winner: tuple[float, float, float, float], finer: int = 1):
    """A grid around a winner, which it contains, as wide as its coarse neighbours are apart.

    Every further refinement is a third as wide and centred on the winner so far, so the search
    can leave the cell it started in; only the first and last grid points bound it.
    """
    steps = [spec.grid_alpha, spec.grid_beta, spec.grid_gamma, spec.grid_phi]
    axes = []
    for value, points in zip(winner, steps):
        below = value - max((p for p in points if p < value), default=value)
        above = min((p for p in points if p > value), default=value) - value
        reach = [-below * 2 / 3, -below / 3, 0.0, above / 3, above * 2 / 3]
        near = {min(max(value + r / 3 ** (finer - 1), min(points)), max(points)) for r in reach}
        axes.append(tuple(sorted(near | {value})))
    return _product(spec, axes)


def _product(spec: EtsConfig, axes):
    used = [True, spec.trend is not None, spec.seasonal is not None, spec.trend is not None and spec.damped]
    neutral = [None, 0.0, 0.0, 1.0]
    axes = [sorted(a) if u else (n,) for a, u, n in zip(axes, used, neutral)]
    return tuple(np.array(column) for column in zip(*itertools.product(*axes)))


def usable(spec: EtsConfig, y: np.ndarray) -> bool:
    """Whether a series spans two seasons and lacks no value, nor holds one that a multiplicative part refuses."""
    refused = y <= 0 if "mul" in (spec.trend, spec.seasonal) else False
    return len(y) >= 2 * spec.period and not bool((~np.isfinite(y) | refused).any())


#: Series times candidates that step together.
BLOCK_PAIRS = 1 << 14
#: Steps between two looks for candidates that cannot win any more.
PRUNE_STEPS = 16
#: One candidate in so many gives the first bound.
SPARSE = 16


@dataclass
class Stepped:
    """What came of each pair: the squared error (infinite if dropped or not finite) and its last state."""

    sse: np.ndarray
    level: np.ndarray
    trend: np.ndarray
    season: np.ndarray
    steps: int
    fitted: np.ndarray | None = None
    levels: np.ndarray | None = None


def step_pairs(
    spec: EtsConfig,
    values: Sequence[np.ndarray],
    series: np.ndarray,
    params: Sequence[np.ndarray],
    bounds: np.ndarray | None = None,
    record: bool = False,
) -> Stepped:
    """Advance pairs of a series and its parameters together, one position at a time.

    ``values`` are the series, of any lengths from two seasons on; pair i smooths ``values[series[i]]``.
    The sum of squares only grows, so a pair above its series' entry in ``bounds`` is dropped: it
    cannot be the winner.  ``record`` keeps all fits and levels; then pair i must be series i.
    """
    m, size = spec.period, [len(v) for v in values]
    y = np.full((max(size), len(values)), np.nan)
    for i, v in enumerate(values):
        y[: len(v), i] = v
    n_pairs = len(series)
    out = Stepped(np.full(n_pairs, np.inf), np.full(n_pairs, np.nan), np.full(n_pairs, np.nan), np.full((m, n_pairs), np.nan), 0)
    if record:
        out.fitted, out.levels = np.full(y.shape, np.nan), np.full(y.shape, np.nan)
    a, b, g, phi = params
    at, of = np.arange(n_pairs), np.asarray(series)
    first, later = sum(y[:m]) / m, sum(y[m : 2 * m]) / m
    starts = {"add": (later - first) / m, "mul": (later / first) ** (1.0 / m), None: np.zeros(len(values))}[spec.trend]
    indices = {"mul": y[:m] / first, "add": y[:m] - first, None: np.zeros((m, len(values)))}[spec.seasonal]
    level, trend, season = first[of], starts[of], indices[:, of]
    sse, ends = np.zeros(n_pairs), set(size)
    lengths = np.array(size)

    def keep(chosen: np.ndarray) -> None:
        nonlocal a, b, g, phi, at, of, level, trend, season, sse
        a, b, g, phi, at, of, level, trend, sse = (x[chosen] for x in (a, b, g, phi, at, of, level, trend, sse))
        season = season[:, chosen]

    for t in range(len(y)):
        if t in ends:
            over = lengths[of] == t
            _settle(out, at[over], level[over], trend[over], np.roll(season[:, over], -t, axis=0), sse[over])
            keep(~over)
        if bounds is not None and t % PRUNE_STEPS == 0 and t:
            alive = sse <= bounds[of]
            if alive.sum() < 0.9 * len(alive):
                keep(alive)
        if not len(at):
            return out
        now = y[t, of]
        if spec.trend == "add":
            drift = phi * trend
            base = level + drift
        elif spec.trend == "mul":
            drift = trend**phi
            base = level * drift
        else:
            drift, base = trend, level
        s = season[t % m]
        if spec.seasonal == "mul":
            fitted = base * s
            new_level = a * (now / s) + (1 - a) * base
            season[t % m] = g * (now / base) + (1 - g) * s
        elif spec.seasonal == "add":
            fitted = base + s
            new_level = a * (now - s) + (1 - a) * base
            season[t % m] = g * (now - base) + (1 - g) * s
        else:
            fitted = base
            new_level = a * now + (1 - a) * base
        if spec.trend == "add":
            trend = b * (new_level - level) + (1 - b) * drift
        elif spec.trend == "mul":
            trend = b * (new_level / level) + (1 - b) * drift
        level = new_level
        error = now - fitted
        sse = sse + error * error
        out.steps += len(at)
        if record:
            out.fitted[t, of], out.levels[t, of] = fitted, level
    _settle(out, at, level, trend, np.roll(season, -len(y), axis=0), sse)
    return out


def _settle(out: Stepped, at, level, trend, season, sse) -> None:
    out.level[at], out.trend[at], out.season[:, at] = level, trend, season
    out.sse[at] = np.where(np.isfinite(sse), sse, np.inf)


def _winners(sse: np.ndarray, of: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Each series' pair of least error, the first of equal ones, and that error; pairs are in series order."""
    order = np.lexsort((np.arange(len(sse)), sse, of))
    first = order[np.searchsorted(of[order], np.arange(n))]
    return first, sse[first]


def search(spec: EtsConfig, values: Sequence[np.ndarray], prune: bool = True) -> tuple[list[dict | None], int]:
    """Each series' state under the parameters of least squared error, and the number of steps taken.

    A sparse part of the grid gives the first bounds, then the whole grid and ever finer grids
    around each winner are stepped with candidates dropped once they exceed the best error known.
    None stands for a series without any finite error.
    """
    n, steps = len(values), 0

    def best_of(grids: list, bounds: np.ndarray | None):
        nonlocal steps
        of = np.repeat(np.arange(n), [len(x[0]) for x in grids])
        params = [np.concatenate([x[k] for x in grids]) for k in range(4)]
        done = step_pairs(spec, values, of, params, bounds if prune else None)
        steps += done.steps
        pair, sse = _winners(done.sse, of, n)
        return [p[pair] for p in params], sse

    whole = grid(spec)
    bounds = np.full(n, np.inf)
    if prune and len(whole[0]) > 2 * SPARSE:
        bounds = best_of([tuple(x[::SPARSE] for x in whole)] * n, bounds)[1]
    params, sse = best_of([whole] * n, bounds)
    if spec.refine and not spec.is_fixed:
        for finer in range(1, spec.refinements + 1):
            near = [grid_around(spec, tuple(float(p[i]) for p in params), finer) for i in range(n)]
            params, sse = best_of(near, sse)
    last = step_pairs(spec, values, np.arange(n), params)
    found = [
        {
            **{name: float(p[i]) for name, p in zip(("alpha", "beta", "gamma", "phi"), params, strict=True)},
            "level": float(last.level[i]),
            "trend": float(last.trend[i]) if spec.trend else None,
            "season": [float(x) for x in last.season[:, i]] if spec.seasonal else [],
            "sse": float(sse[i]),
        }
        if np.isfinite(sse[i])
        else None
        for i in range(n)
    ]
    return found, steps + last.steps


def _runs(batches: Iterator[pd.DataFrame], keys: Sequence[str]):
    """Cut sorted batches into ``(key, rows)`` runs; one series may span several runs."""
    for batch in batches:
        if batch.empty:
            continue
        codes = batch.groupby(list(keys), sort=False, dropna=False).ngroup().to_numpy()
        edges = [0, *(np.flatnonzero(np.diff(codes)) + 1), len(batch)]
        for start, end in zip(edges, edges[1:]):
            rows = batch.iloc[start:end]
            yield tuple(rows[k].iloc[0] for k in keys), rows


def series_runs(batches: Iterator[pd.DataFrame], keys: Sequence[str]):
    """Group the runs by series, still one batch at a time."""
    for key, runs in itertools.groupby(_runs(batches, keys), key=lambda run: run[0]):
        yield key, (rows for _, rows in runs)


def trailing_means(values: np.ndarray, m: int) -> list[float | None]:
    """Mean of the last ``m`` rows at every row, missing ones left out: the fallback fit."""
    rows: deque = deque(maxlen=m)
    out = []
    for v in values.tolist():
        rows.append(v)
        known = [x for x in rows if x == x]
        out.append(sum(known) / len(known) if known else None)
    return out
