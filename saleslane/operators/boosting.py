"""Histogram gradient boosting of many models over one binned table.

The rows are binned once.  A model is grown by a generator, which asks for sums over its rows and is
sent the answers: the total of its target, the best split of each open node of a level, the
error of a finished tree.  Two ways of answering give the same model, bit for bit, because all sums are
of integers (targets as multiples of one small unit), whatever the partitions and their order:

* Up to ``TASK_ROWS`` rows, a bound that is checked on the stored table, the binned rows are broadcast
  and every model is grown in a task of its own, so a search runs its fits side by side.
* Beyond it the rows stay where they are.  All models go on in lockstep, level by level: one job
  adds up the histograms of all open nodes of all models per task, a shuffle brings the parts of
  a node together and finds its best split, and only splits come back.  Margins of the finished trees
  are stored with the rows every ``STORED_TREES`` trees, so no plan and no replay grows long.

Trees grow level by level, best gains first, up to a number of leaves.  The first feature is nominal:
its bins are ordered by their mean residual in the node and a prefix goes left.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Generator, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleslane.config import BoostConfig
from saleslane.plans.durable import durable

#: Rows that one task may hold, about 100 bytes each.
TASK_ROWS = 200_000
#: Trees whose margins are replayed before they are stored with the rows.
STORED_TREES = 16
#: Bytes of histograms that one task may hold; more open nodes take several jobs.
HISTOGRAM_BYTES = 64 << 20
#: Rows that a nominal bin's mean is drawn towards zero by.
NOMINAL_SMOOTHING = 10.0
TRAIN, VALIDATE = 1, 2
_MIX = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Layout:
    """Bins of each feature; feature 0 is nominal and its last bin holds unknown values."""

    sizes: tuple[int, ...]
    unit: float

    @property
    def starts(self) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(self.sizes)]).astype(np.int64)


@dataclass
class Tree:
    """Nodes in the order in which they were made; a leaf has feature -1."""

    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    codes: list[list[int]] = field(default_factory=lambda: [[]])
    left: list[int] = field(default_factory=lambda: [0])
    right: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])
    gain: list[float] = field(default_factory=lambda: [0.0])
    depth: list[int] = field(default_factory=lambda: [0])

    def grow(self, node: int, split: Split, values: tuple[float, float]) -> tuple[int, int]:
        kids = len(self.feature), len(self.feature) + 1
        self.feature[node], self.cut[node], self.codes[node] = split.feature, split.cut, split.codes
        self.left[node], self.right[node] = kids
        self.gain[node] = split.gain
        for value in values:
            for name, new in (("feature", -1), ("cut", 0), ("codes", []), ("left", 0), ("right", 0), ("value", value), ("gain", 0.0)):
                getattr(self, name).append(new)
            self.depth.append(self.depth[node] + 1)
        return kids

    def place(self, bins: np.ndarray) -> np.ndarray:
        """The node that each row of bins (rows, features) ends in."""
        feature, cut = np.array(self.feature), np.array(self.cut)
        left, right = np.array(self.left), np.array(self.right)
        goes_left = np.zeros((len(feature), int(bins[:, 0].max(initial=0)) + 1), dtype=bool)
        for node, codes in enumerate(self.codes):
            goes_left[node, [c for c in codes if c < goes_left.shape[1]]] = True
        node, rows = np.zeros(len(bins), dtype=np.int64), np.arange(len(bins))
        for _ in range(max(self.depth)):
            at = feature[node]
            seen = bins[rows, np.maximum(at, 0)]
            chosen = np.where(at == 0, goes_left[node, bins[:, 0]], seen <= cut[node])
            node = np.where(at < 0, node, np.where(chosen, left[node], right[node]))
        return node

    def outputs(self, bins: np.ndarray) -> np.ndarray:
        return np.array(self.value)[self.place(bins)]


@dataclass(frozen=True)
class Split:
    """A node's best split, with sum (in units) and rows of its left side."""

    gain: float
    feature: int
    cut: int
    codes: list[int]
    left_sum: float
    left_rows: int


@dataclass(frozen=True)
class Fit:
    """What to grow: parameters, and the place of the rows' role in their array of roles."""

    config: BoostConfig
    role: int = 0


@dataclass
class Grown:
    """A finished fit: the trees up to the best round, and the validation error of every round."""

    start: float
    trees: list[Tree]
    errors: list[float]

    @property
    def mae(self) -> float | None:
        return self.errors[len(self.trees) - 1] if self.errors else None

    def dump(self) -> str:
        return json.dumps([self.start, [vars(t) for t in self.trees], self.errors])

    @staticmethod
    def load(text: str) -> Grown:
        start, trees, errors = json.loads(text)
        return Grown(start, [Tree(**t) for t in trees], errors)


# ---------------------------------------------------------------------------------------
# Growing one model


def _pulled(total: np.ndarray | float, l1: float) -> np.ndarray | float:
    return np.sign(total) * np.maximum(np.abs(total) - l1, 0.0)


def _worth(total: np.ndarray, rows: np.ndarray, config: BoostConfig) -> np.ndarray:
    return _pulled(total, config.lambda_l1) ** 2 / np.maximum(rows + config.lambda_l2, 1e-12)


def _value(total: float, rows: float, config: BoostConfig) -> float:
    return float(config.learning_rate * _pulled(total, config.lambda_l1) / max(rows + config.lambda_l2, 1e-12))


def chosen_features(config: BoostConfig, tree: int, features: int) -> np.ndarray:
    """The features that a tree may split on."""
    number = max(1, round(config.feature_fraction * features))
    return np.sort(np.random.default_rng([config.seed, tree]).permutation(features)[:number])


def best_split(sums: np.ndarray, rows: np.ndarray, layout: Layout, config: BoostConfig, features: np.ndarray) -> Split | None:
    """The split of largest gain of one node, from sums (in units) and rows per bin; ties go to the first."""
    starts, best = layout.starts, None
    whole, n = sums[: starts[1]].sum(), rows[: starts[1]].sum()
    parent = _worth(whole * layout.unit, n, config)
    numeric = features[features > 0]
    found = []
    if len(numeric):
        # Numeric features have equally many places in the layout, padded with empty bins.
        width = max(layout.sizes[1:])
        at = starts[numeric][:, None] + np.arange(width)
        inside = np.arange(width) < np.array(layout.sizes)[numeric][:, None]
        at = np.where(inside, at, 0)
        left = np.cumsum(np.where(inside, sums[at], 0.0), axis=1)
        seen = np.cumsum(np.where(inside, rows[at], 0), axis=1)
        found.append((numeric, left, seen, None))
    if features[0] == 0:
        present = np.flatnonzero(rows[: layout.sizes[0] - 1])
        if len(present) > 1:
            mean = sums[present] / (rows[present] + NOMINAL_SMOOTHING)
            order = present[np.lexsort((present, mean))]
            found.insert(0, (features[:1], np.cumsum(sums[order])[None], np.cumsum(rows[order])[None], order))
    for which, left, seen, order in found:
        rest = n - seen
        gain = _worth(left * layout.unit, seen, config) + _worth((whole - left) * layout.unit, rest, config) - parent
        gain = np.where((seen >= config.min_rows_per_leaf) & (rest >= config.min_rows_per_leaf), gain, -np.inf)
        i, b = np.unravel_index(int(np.argmax(gain)), gain.shape)
        if gain[i, b] > max(config.min_gain, 1e-12) and (best is None or gain[i, b] > best.gain):
            codes = [] if order is None else sorted(int(c) for c in order[: b + 1])
            best = Split(float(gain[i, b]), int(which[i]), int(b), codes, float(left[i, b]), int(seen[i, b]))
    return best


def best_round(errors: list[float], patience: int | None) -> int:
    """1-based round with the least error seen before ``patience`` rounds without a gain."""
    best = 0
    for i, error in enumerate(errors):
        if error < errors[best]:
            best = i
        elif patience is not None and i - best >= patience:
            break
    return best + 1


def growing(fit: Fit, layout: Layout) -> Generator[tuple, object, Grown]:
    """Grow a model.

    Asks ("total",) for (sum, rows) of the training targets, ("best", tree, nodes) for each open
    node's (sum, rows, split), and ("grown", tree) for (sum of absolute errors, rows) of the validation rows.
    """
    config, unit = fit.config, layout.unit
    total, n = yield ("total",)
    model = Grown(total * unit / n if n else 0.0, [], [])
    yield ("start", model.start)
    while len(model.trees) < config.rounds:
        tree, open_nodes, leaves = Tree(), [0], 1
        while open_nodes:
            answers = yield ("best", tree, open_nodes)
            wanted = sorted(
                ((node, answer) for node, answer in zip(open_nodes, answers, strict=True) if answer[2] is not None),
                key=lambda x: (-x[1][2].gain, x[0]),
            )
            grown = []
            for node, (whole, rows, split) in wanted[: max(0, config.num_leaves - leaves)]:
                parts = (split.left_sum, split.left_rows), (whole - split.left_sum, rows - split.left_rows)
                grown.append((node, split, tuple(_value(s * unit, k, config) for s, k in parts)))
            open_nodes = []
            for node, split, values in sorted(grown, key=lambda x: x[0]):
                open_nodes += tree.grow(node, split, values)
            leaves += len(grown)
            if open_nodes and tree.depth[open_nodes[0]] >= config.max_depth:
                open_nodes = []
        if len(tree.feature) == 1 and config.row_fraction >= 1.0 and config.feature_fraction >= 1.0:
            # Nothing can be split, and no later sample will differ.
            break
        wrong, rows = yield ("grown", tree)
        model.trees.append(tree)
        if rows:
            model.errors.append(wrong * unit / rows)
            if config.patience is not None and len(model.trees) - best_round(model.errors, None) >= config.patience:
                break
    if model.errors:
        model.trees = model.trees[: best_round(model.errors, config.patience)]
    return model


# ---------------------------------------------------------------------------------------
# Answers from a block of rows


class Block:
    """Binned rows: ``bins`` (rows, features), target, roles (rows, folds) and a hash of each row."""

    def __init__(self, bins: np.ndarray, y: np.ndarray, roles: np.ndarray, key: np.ndarray):
        self.bins, self.y, self.roles, self.key = bins, y, roles, key

    @staticmethod
    def of(batch: pa.RecordBatch | pa.Table) -> Block:
        def matrix(name: str, kind: str) -> np.ndarray:
            cells = batch.column(name).to_pylist()
            return np.frombuffer(b"".join(cells), dtype=kind).reshape(len(cells), -1) if cells else np.zeros((0, 1), kind)

        y = np.asarray(batch.column("y").to_numpy(zero_copy_only=False) if isinstance(batch, pa.RecordBatch) else batch.column("y").to_numpy())
        key = batch.column("key")
        key = np.asarray(key.to_numpy(zero_copy_only=False) if isinstance(batch, pa.RecordBatch) else key.to_numpy())
        return Block(matrix("bins", "<u2").astype(np.int64), y.astype(float), matrix("roles", "<u1"), key.astype(np.int64).view(np.uint64))


def _sampled(key: np.ndarray, config: BoostConfig, tree: int) -> np.ndarray:
    """The training rows of a tree; drawn anew every ``bagging_freq`` trees, by a hash of the row."""
    if config.row_fraction >= 1.0:
        return np.ones(len(key), dtype=bool)
    draw = (config.seed * 1_000_003 + tree // max(1, config.bagging_freq)) * int(_MIX) % (1 << 64)
    x = (key ^ np.uint64(draw)) * _MIX
    x = (x ^ (x >> np.uint64(32))) * _MIX
    return (x >> np.uint64(11)).astype(float) / float(1 << 53) < config.row_fraction


def _in_units(x: np.ndarray, unit: float) -> np.ndarray:
    return np.rint(x / unit)


def histograms(index: np.ndarray, rank: np.ndarray, residual: np.ndarray, nodes: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums and rows per node (by rank) and place of the layout."""
    place = (rank[:, None] * width + index).ravel()
    sums = np.bincount(place, weights=np.repeat(residual, index.shape[1]), minlength=nodes * width)
    return sums.reshape(nodes, width), np.bincount(place, minlength=nodes * width).reshape(nodes, width)


class LocalRows:
    """Answers for one fit from one block, with margins, nodes and parents' histograms at hand."""

    def __init__(self, block: Block, layout: Layout, fit: Fit):
        used = np.flatnonzero(block.roles[:, fit.role])
        role = block.roles[used, fit.role]
        self.train, self.held = used[role == TRAIN], used[role == VALIDATE]
        self.block, self.layout, self.fit, self.trees = block, layout, fit, 0
        self.index = block.bins + layout.starts[:-1]

    def answer(self, request: tuple) -> object:
        return getattr(self, f"_{request[0]}")(*request[1:])

    def _total(self) -> tuple[float, int]:
        return float(_in_units(self.block.y[self.train], self.layout.unit).sum()), len(self.train)

    def _start(self, start: float) -> None:
        self.margin = np.full(len(self.block.y), start)

    def _best(self, tree: Tree, nodes: list[int]) -> list[tuple]:
        width = int(self.layout.starts[-1])
        if nodes == [0]:
            picked = self.train[_sampled(self.block.key[self.train], self.fit.config, self.trees)]
            self.rows, self.parents = picked, {}
            self.residual = _in_units(self.block.y[picked] - self.margin[picked], self.layout.unit)
            self.node = np.zeros(len(picked), dtype=np.int64)
            self.features = chosen_features(self.fit.config, self.trees, len(self.layout.sizes))
            found = {0: histograms(self.index[picked], self.node, self.residual, 1, width)}
            found = {0: (found[0][0][0], found[0][1][0])}
        else:
            self.node = tree.place(self.block.bins[self.rows])
            size = np.bincount(self.node, minlength=len(tree.feature))
            above = {kid: (p, other) for p, (a, b) in enumerate(zip(tree.left, tree.right, strict=True)) if a for kid, other in ((a, b), (b, a))}
            # Of two siblings the one with fewer rows is summed; the other is what the parent leaves.
            small = [k for k in nodes if (size[k], k) < (size[above[k][1]], above[k][1])]
            rank = np.full(len(tree.feature), -1)
            rank[small] = np.arange(len(small))
            mine = np.flatnonzero(rank[self.node] >= 0)
            sums, counts = histograms(self.index[self.rows[mine]], rank[self.node[mine]], self.residual[mine], len(small), width)
            found = {k: (sums[i], counts[i]) for i, k in enumerate(small)}
            for k in small:
                parent, other = above[k]
                found[other] = tuple(p - s for p, s in zip(self.parents[parent], found[k], strict=True))
        self.parents = found
        first = self.layout.sizes[0]
        return [(float(s[:first].sum()), int(c[:first].sum()), best_split(s, c, self.layout, self.fit.config, self.features)) for s, c in (found[k] for k in nodes)]

    def _grown(self, tree: Tree) -> tuple[float, int]:
        self.trees += 1
        used = np.concatenate([self.train, self.held])
        self.margin[used] += tree.outputs(self.block.bins[used])
        wrong = np.abs(self.block.y[self.held] - self.margin[self.held])
        return float(_in_units(wrong, self.layout.unit).sum()), len(self.held)


def grow_local(block: Block, layout: Layout, fit: Fit) -> Grown:
    rows, grower = LocalRows(block, layout, fit), growing(fit, layout)
    request = next(grower)
    while True:
        try:
            request = grower.send(rows.answer(request))
        except StopIteration as done:
            return done.value


# ---------------------------------------------------------------------------------------
# Growing many models


def fit_all(rows: DataFrame, layout: Layout, fits: list[Fit], task_rows: int = TASK_ROWS) -> list[Grown]:
    """Grow all fits over stored rows (bins, y, roles, key)."""
    if not fits:
        return []
    return _side_by_side(rows, layout, fits) if rows.count() <= task_rows else _in_lockstep(rows, layout, fits)


def _side_by_side(rows: DataFrame, layout: Layout, fits: list[Fit]) -> list[Grown]:
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast((rows.select("bins", "y", "roles", "key").toArrow(), layout, fits))

    def grown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, where, jobs = shared.value
        block = Block.of(table)
        for batch in batches:
            for number in batch.column("id").to_pylist():
                model = grow_local(block, where, jobs[number]).dump()
                yield pa.RecordBatch.from_arrays([pa.array([number]), pa.array([model])], names=["id", "model"])

    try:
        done = spark.range(len(fits), numPartitions=len(fits)).mapInArrow(grown, "id long, model string").collect()
    finally:
        shared.unpersist()
    return [Grown.load(r["model"]) for r in sorted(done, key=lambda r: r["id"])]


@dataclass
class _State:
    """What tasks must know of a fit: the trees whose margins are not stored yet, and its request."""

    fit: Fit
    start: float | None = None
    trees: list[Tree] = field(default_factory=list)
    finished: int = 0
    request: tuple = ()


def _in_lockstep(rows: DataFrame, layout: Layout, fits: list[Fit]) -> list[Grown]:
    table = rows.select("bins", "y", "roles", "key", F.lit(None).cast("binary").alias("margins"))
    growers = {i: growing(fit, layout) for i, fit in enumerate(fits)}
    states = {i: _State(fit) for i, fit in enumerate(fits)}
    done: dict[int, Grown] = {}
    for i, grower in growers.items():
        states[i].request = next(grower)
    while growers:
        answers = _answers(table, layout, {i: states[i] for i in growers}, len(fits))
        for i in list(growers):
            state, request = states[i], states[i].request
            if request[0] == "grown":
                state.trees.append(request[1])
                state.finished += 1
            try:
                state.request = growers[i].send(answers[i])
                if state.request[0] == "start":
                    state.start = state.request[1]
                    state.request = growers[i].send(None)
            except StopIteration as finished:
                done[i] = finished.value
                del growers[i]
        if growers and max(len(states[i].trees) for i in growers) >= STORED_TREES:
            table = _with_margins(table, {i: states[i] for i in growers}, len(fits))
            for i in growers:
                states[i].trees = []
    return [done[i] for i in range(len(fits))]


def _margins(block: Block, stored: list[bytes | None], states: dict[int, _State], n_fits: int) -> dict[int, np.ndarray]:
    """Each fit's margin of every row: the stored one plus the trees since."""
    empty = np.full(n_fits, np.nan).tobytes()
    kept = np.frombuffer(b"".join(x if x is not None else empty for x in stored), dtype=float).reshape(-1, n_fits)
    out = {}
    for i, state in states.items():
        if state.start is None:
            continue
        margin = np.where(np.isnan(kept[:, i]), state.start, kept[:, i])
        for tree in state.trees:
            margin = margin + tree.outputs(block.bins)
        out[i] = margin
    return out


def _with_margins(table: DataFrame, states: dict[int, _State], n_fits: int) -> DataFrame:
    shared = table.sparkSession.sparkContext.broadcast(states)

    def stored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block = Block.of(batch)
            kept = np.full((len(block.y), n_fits), np.nan)
            for i, margin in _margins(block, batch.column("margins").to_pylist(), shared.value, n_fits).items():
                kept[:, i] = margin
            cells = pa.array([row.tobytes() for row in kept], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], cells], names=batch.schema.names)

    return durable(table.mapInArrow(stored, table.schema))


def _parts(block: Block, layout: Layout, state: _State, margin: np.ndarray | None) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """A block's share of the answer to a fit's request: (sums, rows) by node."""
    kind, config = state.request[0], state.fit.config
    role = block.roles[:, state.fit.role]
    if kind == "total":
        train = role == TRAIN
        return {0: (_in_units(block.y[train], layout.unit).sum(keepdims=True), np.array([train.sum()]))}
    tree = state.request[1]
    if kind == "grown":
        held = role == VALIDATE
        wrong = np.abs(block.y[held] - (margin[held] + tree.outputs(block.bins[held])))
        return {0: (_in_units(wrong, layout.unit).sum(keepdims=True), np.array([held.sum()]))}
    picked = np.flatnonzero((role == TRAIN) & _sampled(block.key, config, state.finished))
    node = tree.place(block.bins[picked])
    rank = np.full(len(tree.feature), -1)
    rank[state.request[2]] = np.arange(len(state.request[2]))
    mine = rank[node] >= 0
    picked, node = picked[mine], node[mine]
    residual = _in_units(block.y[picked] - margin[picked], layout.unit)
    sums, counts = histograms(block.bins[picked] + layout.starts[:-1], rank[node], residual, len(state.request[2]), int(layout.starts[-1]))
    return {k: (sums[r], counts[r]) for r, k in enumerate(state.request[2])}


def _answers(table: DataFrame, layout: Layout, states: dict[int, _State], n_fits: int) -> dict[int, object]:
    """Answers to the requests of all fits; one job, or several if the histograms are large."""
    room = max(1, HISTOGRAM_BYTES // (16 * int(layout.starts[-1])))
    groups, size = [{}], 0
    for i, state in states.items():
        need = len(state.request[2]) if state.request[0] == "best" else 1
        if groups[-1] and size + need > room:
            groups.append({})
            size = 0
        groups[-1][i] = state
        size += need
    found: dict[tuple[int, int], tuple] = {}
    for group in groups:
        found |= _summed(table, layout, group, n_fits)
    out = {}
    for i, state in states.items():
        if state.request[0] == "best":
            out[i] = [found.get((i, k), (0.0, 0, None)) for k in state.request[2]]
        else:
            out[i] = found.get((i, 0), (0.0, 0))[:2]
    return out


def _summed(table: DataFrame, layout: Layout, states: dict[int, _State], n_fits: int) -> dict[tuple[int, int], tuple]:
    shared = table.sparkSession.sparkContext.broadcast((layout, states))

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, jobs = shared.value
        total: dict[tuple[int, int], list[np.ndarray]] = {}
        for batch in batches:
            block = Block.of(batch)
            margins = _margins(block, batch.column("margins").to_pylist(), jobs, n_fits)
            for i, state in jobs.items():
                for node, (sums, rows) in _parts(block, where, state, margins.get(i)).items():
                    kept = total.setdefault((i, node), [np.zeros(len(sums)), np.zeros(len(rows))])
                    kept[0] += sums
                    kept[1] += rows
        for (i, node), (sums, rows) in total.items():
            cells = [[i], [node], [sums.tobytes()], [rows.tobytes()]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cells], names=["fit", "node", "sums", "rows"])

    def splits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, jobs = shared.value
        now, sums, rows = None, None, None

        def finished() -> pa.RecordBatch:
            state = jobs[now[0]]
            split = None
            if state.request[0] == "best":
                features = chosen_features(state.fit.config, state.finished, len(where.sizes))
                split = best_split(sums, rows, where, state.fit.config, features)
            first = where.sizes[0] if state.request[0] == "best" else 1
            answer = [float(sums[:first].sum()), int(rows[:first].sum()), None if split is None else vars(split)]
            cells = [[now[0]], [now[1]], [json.dumps(answer)]]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in cells], names=["fit", "node", "answer"])

        for batch in batches:
            for fit, node, s, r in zip(*(batch.column(c).to_pylist() for c in ("fit", "node", "sums", "rows")), strict=True):
                s, r = np.frombuffer(s), np.frombuffer(r)
                if (fit, node) == now:
                    sums, rows = sums + s, rows + r
                    continue
                if now is not None:
                    yield finished()
                now, sums, rows = (fit, node), s, r
        if now is not None:
            yield finished()

    found = table.mapInArrow(parts, "fit long, node long, sums binary, rows binary")
    found = found.repartition("fit", "node").sortWithinPartitions("fit", "node")
    answers = found.mapInArrow(splits, "fit long, node long, answer string").collect()
    shared.unpersist()

    def split(x: dict | None) -> Split | None:
        return None if x is None else Split(**x)

    return {(r["fit"], r["node"]): (a[0], a[1], split(a[2])) for r in answers for a in [json.loads(r["answer"])]}


# ---------------------------------------------------------------------------------------
# Binning


def binner(cuts: list[list[float]], n_codes: int) -> Callable[[pa.RecordBatch, list[str], str], np.ndarray]:
    """Bins of a batch: the nominal code first, then each numeric feature's place among its cuts.

    Missing numbers fall in the last bin, unknown codes in the last nominal one.
    """
    edges = [np.array(c, dtype=float) for c in cuts]

    def bins(batch: pa.RecordBatch, features: list[str], code: str) -> np.ndarray:
        out = np.empty((batch.num_rows, len(features) + 1), dtype="<u2")
        known = batch.column(code).cast(pa.float64()).to_numpy(zero_copy_only=False)
        out[:, 0] = np.where(np.isnan(known), n_codes, np.nan_to_num(known))
        for k, name in enumerate(features):
            values = batch.column(name).cast(pa.float64()).to_numpy(zero_copy_only=False)
            out[:, k + 1] = np.searchsorted(edges[k], values, side="left")
        return out

    return bins


def feature_cuts(rows: DataFrame, features: list[str], max_bins: int) -> list[list[float]]:
    """At most ``max_bins`` - 1 cuts of each feature at its quantiles; one pass for all features."""
    shares = F.array(*(F.lit(i / max_bins) for i in range(1, max_bins)))
    number = [F.percentile_approx(F.col(f"`{c}`").cast("double"), shares, F.lit(10_000)).alias(f"c{k}") for k, c in enumerate(features)]
    found = rows.agg(*number).first() if number else []
    return [sorted({float(x) for x in (cuts or []) if x == x}) for cuts in found]


def unit_of(rows: DataFrame, y: str) -> tuple[float, int]:
    """A power of two so small that targets lose nothing that matters and sums of all rows stay exact."""
    most, n = rows.agg(F.max(F.abs(F.col(y))), F.count(F.lit(1))).first()
    if not most:
        return 2.0**-30, int(n)
    # Residuals stay within a few times the largest target; 53 bits hold the sum of all of them.
    bits = min(40, 50 - max(1, int(n)).bit_length())
    return 2.0 ** (np.ceil(np.log2(most)) - bits), int(n)

