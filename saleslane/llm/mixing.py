"""Mixing sources to target weights: raking of token weights, then sampling by calibrated chances.

Tokens (words) are counted per cell of source, language and topic.  Iterative proportional fitting
scales the cells to the target tokens of one margin after the other until all margins hold.  A
document's weight is its cell's fitted tokens over its actual ones; a single factor, found so that
the expected tokens equal the budget, turns weights into chances of at most one.  A document is
taken if a hash of its id and text, read as a number in [0, 1), is below its chance.

Targets: a margin lists shares by value.  Values that it doesn't list share what the listed ones
leave, in proportion to their tokens to the power ``temper``.  Listed values that do not occur are
ignored, and the shares of those that do are scaled to one.  The default shares of languages leave a
twentieth to unlisted and null ones; where none occurs, the listed shares are scaled to one.  If the
sweeps end before all margins hold, a warning tells the largest remaining error.

Only cells (one row per combination that occurs) take part in the fitting; documents are read once
to count and once to sample, and meet their cell in a join that needs no shuffle while the cells are
small.

Cases: nulls in source or lang are a value of their own.  A null or empty text has no tokens;
its weight is 1.  Repeated rows (same id and text) are taken or left together; a null doc_id is
treated like any other.  Extra columns of any name are kept by ``mix`` and ignored by ``plan``.  An empty
table gives no rows.  If the budget exceeds what the targets allow, every document with a weight is taken.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from saleslane.plans.durable import durable

KEYS = ("source", "lang", "topic")


@dataclass(frozen=True)
class Margin:
    shares: dict[str, float] = field(default_factory=dict)
    temper: float = 1.0


@dataclass(frozen=True)
class MixConfig:
    margins: dict[str, Margin] = field(
        default_factory=lambda: {
            "source": Margin(temper=0.7),
            "lang": Margin({"en": 0.475, "de": 0.19, "fr": 0.19, "es": 0.095}),
            "topic": Margin(temper=0.8),
        }
    )
    #: Expected tokens of the sample, as a share of all.
    budget: float = 0.6
    seed: int = 17
    tolerance: float = 1e-9
    #: Sweeps over all margins at most; each block of sweeps is stored.
    sweeps: int = 60
    block: int = 3


def tokens_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def topic_of(text: Column) -> Column:
    """A plain topic by form: tables, licence notices, shouting, marked words, else prose by length."""
    text = F.coalesce(text, F.lit(""))
    return (
        F.when(F.contains(text, F.lit(" | ")), "table")
        .when(F.contains(F.lower(text), F.lit("license")), "notice")
        .when(F.contains(text, F.lit("!! ")), "shouting")
        .when(text.rlike("[#*$%&]{3}"), "marked")
        .when(F.length(text) < 500, "short")
        .when(F.length(text) < 5000, "prose")
        .otherwise("long")
    )


def _value(column: str) -> Column:
    """A value that tells null from any text."""
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit(""))


def _with_cells(docs: DataFrame) -> DataFrame:
    """The documents as one column ``row``, so that no name of theirs meets the added columns."""
    return docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
        _value("source").alias("mix_source"),
        _value("lang").alias("mix_lang"),
        topic_of(F.col("text")).alias("mix_topic"),
        tokens_of(F.col("text")).alias("mix_tokens"),
    )


def _target(key: str, margin: Margin) -> Column:
    """Target tokens of a cell's value in one margin; the same for all cells of the value."""
    name = F.substring(f"mix_{key}", 2, 1 << 20) if key != "topic" else F.col("mix_topic")
    value = Window.partitionBy(f"mix_{key}")
    listed = reduce(lambda c, x: c.when(name == x[0], x[1]), margin.shares.items(), F.when(F.lit(False), 0.0))
    own = F.sum("tokens").over(value)
    # A value's power is spread over its cells, so that sums over all cells count it once.
    rest = F.when(listed.isNull(), F.pow(own, F.lit(margin.temper)) * F.col("tokens") / own)
    left = max(0.0, 1.0 - sum(margin.shares.values()))
    return F.struct(listed.alias("listed"), rest.alias("rest"), F.lit(left).alias("left"), (F.col("tokens") / own).alias("part"))


def fit_cells(cells: DataFrame, config: MixConfig = MixConfig()) -> DataFrame:
    """Cells (mix_source, mix_lang, mix_topic, tokens) with their fitted tokens ``fitted``."""
    keys = [f"mix_{k}" for k in KEYS]
    state = cells.filter("tokens > 0")
    for k in KEYS:
        state = state.withColumn(f"t_{k}", _target(k, config.margins.get(k, Margin())))
    state = durable(state)
    # One row of sums: what listed values and the others come to in each margin.
    sums = state.agg(
        F.sum("tokens").alias("all"),
        *(F.sum(F.col(f"t_{k}.listed") * F.col(f"t_{k}.part")).alias(f"listed_{k}") for k in KEYS),
        *(F.sum(f"t_{k}.rest").alias(f"rest_{k}") for k in KEYS),
    ).first()
    for k in KEYS:
        listed, rest = sums[f"listed_{k}"] or 0.0, sums[f"rest_{k}"] or 0.0
        left = F.col(f"t_{k}.left") if rest else F.lit(0.0)
        whole = listed + max(0.0, 1.0 - sum(config.margins.get(k, Margin()).shares.values())) * bool(rest)
        value = Window.partitionBy(f"mix_{k}")
        share = F.coalesce(F.col(f"t_{k}.listed"), left * F.sum(f"t_{k}.rest").over(value) / F.lit(rest or 1.0))
        state = state.withColumn(f"t_{k}", F.lit(float(sums["all"] or 0)) * share / F.lit(whole or 1.0))
    state = durable(state.withColumn("fitted", F.col("tokens").cast("double")))
    largest = 0.0
    for _ in range(0, config.sweeps, config.block):
        for _ in range(config.block):
            for k in KEYS:
                now = F.sum("fitted").over(Window.partitionBy(f"mix_{k}"))
                state = state.withColumn("fitted", F.when(now > 0, F.col("fitted") * F.col(f"t_{k}") / now).otherwise(0.0))
        state = durable(state)
        error = [
            state.groupBy(f"mix_{k}").agg((F.abs(F.sum("fitted") - F.first(f"t_{k}")) / F.greatest(F.first(f"t_{k}"), F.lit(1.0))).alias("e"))
            for k in KEYS
        ]
        largest = reduce(DataFrame.union, (e.select("e") for e in error)).agg(F.max("e")).first()[0] or 0.0
        if largest <= config.tolerance:
            break
    else:
        warnings.warn(f"after {config.sweeps} sweeps a margin is still off by {largest:.3g} of its target", stacklevel=2)
    return state.select(*keys, "tokens", "fitted")


def _factor(cells: DataFrame, budget: float) -> float | None:
    """c with sum(tokens * min(1, c * weight)) = budget; None if even chances of one stay below it."""
    weight = F.col("fitted") / F.col("tokens")
    most = cells.filter("fitted > 0").agg(F.sum("tokens").alias("t"), F.max(1 / weight).alias("c")).first()
    if most["t"] is None or most["t"] <= budget:
        return None
    low, high, steps = 0.0, most["c"], 16
    for _ in range(12):
        tries = [low + (high - low) * i / steps for i in range(1, steps)]
        row = cells.agg(*(F.sum(F.col("tokens") * F.least(F.lit(1.0), c * weight)) for c in tries)).first()
        low = max([low, *(c for c, x in zip(tries, row, strict=True) if x <= budget)])
        high = min([high, *(c for c, x in zip(tries, row, strict=True) if x > budget)])
    return (low + high) / 2


def _planned(docs: DataFrame, config: MixConfig) -> DataFrame:
    """The documents as ``row`` with the mix_ columns: cell, tokens, weight, chance and whether they are taken."""
    keys = [f"mix_{k}" for k in KEYS]
    placed = _with_cells(docs)
    cells = durable(placed.groupBy(*keys).agg(F.sum("mix_tokens").alias("tokens")))
    fitted = fit_cells(cells, config)
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    factor = _factor(fitted, config.budget * total)
    weights = durable(fitted.select(*keys, (F.col("fitted") / F.col("tokens")).alias("mix_weight")))
    joined = placed.join(weights, keys, "left").withColumn("mix_weight", F.coalesce("mix_weight", F.lit(1.0)))
    chance = F.when(F.col("mix_weight") > 0, 1.0).otherwise(0.0) if factor is None else F.least(F.lit(1.0), F.col("mix_weight") * factor)
    place = F.shiftrightunsigned(F.xxhash64("row.doc_id", "row.text", F.lit(config.seed)), 11) / F.lit(float(1 << 53))
    return joined.withColumn("mix_chance", chance).withColumn("mix_taken", place < F.col("mix_chance"))


def plan(docs: DataFrame, config: MixConfig = MixConfig()) -> DataFrame:
    """Per row: doc_id, source, lang, topic, n_tokens, weight, chance, taken."""
    return _planned(docs.select("doc_id", "text", "lang", "source"), config).select(
        "row.doc_id",
        "row.source",
        "row.lang",
        F.col("mix_topic").alias("topic"),
        F.col("mix_tokens").alias("n_tokens"),
        F.col("mix_weight").alias("weight"),
        F.col("mix_chance").alias("chance"),
        F.col("mix_taken").alias("taken"),
    )


def mix(docs: DataFrame, config: MixConfig = MixConfig()) -> DataFrame:
    """The rows of docs that are taken, with all their columns."""
    return _planned(docs, config).filter("mix_taken").select("row.*")
