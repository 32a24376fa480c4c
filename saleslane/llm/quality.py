"""Quality rules: fixed counts of a text, and a calibrated classifier over hashed n-grams.

The classifier is a logistic regression over hashed word n-grams (1, 2) and character n-grams (3 to
5 bytes of UTF-8), trained by Spark on labelled rows.  The margins of labelled rows kept out of the
fit calibrate it to the share of good rows among all labels.  Every text is scored whole, in Arrow
batches, and kept if the rules pass it and its probability reaches a fixed threshold.

Fit bound: at most ``QualityConfig.rows_per_class`` labelled rows of either class (those with the
smallest hash of their id) train and calibrate the model; the counts of labels cover all rows.

Cases: a null text has no words; fewer than 50 words fail the rules.  Labels that are null are
skipped; of differing labels for one id the lowest counts, and of its differing texts one is fitted.  Without rows of both classes the rules
decide alone and the probability is null.  Repeated rows are judged alike, one output row each.  A
null doc_id is kept and never labelled.  Extra columns are ignored.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleslane.llm import linear
from saleslane.llm.blocks import Block, RangeHash, blocks, in_parts, mix, texts_of
from saleslane.plans.durable import durable


@dataclass(frozen=True)
class QualityConfig:
    min_words: int = 50
    max_repeat_percent: int = 50
    threshold: float = 0.5
    dims: int = 1 << 16
    word_orders: tuple[int, ...] = (1, 2)
    char_orders: tuple[int, ...] = (3, 4, 5)
    rows_per_class: int = 2000
    reg: float = 1e-4
    #: One labelled row in this many calibrates instead of training.
    folds: int = 4


@dataclass(frozen=True)
class QualityModel:
    weights: np.ndarray
    bias: float
    slope: float
    shift: float


_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def _new_in_doc(key: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """Distinct keys per document."""
    return np.bincount(doc[np.unique(key, return_index=True)[1]], minlength=n)


def counts(block: Block) -> dict[str, np.ndarray]:
    """The base counts of a block's documents."""
    n, data = len(block.starts), block.data
    start, end, doc = block.words()
    ranges = RangeHash(data)
    whole = (data & 0xC0) != 0x80
    inside = np.zeros(len(data) + 1, dtype=np.int64)
    edge = np.zeros(len(data) + 1, dtype=np.int8)
    edge[start] += 1
    edge[end] -= 1
    in_word = np.cumsum(edge[:-1], dtype=np.int8).astype(bool)
    np.cumsum(whole & in_word, out=inside[1:])
    salt = np.arange(n, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407)

    line_end = np.flatnonzero(data == 0x0A)
    line_start = np.concatenate([[0], line_end[:-1] + 1])
    full = inside[line_end] > inside[line_start]
    line_start, line_end = line_start[full], line_end[full]
    line_doc = np.searchsorted(block.starts, line_start, side="right") - 1
    line = mix(ranges.of(line_start, line_end) + salt[line_doc])
    duplicates = np.bincount(line_doc, minlength=n) - _new_in_doc(line, line_doc, n)

    word = ranges.of(start, end)
    m = max(0, len(word) - 2)
    gram = mix(mix(mix(word[:m] + salt[doc[:m]]) + word[1 : 1 + m]) + word[2 : 2 + m])
    same = doc[:m] == doc[2 : 2 + m]
    _, place, times = np.unique(gram[same], return_inverse=True, return_counts=True)
    again = np.flatnonzero(same)[times[place] > 1]
    repeated = np.zeros(len(word), dtype=bool)
    for k in range(3):
        repeated[again + k] = True
    return {
        "n_words": np.bincount(doc, minlength=n),
        "word_chars": inside[block.ends] - inside[block.starts],
        "n_symbols": block.count(_SYMBOL[data]),
        "n_dup_lines": duplicates,
        "n_repeat_words": np.bincount(doc[repeated], minlength=n),
    }


def _kinds(block: Block, config: QualityConfig) -> list[tuple[np.ndarray, np.ndarray]]:
    words, doc = linear.word_hashes(block)
    return [
        linear.char_grams(block, config.char_orders, config.dims),
        linear.word_grams(words, doc, config.word_orders, config.dims),
    ]


def _featurise(config: QualityConfig):
    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches):
            for block in blocks(texts_of(batch.column("text"))):
                n = len(block.starts)
                own = batch.slice(block.first, n)
                rows = linear.sparse_rows(_kinds(block, config), n, config.dims)
                yield linear.feature_batch([own.column("label"), own.column("fold")], ["label", "fold"], rows, config.dims)

    return features


def training_rows(docs: DataFrame, labels: DataFrame, name: str, per_class: int, folds: int) -> tuple[DataFrame, dict[int, int]]:
    """Labelled (text, label, fold) rows, bounded per class, and the count of all labels by class."""
    known = (
        labels.select("doc_id", F.col(name).cast("int").alias("label"))
        .filter("doc_id is not null and label in (0, 1)")
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"))
    )
    order = F.xxhash64("doc_id")
    picked = [
        known.filter(F.col("label") == c).orderBy(order, "doc_id").limit(per_class) for c in (0, 1)
    ]
    number = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    picked = durable(picked[0].union(picked[1]))
    # One text of an id with several: the one with the smallest hash, so the bound counts rows.
    text = F.coalesce("text", F.lit(""))
    texts = (
        docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("order"))
        .join(picked, "doc_id")
        .groupBy("doc_id", "label")
        .agg(F.min_by("text", F.struct("order", "text")).alias("text"))
    )
    fold = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(folds)).cast("int")
    return texts.select("text", "label", fold.alias("fold")), number


def train(docs: DataFrame, labels: DataFrame, config: QualityConfig = QualityConfig()) -> QualityModel | None:
    """The classifier, or None if the labels do not hold both classes."""
    texts, number = training_rows(docs, labels, "quality", config.rows_per_class, config.folds)
    if len(number) < 2:
        return None
    schema = f"label int, fold int, features {linear.VECTOR}"
    rows = linear.stored(texts.mapInArrow(_featurise(config), schema).withColumn("weight", F.lit(1.0)))
    fitted = [x["label"] for x in rows.filter("fold > 0").select("label").distinct().collect()]
    if len(fitted) < 2:
        return None
    model = linear.fit(rows.filter("fold > 0"), config.dims, config.reg)
    weights, bias = model.coefficients.toArray(), float(model.intercept)
    margin = vector_to_array("rawPrediction")[1].alias("margin")
    held = model.transform(rows.filter("fold = 0").select("features", "label")).select("label", margin).collect()
    label, margin = np.array(held, dtype=float).T
    seen = np.bincount(label.astype(int), minlength=2)
    if seen.min() == 0:
        return QualityModel(weights, bias, 1.0, 0.0)
    weight = np.array([number[0] / seen[0], number[1] / seen[1]])[label.astype(int)]
    slope, shift = linear.platt(margin, label, weight * len(label) / weight.sum())
    return QualityModel(weights, bias, slope, shift)


def _judge_block(block: Block, model: QualityModel | None, config: QualityConfig):
    """Base counts, base_failed, kept and probabilities (None without a model) of a block."""
    base = counts(block)
    failed = (base["n_words"] < config.min_words) | (
        100 * base["n_repeat_words"] > config.max_repeat_percent * base["n_words"]
    )
    if model is None:
        return base, failed, ~failed, None
    margin = linear.margins(_kinds(block, config), len(block.starts), model.weights, model.bias)
    chance = linear.sigmoid(model.slope * margin + model.shift)
    return base, failed, ~failed & (chance >= config.threshold), chance


def keep(docs: DataFrame, model: QualityModel | None, config: QualityConfig = QualityConfig()) -> DataFrame:
    """The rows of docs that are kept, with all their columns."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches):
            for block in blocks(texts_of(batch.column("text"))):
                kept = _judge_block(block, model, config)[2]
                yield batch.slice(block.first, len(block.starts)).filter(pa.array(kept))

    return docs.mapInArrow(judge, docs.schema)


def score(docs: DataFrame, model: QualityModel | None, config: QualityConfig = QualityConfig()) -> DataFrame:
    """Per row: doc_id, the base counts, base_failed, kept and the calibrated probability."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches):
            for block in blocks(texts_of(batch.column("text"))):
                n = len(block.starts)
                base, failed, kept, chance = _judge_block(block, model, config)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(block.first, n),
                        *(pa.array(v.astype(np.int64)) for v in base.values()),
                        pa.array(failed),
                        pa.array(kept),
                        pa.nulls(n, pa.float64()) if chance is None else pa.array(chance),
                    ],
                    names=["doc_id", *base, "base_failed", "kept", "probability"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "base_failed boolean, kept boolean, probability double"
    )
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(judge, schema)
