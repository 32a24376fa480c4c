"""Hashed n-grams of whole texts and logistic regressions over them, with calibrated scores."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saleslane.llm.blocks import Block, RangeHash, mix
from saleslane.plans.durable import durable

#: Weight of one text's n-grams of a kind together; single n-grams get their share of it.
SCALE = 30.0


def char_grams(block: Block, orders: tuple[int, ...], dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers and documents of the byte n-grams (up to eight bytes) inside documents."""
    n = len(block.data)
    padded = np.concatenate([block.data, np.zeros(8, dtype=np.uint8)])
    gram = np.ndarray(n, dtype="<u8", buffer=padded, strides=(1,))
    doc = np.repeat(np.arange(len(block.starts)), block.ends - block.starts + 1)
    left = np.repeat(block.ends, block.ends - block.starts + 1) - np.arange(n)
    numbers, docs = [], []
    for order in orders:
        inside = left >= order
        cut = gram[inside] & np.uint64((1 << (8 * order)) - 1)
        cut = (cut + np.uint64(order)) * np.uint64(0x9E3779B97F4A7C15)
        numbers.append(((cut ^ (cut >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(40)).astype(np.int64) % dims)
        docs.append(doc[inside])
    return np.concatenate(numbers), np.concatenate(docs)


def word_hashes(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Hash and document of every word."""
    start, end, doc = block.words()
    return RangeHash(block.data).of(start, end), doc


def word_grams(words: np.ndarray, doc: np.ndarray, orders: tuple[int, ...], dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers and documents of the word n-grams inside documents."""
    numbers, docs = [], []
    for order in orders:
        n = max(0, len(words) - order + 1)
        key = np.full(n, order, dtype=np.uint64)
        for k in range(order):
            key = mix(key + words[k : k + n])
        inside = doc[:n] == doc[order - 1 : order - 1 + n]
        numbers.append((key[inside] >> np.uint64(20)).astype(np.int64) % dims)
        docs.append(doc[:n][inside])
    return np.concatenate(numbers), np.concatenate(docs)


def shares(kinds: list[tuple[np.ndarray, np.ndarray]], n_docs: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(numbers, documents, value) per kind: SCALE times a feature's share of its kind in the text."""
    for numbers, docs in kinds:
        per_doc = np.bincount(docs, minlength=n_docs)
        yield numbers, docs, SCALE / np.maximum(per_doc, 1)


def margins(kinds: list[tuple[np.ndarray, np.ndarray]], n_docs: int, weights: np.ndarray, bias: float) -> np.ndarray:
    """Linear score of every document of a block."""
    total = np.full(n_docs, bias)
    for numbers, docs, value in shares(kinds, n_docs):
        total += np.bincount(docs, weights=weights[numbers], minlength=n_docs) * value
    return total


def sparse_rows(kinds: list[tuple[np.ndarray, np.ndarray]], n_docs: int, dims: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Each document's feature numbers, ascending, and values."""
    keys, values = [], []
    for numbers, docs, value in shares(kinds, n_docs):
        keys.append(docs * dims + numbers)
        values.append(value[docs])
    found, place = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(place, weights=np.concatenate(values), minlength=len(found))
    cut = np.searchsorted(found, np.arange(n_docs + 1) * dims)
    return [((found[a:b] % dims).astype(np.int32), total[a:b]) for a, b in zip(cut[:-1], cut[1:], strict=True)]


#: A sparse vector as its type stores it, so that a stored table can be read as vectors.
VECTOR = "struct<type: tinyint, size: int, indices: array<int>, values: array<double>>"
_ARROW_VECTOR = [pa.int8(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.float64())]


def feature_batch(keep: list[pa.Array], names: list[str], rows: list[tuple[np.ndarray, np.ndarray]], dims: int) -> pa.RecordBatch:
    parts = ([0] * len(rows), [dims] * len(rows), [r[0] for r in rows], [r[1] for r in rows])
    arrays = [pa.array(x, kind) for x, kind in zip(parts, _ARROW_VECTOR, strict=True)]
    features = pa.StructArray.from_arrays(arrays, names=["type", "size", "indices", "values"])
    return pa.RecordBatch.from_arrays([*keep, features], names=[*names, "features"])


def stored(rows: DataFrame) -> DataFrame:
    """Rows written once and read back with ``features`` as vectors, without a Python function."""
    kinds = [T.StructField(f.name, VectorUDT() if f.name == "features" else f.dataType) for f in rows.schema]
    return durable(rows, T.StructType(kinds))


def fit(rows: DataFrame, dims: int, reg: float, rounds: int = 60, family: str = "binomial") -> LogisticRegressionModel:
    """Spark's logistic regression over rows (features, label, weight)."""
    data = rows.select("features", F.col("label").cast("double"), "weight")
    return LogisticRegression(
        regParam=reg, maxIter=rounds, standardization=False, weightCol="weight", family=family
    ).fit(data)


def platt(margin: np.ndarray, label: np.ndarray, weight: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """(a, b) of the calibrated probability 1 / (1 + exp(-(a * margin + b))), by Newton's method.

    A small ridge keeps separable margins finite; a slope below 0.05 is not accepted.
    """
    a, b = 1.0, 0.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        slope = weight * (label - p)
        curve = np.maximum(weight * p * (1 - p), 1e-9)
        gradient = np.array([(slope * margin).sum() - 0.01 * (a - 1), slope.sum() - 0.01 * b])
        hessian = np.array([[(curve * margin**2).sum() + 0.01, (curve * margin).sum()], [(curve * margin).sum(), curve.sum() + 0.01]])
        step = np.linalg.solve(hessian, gradient)
        a, b = a + float(np.clip(step[0], -1, 1)), b + float(np.clip(step[1], -2, 2))
        if np.abs(step).max() < 1e-6:
            break
    return max(a, 0.05), b


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))
