"""Licence scans: a paragraph classifier over word n-grams, confirmed by comparison with templates.

Each line is judged; then each run of neighbouring non-blank lines (a paragraph) for notices that are
wrapped over several of them.  The word n-grams (1, 2; lower-cased runs of letters, digits and dots) are
hashed into a sparse vector; a multinomial logistic regression names the licence family or
``unknown``.  It is trained on variants of the families' notices and on paragraphs of the corpus as
unknown.  Probabilities are calibrated by a temperature fitted on rows kept out of training.  A
family is reported if its probability reaches a threshold and the paragraph holds enough of the word
pairs of one of the family's notices.

Fit bound: ``unknown_rows`` distinct lines of the corpus (those with the smallest hash) and a fixed
number of variants per notice train the model.  Every line of every text is classified.  A wrapped
notice spans twice its words at most, over any number of lines; it is named by its first line.

Cases: null and empty texts have no paragraphs.  Equal paragraphs of a text are findings each.
Repeated rows give repeated findings; a null doc_id is kept.  Extra columns are ignored.  An empty
table gives no rows.  Of equally covered notices the first counts.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saleslane.llm import linear
from saleslane.llm.blocks import SPACE, Block, RangeHash, blocks, in_parts, mix, texts_of

UNKNOWN = "unknown"
#: Short notices as licences and their stewards word them.
NOTICES: dict[str, tuple[str, ...]] = {
    "apache-2.0": ("Licensed under the Apache License, Version 2.0.", "You may not use this file except in compliance with the License."),
    "mit": ("Released under the MIT License.", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software."),
    "gpl-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License.",
    ),
    "cc-by-nc-4.0": ("Licensed under CC BY-NC 4.0.", "Licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "cc-by-4.0": ("Licensed under CC BY 4.0.", "Licensed under a Creative Commons Attribution 4.0 International License."),
    "bsd": ("Released under the BSD 3-Clause License.", "Redistribution and use in source and binary forms, with or without modification, are permitted."),
    "all-rights-reserved": ("All rights reserved.",),
    "mpl-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",),
}
FAMILIES = (UNKNOWN, *NOTICES)


@dataclass(frozen=True)
class LicenseConfig:
    dims: int = 1 << 14
    orders: tuple[int, ...] = (1, 2)
    unknown_rows: int = 2000
    variants: int = 40
    reg: float = 1e-5
    threshold: float = 0.5
    coverage: float = 0.7
    seed: int = 3


@dataclass(frozen=True)
class LicenseModel:
    weights: np.ndarray
    bias: np.ndarray
    heat: float


_INSIDE = np.zeros(256, dtype=bool)
_INSIDE[[*range(ord("0"), ord("9") + 1), *range(ord("a"), ord("z") + 1), *range(128, 256)]] = True


def _lines(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every line of a block and its document."""
    end = np.flatnonzero(block.data == 0x0A)
    start = np.concatenate([[0], end[:-1] + 1]).astype(np.int64)
    return start, end, np.searchsorted(block.starts, start, side="right") - 1


def _hashed_words(block: Block, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, end, hash and line of every word of a block of lower-cased text."""
    inside = np.zeros(len(block.data) + 2, dtype=np.int8)
    inside[1:-1] = _INSIDE[block.data]
    edge = np.diff(inside)
    first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    return first, last, RangeHash(block.data).of(first, last), np.searchsorted(start, first, side="right") - 1


def _grams(block: Block, start: np.ndarray, config: LicenseConfig) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers and lines of the word n-grams of a block of lower-cased text."""
    _, _, words, line = _hashed_words(block, start)
    return linear.word_grams(words, line, config.orders, config.dims)


def _pair_keys(words: np.ndarray) -> np.ndarray:
    return mix(mix(words[:-1]) + words[1:])


def _lowered(texts: list[bytes]) -> list[bytes]:
    return [t.decode().lower().encode() for t in texts]


def _words(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", text.lower())


_PAIRS = {f: [set(zip(w, w[1:])) for w in map(_words, notices)] for f, notices in NOTICES.items()}


def coverage(text: str, family: str) -> float:
    """The largest share of a notice's word pairs that the text holds."""
    words = _words(text)
    held = set(zip(words, words[1:]))
    return max(len(p & held) / len(p) for p in _PAIRS[family])


def _notice_keys() -> list[tuple[str, np.ndarray, int]]:
    """(family, hashed word pairs, words) of every notice."""
    out = []
    for family, notices in NOTICES.items():
        for notice in notices:
            block = Block([" ".join(_words(notice)).encode()])
            words = _hashed_words(block, block.starts)[2]
            out.append((family, np.unique(_pair_keys(words)), len(words)))
    return out


_NOTICE_KEYS = _notice_keys()
_ALL_KEYS = np.unique(np.concatenate([k for _, k, _ in _NOTICE_KEYS]))


def _wrapped(block: Block, start: np.ndarray, end: np.ndarray, doc: np.ndarray, found: np.ndarray, least: float) -> list[tuple[int, str, bytes]]:
    """(first line, family, text) of stretches over several lines that hold enough of a notice's word pairs.

    A paragraph ends at a blank line, at the text's end and at a line that is a finding itself.
    """
    full = np.concatenate([[0], np.cumsum(~SPACE[block.data])])
    stop = full[end] == full[start]
    stop[found] = True
    paragraph = np.cumsum(stop | np.concatenate([[True], np.diff(doc) != 0]) | np.concatenate([[False], stop[:-1]]))
    first, last, words, line = _hashed_words(block, start)
    keys = _pair_keys(words) if len(words) > 1 else np.empty(0, np.uint64)
    at = np.flatnonzero(np.isin(keys, _ALL_KEYS))
    at = at[(paragraph[line[at]] == paragraph[line[at + 1]]) & ~stop[line[at]]]
    out = []
    for family, own, size in _NOTICE_KEYS:
        places = at[np.isin(keys[at], own)].tolist()
        i = 0
        while i < len(places):
            held: set[int] = set()
            j = i
            while j < len(places) and places[j] + 2 - places[i] <= 2 * size and paragraph[line[places[j]]] == paragraph[line[places[i]]]:
                held.add(int(keys[places[j]]))
                j += 1
                if len(held) == len(own):
                    break
            a, b = places[i], places[j - 1] + 1
            if len(held) >= least * len(own) and line[a] != line[b]:
                out.append((int(line[a]), family, block.data[first[a] : last[b]].tobytes().replace(b"\n", b" ")))
                i = j
            else:
                i += 1
    return out


def variants(config: LicenseConfig) -> list[tuple[str, str]]:
    """(family, text): each notice as it is, in other cases, with words left out or put around it."""
    rng, out = random.Random(config.seed), []
    around = "this file code see terms for the and of project copyright holder".split()
    for family, notices in NOTICES.items():
        for notice in notices:
            for i in range(config.variants):
                words = notice.split()
                if i % 4 == 1 and len(words) > 5:
                    del words[rng.randrange(len(words))]
                if i % 4 == 2:
                    words = [rng.choice(around) for _ in range(rng.randint(1, 4))] + words
                if i % 4 == 3:
                    words += [rng.choice(around) for _ in range(rng.randint(1, 6))]
                text = " ".join(words)
                out.append((family, text.upper() if i % 8 == 5 else text))
    for _ in range(config.variants * 4):
        out.append((UNKNOWN, " ".join(rng.choice(around) for _ in range(rng.randint(1, 12)))))
    return out


def _featurise(config: LicenseConfig):
    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches):
            for block in blocks(_lowered(texts_of(batch.column("text")))):
                n = len(block.starts)
                grams = _grams(block, block.starts, config)
                own = batch.slice(block.first, n)
                yield linear.feature_batch([own.column("label")], ["label"], linear.sparse_rows([grams], n, config.dims), config.dims)

    return features


def train(spark: SparkSession, docs: DataFrame, config: LicenseConfig = LicenseConfig()) -> LicenseModel:
    known = [(FAMILIES.index(f), t) for f, t in variants(config)]
    lines = docs.select(F.explode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("text"))
    pattern = r"(?i)licen[cs]e|copyright|permission|redistribut|public domain|rights\s+reserved"
    plain = lines.filter((F.length("text") > 0) & ~F.col("text").rlike(pattern))
    # The hashes are made distinct first, so that only the sample's lines are shuffled.
    hashes = plain.select(F.xxhash64("text").alias("h")).distinct().orderBy("h").limit(config.unknown_rows)
    plain = plain.filter(F.xxhash64("text") <= F.lit(hashes.agg(F.max("h")).first()[0])).distinct()
    plain = plain.orderBy(F.xxhash64("text"), "text").limit(config.unknown_rows)
    rows = spark.createDataFrame(known, "label int, text string").union(plain.select(F.lit(0).alias("label"), "text"))
    rows = rows.filter(~F.col("text").contains("\n"))
    schema = f"label int, features {linear.VECTOR}"
    held_row = F.pmod(F.xxhash64("label", "features.indices"), F.lit(4)) == 0
    featured = linear.stored(rows.mapInArrow(_featurise(config), schema).withColumn("weight", F.lit(1.0)).withColumn("held", held_row))
    model = linear.fit(featured.filter("not held"), config.dims, config.reg, family="multinomial")
    weights, bias = np.zeros((len(FAMILIES), config.dims)), np.full(len(FAMILIES), -30.0)
    fitted = model.coefficientMatrix.toArray()
    weights[: len(fitted)], bias[: len(fitted)] = fitted, model.interceptVector.toArray()
    held = featured.filter("held").select("label", "features").collect()
    margins = np.array([weights[:, r["features"].indices] @ r["features"].values + bias for r in held]).reshape(len(held), len(FAMILIES))
    truth = np.array([r["label"] for r in held], dtype=int)

    def loss(heat: float) -> float:
        x = margins / heat
        x = x - x.max(axis=1, keepdims=True)
        return float(np.mean(np.log(np.exp(x).sum(axis=1)) - x[np.arange(len(x)), truth]))

    heats = np.geomspace(0.3, 8, 40)
    return LicenseModel(weights, bias, float(min(heats, key=loss)) if len(held) else 1.0)


def find(docs: DataFrame, model: LicenseModel, config: LicenseConfig = LicenseConfig()) -> DataFrame:
    """Findings (doc_id, paragraph, family, probability, coverage); paragraph is the line's number."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # families x dims

    def judge(m: LicenseModel, block: Block, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The family of each line, the lines that are not unknown, and their probabilities."""
        n = len(start)
        numbers, line = _grams(block, start, config)
        share = linear.SCALE * len(config.orders) / np.maximum(np.bincount(line, minlength=n), 1) / len(config.orders)
        scores = np.array([np.bincount(line, weights=w[numbers], minlength=n) * share + b for w, b in zip(m.weights, m.bias, strict=True)])
        best = scores.argmax(axis=0)
        some = np.flatnonzero(best > 0)
        x = scores[:, some] / m.heat
        return best, some, 1 / np.exp(x - x[best[some], np.arange(len(some))]).sum(axis=0)

    def classify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in in_parts(batches):
            for block in blocks(_lowered(texts_of(batch.column("text")))):
                start, end, doc = _lines(block)
                n = len(start)
                best, some, chance = judge(m, block, start)
                number = np.arange(n) - np.searchsorted(start, block.starts)[doc]
                rows, found = [], []
                for i, p in zip(some[chance >= config.threshold].tolist(), chance[chance >= config.threshold].tolist(), strict=True):
                    family = FAMILIES[best[i]]
                    held = coverage(block.data[start[i] : end[i]].tobytes().decode(), family)
                    if held >= config.coverage:
                        rows.append((block.first + doc[i], int(number[i]), family, p, held))
                        found.append(i)
                for i, family, text in _wrapped(block, start, end, doc, np.array(found, dtype=np.int64), config.coverage):
                    one = Block([text])
                    of, _, p = judge(m, one, one.starts)
                    held = coverage(text.decode(), family)
                    if FAMILIES[of[0]] == family and p[0] >= config.threshold and held >= config.coverage:
                        rows.append((block.first + doc[i], int(number[i]), family, float(p[0]), held))
                if rows:
                    place, lines, families, chances, shares = zip(*rows, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column("doc_id").take(pa.array(place)),
                            pa.array(lines, pa.int32()),
                            pa.array(families),
                            pa.array(chances),
                            pa.array(shares),
                        ],
                        names=["doc_id", "paragraph", "family", "probability", "coverage"],
                    )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, paragraph int, family string, probability double, coverage double"
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(classify, schema)
