"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

Terms are lower-cased words and word beginnings of four to eight bytes.  The vocabulary holds the
terms whose presence depends most clearly on the label (chi-squared); their document frequencies are
counted over the whole corpus.  Labelled examples become unit TF-IDF vectors in an inverted index
whose posting lists are cut into blocks of examples with the largest weight of each term in each
block.  A text's neighbours are searched block by block in descending order of the bound that these
maxima give, until no block can hold a nearer one; the neighbours are exact.  Their labels vote with
weights that grow as the distance falls, and labelled rows outside the index calibrate the votes.

Fit bound: at most ``ToxicityConfig.rows_per_class`` labelled rows of either class choose terms and
make up the index and its calibration (those with the smallest hash of their id), and the
vocabulary has at most ``max_terms`` terms.  All else covers every row and every whole text.

Cases: a null, empty or foreign text has no term of the vocabulary and gets the calibrated rate of
such rows.  Labels that are null are skipped; of differing labels for one id the highest counts.
Without rows of both classes every score is the share of toxic labels (0.5 without labels).
Repeated rows are scored alike, one output row each.  Equal similarities are taken in the order of
the examples.  A null doc_id is kept.  Extra columns are ignored.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleslane.llm import linear
from saleslane.llm.blocks import Block, RangeHash, blocks, in_parts, mix, texts_of
from saleslane.plans.durable import durable


@dataclass(frozen=True)
class ToxicityConfig:
    rows_per_class: int = 2000
    max_terms: int = 2048
    min_rows: int = 5
    min_chi2: float = 15.0
    prefixes: tuple[int, ...] = (4, 5, 6, 7, 8)
    neighbours: int = 24
    block: int = 32
    #: One labelled row in this many calibrates instead of standing in the index.
    folds: int = 4


_TERM = np.zeros(256, dtype=bool)
_TERM[[*range(ord("0"), ord("9") + 1), *range(ord("a"), ord("z") + 1), *range(128, 256)]] = True


def terms(block: Block, prefixes: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit terms of a block of lower-cased texts, repeats included, and their documents."""
    inside = np.zeros(len(block.data) + 2, dtype=np.int8)
    inside[1:-1] = _TERM[block.data]
    edge = np.diff(inside)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    doc = np.searchsorted(block.starts, start, side="right") - 1
    ranges = RangeHash(block.data)
    found, docs = [ranges.of(start, end)], [doc]
    for size in prefixes:
        long = end - start > size
        found.append(mix(ranges.of(start[long], start[long] + size) + np.uint64(size)))
        docs.append(doc[long])
    return np.concatenate(found), np.concatenate(docs)


def _lowered(column: pa.Array) -> list[bytes]:
    return [t.decode().lower().encode() for t in texts_of(column)]


class Vocabulary:
    """Numbers of known terms; most others are dropped by a bitmap of 16 bits."""

    def __init__(self, known: np.ndarray):
        self.known = np.sort(known.astype(np.uint64))
        self.seen = np.zeros(1 << 16, dtype=bool)
        self.seen[(self.known & np.uint64(0xFFFF)).astype(np.int64)] = True

    def count(self, block: Block, prefixes: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, term number, times) of a block's known terms, in that order."""
        found, doc = terms(block, prefixes)
        maybe = self.seen[(found & np.uint64(0xFFFF)).astype(np.int64)]
        found, doc = found[maybe], doc[maybe]
        place = np.minimum(np.searchsorted(self.known, found), max(0, len(self.known) - 1))
        hit = self.known[place] == found if len(self.known) else np.zeros(len(found), dtype=bool)
        key, times = np.unique(doc[hit] * max(1, len(self.known)) + place[hit], return_counts=True)
        return key // max(1, len(self.known)), key % max(1, len(self.known)), times


class Index:
    """Unit vectors of examples as posting lists in blocks, with each term's maximum per block."""

    def __init__(self, size: int, n_terms: int, block: int, term: np.ndarray, example: np.ndarray, weight: np.ndarray):
        self.block, self.size = block, size
        n_blocks = max(1, -(-size // block))
        self.postings = np.zeros((n_terms, n_blocks, block), dtype=np.float32)
        self.postings[term, example // block, example % block] = weight
        self.most = self.postings.max(axis=2) if n_terms else np.zeros((0, n_blocks), dtype=np.float32)

    def nearest(self, term: np.ndarray, weight: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and similarities of the k nearest examples with a term in common."""
        bound = weight @ self.most[term]
        order = np.argsort(-bound, kind="stable")
        numbers, sims = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.float32)
        for b in order:
            if bound[b] <= 0 or (len(sims) == k and bound[b] + 1e-6 < sims[-1]):
                break
            own = weight @ self.postings[term, b]
            some = np.flatnonzero(own > 0)
            numbers = np.concatenate([numbers, some + b * self.block])
            sims = np.concatenate([sims, own[some]])
            best = np.lexsort((numbers, -sims))[:k]
            numbers, sims = numbers[best], sims[best]
        return numbers, sims


@dataclass(frozen=True)
class ToxicityModel:
    known: np.ndarray
    idf: np.ndarray
    #: (term, example, weight) of the index, and each example's label and id.
    entries: tuple[np.ndarray, np.ndarray, np.ndarray]
    label: np.ndarray
    ids: list
    slope: float
    shift: float
    #: Scores without a neighbour.
    blank: float


def _unit(times: np.ndarray, idf: np.ndarray) -> np.ndarray:
    weight = (1 + np.log(times)) * idf
    return weight / max(1e-12, np.sqrt((weight**2).sum()))


def _votes(sims: np.ndarray, toxic: np.ndarray) -> float:
    """Log odds of the neighbours' labels; nearer ones count for more, few or far ones for less."""
    weight = sims.astype(np.float64) ** 2 / (1.05 - np.minimum(sims, 1.0))
    return float(np.log((weight[toxic].sum() + 0.25) / (weight[~toxic].sum() + 0.25)))


def _per_doc(block: Block, vocabulary: Vocabulary, idf: np.ndarray, config: ToxicityConfig):
    """(document, terms, unit weights) of each document with known terms."""
    doc, term, times = vocabulary.count(block, config.prefixes)
    cut = np.flatnonzero(np.diff(doc)) + 1
    for part, t, n in zip(np.split(doc, cut), np.split(term, cut), np.split(times, cut), strict=True):
        if len(part):
            yield int(part[0]), t, _unit(n, idf[t]).astype(np.float32)


def held_out(doc_id: Column) -> Column:
    """Rows from which no label is learnt: crc32 of the id as text is divisible by five."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(5)) == 0, F.lit(False))


def _sample(docs: DataFrame, labels: DataFrame, config: ToxicityConfig) -> tuple[DataFrame, dict[int, int]]:
    known = (
        labels.select("doc_id", F.col("toxic").cast("int").alias("label"))
        .filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
    )
    number = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    order = F.xxhash64("doc_id")
    picked = [known.filter(F.col("label") == c).orderBy(order, "doc_id").limit(config.rows_per_class) for c in (0, 1)]
    picked = durable(picked[0].union(picked[1]))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(picked, "doc_id")
    fold = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(config.folds)).cast("int")
    return durable(texts.dropDuplicates(["doc_id", "text"]).withColumn("fold", fold)), number


def _rows_per_term(config: ToxicityConfig):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches):
            label = batch.column("label").to_numpy()
            for block in blocks(_lowered(batch.column("text"))):
                found, doc = terms(block, config.prefixes)
                order = np.lexsort((doc, found))
                found, doc = found[order], doc[order]
                once = np.ones(len(found), dtype=bool)
                once[1:] = (np.diff(found) != 0) | (np.diff(doc) != 0)
                own = label[block.first + doc[once]]
                term, place = np.unique(found[once], return_inverse=True)
                toxic = np.bincount(place, weights=own, minlength=len(term)).astype(np.int64)
                total = np.bincount(place, minlength=len(term))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(term.view(np.int64)), pa.array(toxic), pa.array(total - toxic)], names=["term", "toxic", "other"]
                )

    return count


def _choose_terms(sample: DataFrame, config: ToxicityConfig) -> np.ndarray:
    """The terms that depend on the label most, by chi-squared of the sample's rows."""
    fit = sample.filter("fold > 0")
    size = {r["label"]: r["n"] for r in fit.groupBy("label").agg(F.count("*").alias("n")).collect()}
    a, b = F.col("toxic").cast("double"), F.col("other").cast("double")
    c, d = F.lit(float(size.get(1, 0))) - a, F.lit(float(size.get(0, 0))) - b
    chi2 = (a + b + c + d) * (a * d - b * c) ** 2 / ((a + b) * (c + d) * (a + c) * (b + d))
    best = (
        fit.select("text", "label")
        .mapInArrow(_rows_per_term(config), "term long, toxic long, other long")
        .groupBy("term")
        .agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
        .filter(F.col("toxic") + F.col("other") >= config.min_rows)
        .withColumn("chi2", F.try_divide(chi2, F.lit(1.0)))
        .filter(F.col("chi2") >= config.min_chi2)
        .orderBy(F.desc("chi2"), "term")
        .limit(config.max_terms)
    )
    return np.array([r["term"] for r in best.select("term").collect()], dtype=np.int64).view(np.uint64)


def _document_frequencies(docs: DataFrame, known: np.ndarray, config: ToxicityConfig) -> tuple[np.ndarray, int]:
    """Documents of the whole corpus that hold each known term, and documents in all."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, total, rows = Vocabulary(known), np.zeros(len(known), dtype=np.int64), 0
        for batch in in_parts(batches):
            rows += batch.num_rows
            for block in blocks(_lowered(batch.column("text"))):
                total += np.bincount(vocabulary.count(block, config.prefixes)[1], minlength=len(known))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, len(known))), pa.array(np.concatenate([[rows], total]))], names=["n", "df"])

    found = docs.select(F.coalesce("text", F.lit("")).alias("text")).mapInArrow(count, "n long, df long")
    by_term = {r["n"]: r["df"] for r in found.groupBy("n").agg(F.sum("df").alias("df")).collect()}
    return np.array([by_term.get(i, 0) for i in range(len(known))], dtype=np.float64), by_term.get(-1, 0)


def _entries(sample: DataFrame, known: np.ndarray, config: ToxicityConfig) -> list:
    """The bounded sample as (doc_id, label, fold, terms, times) rows."""

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(known)
        for batch in in_parts(batches):
            for block in blocks(_lowered(batch.column("text"))):
                n = len(block.starts)
                doc, term, times = vocabulary.count(block, config.prefixes)
                cut = np.searchsorted(doc, np.arange(n + 1))
                own = batch.slice(block.first, n)
                parts = list(zip(cut[:-1], cut[1:], strict=True))
                yield pa.RecordBatch.from_arrays(
                    [
                        *(own.column(c) for c in ("doc_id", "label", "fold")),
                        pa.array([term[a:b].tolist() for a, b in parts], pa.list_(pa.int32())),
                        pa.array([times[a:b].tolist() for a, b in parts], pa.list_(pa.int32())),
                    ],
                    names=["doc_id", "label", "fold", "terms", "times"],
                )

    kind = sample.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, label int, fold int, terms array<int>, times array<int>"
    return sample.select("doc_id", "text", "label", "fold").mapInArrow(vectors, schema).collect()


def train(docs: DataFrame, labels: DataFrame, config: ToxicityConfig = ToxicityConfig()) -> ToxicityModel:
    sample, number = _sample(docs, labels, config)
    total = sum(number.values())
    rate = number.get(1, 0) / total if total else 0.5
    known = np.sort(_choose_terms(sample, config)) if len(number) == 2 else np.empty(0, dtype=np.uint64)
    nothing = (np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64), np.empty(0, dtype=np.float32))
    if not len(known):
        return ToxicityModel(known, np.empty(0), nothing, np.empty(0, dtype=bool), [], 1.0, 0.0, rate)
    df, size = _document_frequencies(docs, known, config)
    idf = np.log((1 + size) / (1 + df)) + 1e-3
    rows = sorted(_entries(sample, known, config), key=lambda r: (r["label"], r["doc_id"], r["terms"]))
    examples = [r for r in rows if r["fold"] > 0 and r["terms"]]
    term, example, weight = [], [], []
    for i, r in enumerate(examples):
        t = np.array(r["terms"])
        term.append(t)
        example.append(np.full(len(t), i))
        weight.append(_unit(np.array(r["times"]), idf[t]))
    entries = tuple(np.concatenate(x) if x else nothing[i] for i, x in enumerate((term, example, weight)))
    label = np.array([r["label"] == 1 for r in examples], dtype=bool)
    index = Index(len(examples), len(known), config.block, *entries)

    # Calibration rows count as their class does among all labels.
    seen = np.bincount([r["label"] for r in rows if r["fold"] == 0], minlength=2)
    share = np.array([number[0], number[1]]) / np.maximum(seen, 1)
    margin, truth, counts, blank = [], [], [], [rate, 1.0]
    for r in rows:
        if r["fold"] == 0 and not r["terms"]:
            blank = [blank[0] + share[r["label"]] * r["label"], blank[1] + share[r["label"]]]
        elif r["fold"] == 0:
            t = np.array(r["terms"])
            found, sims = index.nearest(t, _unit(np.array(r["times"]), idf[t]).astype(np.float32), config.neighbours)
            margin.append(_votes(sims, label[found]))
            truth.append(r["label"])
            counts.append(share[r["label"]])
    slope, shift = 1.0, 0.0
    if len(set(truth)) == 2:
        scale = len(counts) / sum(counts)
        slope, shift = linear.platt(np.array(margin), np.array(truth, dtype=float), np.array(counts) * scale)
    return ToxicityModel(known, idf, entries, label, [r["doc_id"] for r in examples], slope, shift, blank[0] / blank[1])


def score(docs: DataFrame, model: ToxicityModel, config: ToxicityConfig = ToxicityConfig()) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted and the nearest examples as evidence."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the fit's bounds

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        vocabulary = Vocabulary(m.known)
        index = Index(len(m.ids), len(m.known), config.block, *m.entries)
        for batch in in_parts(batches):
            for block in blocks(_lowered(batch.column("text"))):
                n = len(block.starts)
                scores = np.full(n, m.blank)
                evidence: list[list[dict]] = [[] for _ in range(n)]
                for doc, term, weight in _per_doc(block, vocabulary, m.idf, config):
                    found, sims = index.nearest(term, weight, config.neighbours)
                    if len(found):
                        scores[doc] = linear.sigmoid(np.array(m.slope * _votes(sims, m.label[found]) + m.shift))
                        evidence[doc] = [
                            {"doc_id": m.ids[i], "similarity": float(s), "toxic": bool(m.label[i])}
                            for i, s in zip(found[:3].tolist(), sims[:3].tolist(), strict=True)
                        ]
                own = batch.slice(block.first, n)
                kind = pa.list_(pa.struct([("doc_id", own.column("doc_id").type), ("similarity", pa.float64()), ("toxic", pa.bool_())]))
                yield pa.RecordBatch.from_arrays(
                    [
                        own.column("doc_id"),
                        own.column("held_out"),
                        pa.array(scores),
                        pa.array((scores >= 0.5).astype(np.int32)),
                        pa.array(evidence, kind),
                    ],
                    names=["doc_id", "held_out", "score", "predicted", "evidence"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {kind}, held_out boolean, score double, predicted int, "
        f"evidence array<struct<doc_id: {kind}, similarity: double, toxic: boolean>>"
    )
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(judge, schema)
