"""Removal of long byte strings that occur more than once in a corpus (exact substring dedup).

A byte is removed if a string of ``length`` bytes covers it that also starts anywhere else, in the
same text or another.  Every judgement is made on the input.

The suffixes to sort are sampled and the others induced from them, as induced sorting does:

1. Sampled suffixes start at local minima: every ``length``-byte string is owned by the leftmost
   smallest 8-byte gram among its first ``reach`` positions.  Equal strings are owned at the same
   offset.  A sample's name is a hash of the bytes that all strings it could own share.  A name that
   occurs once cannot be in a repeat; that drops most suffixes after one partial aggregation.
2. The tuples that stay carry the extent of the strings they own as a second name.  Equal extents
   repeat as a whole, are counted before they are shuffled and go on as one tuple, so a text copied
   a million times is one tuple.
3. The other start positions are induced from ranges of offsets.  Tuples that share the bytes common
   to a range (its core) are compared by the bytes to its left and right (its edges).  Equal edges
   settle the range and go on as one tuple; a range whose core is alone is settled too.  Only what
   differs recurses into ranges a quarter as wide, and carries no more than the edges left.

All orderings are shuffles and sorts of Spark, which spill to disk, and every step aggregates
before it shuffles; no step needs the members of a group in one task.  Names are compared as pairs
of 64-bit hashes.

Cases: a null or empty text has no bytes, and its digest is that of the empty string.  Rows that
are repeated as a whole (same doc_id and text) are copies of one another.  A null doc_id is kept.
A text shorter than ``length`` is unchanged.  Columns besides ``doc_id`` and ``text`` are ignored.
An empty table gives no rows.
"""

from __future__ import annotations

import gc
import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleslane.llm.blocks import Block, RangeHash, blocks, in_parts, mix, texts_of
from saleslane.plans.durable import durable

GRAM = 8
#: Widths of the ranges of offsets, the widest that fits first.
WIDTHS = (64, 16, 4, 1)
#: A longer text is searched in slices of this size, which overlap.
SLICE_BYTES = 1 << 20
_MISSING = -(1 << 63)


def reach_of(length: int) -> int:
    """Positions in which a string's owner may lie."""
    if length < 32:
        raise ValueError("length must be 32 or more")
    return min(length - GRAM, length * 16 // 25)


def _stored(df: DataFrame) -> DataFrame:
    """``durable``, after which shuffle files of finished steps may go.

    Spark removes them when the driver collects its garbage; the call is a hint to do so now, as
    each step here moves about as much as the input.
    """
    out = durable(df)
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()
    return out


def _owners(block: Block, length: int) -> tuple[np.ndarray, ...]:
    """Sampled positions, their documents, and the first and last start of the strings they own."""
    reach, data = reach_of(length), block.data
    padded = np.concatenate([data, np.zeros(GRAM, dtype=np.uint8)])
    gram = np.ndarray(len(data), dtype="<u8", buffer=padded, strides=(1,))
    place = np.uint64((1 << 24) - 1)
    low = (mix(gram) & ~place) | np.arange(len(data), dtype=np.uint64)
    width = 1
    while width * 2 <= reach:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    if width < reach:
        low = np.minimum(low[: width - reach], low[reach - width :])
    found = (low & place).astype(np.int64)
    parts = [[np.empty(0, dtype=np.int64)] * 4]
    for d in np.flatnonzero(block.ends - block.starts >= length):
        begin = block.starts[d]
        own = found[begin : block.ends[d] - length + 1]
        first = np.flatnonzero(np.diff(own, prepend=-1))
        last = np.append(first[1:], len(own)) - 1
        parts.append([own[first], np.full(len(first), d), first + begin, last + begin])
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _slices(text: bytes, length: int) -> Iterator[tuple[int, bytes]]:
    """Overlapping parts of a text with the places where they begin."""
    margin = 2 * length
    for start in range(0, max(1, len(text)), SLICE_BYTES):
        begin = max(0, start - margin)
        yield begin, text[begin : start + SLICE_BYTES + margin]
        if start + SLICE_BYTES + margin >= len(text):
            return


_SAMPLES = "did long, th long, pos long, low int, high int, name long, around long"


def _sampler(length: int):
    sure = length - reach_of(length) + 1

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches):
            texts = texts_of(batch.column("text"))
            did, th = (batch.column(c).to_numpy() for c in ("did", "th"))
            long = [i for i, t in enumerate(texts) if len(t) > SLICE_BYTES]
            for block in blocks([b"" if len(t) > SLICE_BYTES else t for t in texts]):
                rows = np.arange(block.first, block.first + len(block.starts))
                yield from out(block, did[rows], th[rows])
            for i in long:
                last = -1
                for begin, part in _slices(texts[i], length):
                    whole = begin == 0, begin + len(part) == len(texts[i])
                    for made in out(Block([part]), did[[i]], th[[i]], begin, *whole):
                        keep = made.filter(pc.greater(made.column("pos"), last))
                        if keep.num_rows:
                            last = keep.column("pos")[-1].as_py()
                            yield keep

    def out(block, did, th, begin=0, at_start=True, at_end=True):
        at, doc, first, last = _owners(block, length)
        if not at_start or not at_end:
            # What a cut truncates is whole in the neighbouring slice.
            inner = (at_start | (first > block.starts[doc])) & (at_end | (last < block.ends[doc] - length))
            at, doc, first, last = at[inner], doc[inner], first[inner], last[inner]
        if not len(at):
            return
        low, high = at - last, at - first
        ranges = RangeHash(block.data)
        around = mix(ranges.of(first, last + length) + (low * length + high).astype(np.uint64))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(did[doc], pa.int64()),
                pa.array(th[doc], pa.int64()),
                pa.array(at - block.starts[doc] + begin, pa.int64()),
                pa.array(low, pa.int32()),
                pa.array(high, pa.int32()),
                pa.array(ranges.of(at, at + sure).view(np.int64), pa.int64()),
                pa.array(around.view(np.int64), pa.int64()),
            ],
            names=["did", "th", "pos", "low", "high", "name", "around"],
        )

    return sample


def _keyed(docs: DataFrame) -> DataFrame:
    """Rows with a key that equal rows share: the id and a hash of the text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        "doc_id",
        text.alias("text"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_MISSING)).alias("did"),
        F.xxhash64(text).alias("th"),
    )


_CELLS = "name long, lo int, core long, n long, rep long, a int, b int, left binary, right binary"


def _cells(length: int, width: int):
    """Ranges of offsets of each sample: the core's hash and the edges around it."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches):
            rows = {c: [] for c in ("name", "lo", "core", "n", "rep", "a", "b", "left", "right")}
            for text, found in zip(texts_of(batch.column("text")), batch.column("found").to_pylist(), strict=True):
                for x in found:
                    at = x["pos"]
                    for lo in range(x["low"] // width * width, x["high"] + 1, width):
                        a, b = max(lo, x["low"]), min(lo + width - 1, x["high"])
                        inner = at + length - lo - width + 1
                        rows["name"].append(x["name"])
                        rows["lo"].append(lo)
                        rows["core"].append(xxhash.xxh3_64_intdigest(text[at - lo : inner]) - (1 << 63))
                        rows["n"].append(x["n"])
                        rows["rep"].append(x["around"])
                        rows["a"].append(a)
                        rows["b"].append(b)
                        rows["left"].append(text[at - b : at - lo])
                        rows["right"].append(text[inner : at + length - a])
            if rows["n"]:
                kinds = {"lo": pa.int32(), "a": pa.int32(), "b": pa.int32(), "left": pa.binary(), "right": pa.binary()}
                yield pa.RecordBatch.from_arrays([pa.array(v, kinds.get(c, pa.int64())) for c, v in rows.items()], names=list(rows))

    return cut


def _narrower(cells: DataFrame, width: int, inner: int) -> DataFrame:
    """Each range of ``width`` offsets as ranges of ``inner``, with the core grown and edges shrunk."""
    children = cells.withColumn("c", F.explode(F.sequence(F.col("lo"), F.col("lo") + width - inner, F.lit(inner))))
    children = children.withColumn("a2", F.greatest("a", "c")).withColumn("b2", F.least("b", F.col("c") + inner - 1))
    to_core = F.col("lo") + width - F.col("c") - inner
    grown = F.xxhash64(
        "core",
        F.substring("left", F.col("b") - F.col("c") + 1, F.col("c") - F.col("lo")),
        F.substring("right", F.lit(1), to_core),
    )
    return children.filter("a2 <= b2").select(
        "name",
        F.col("c").alias("lo"),
        grown.alias("core"),
        "n",
        "rep",
        F.col("a2").alias("a"),
        F.col("b2").alias("b"),
        F.substring("left", F.col("b") - F.col("b2") + 1, F.col("b2") - F.col("c")).alias("left"),
        F.substring("right", to_core + 1, F.col("c") + inner - 1 - F.col("a2")).alias("right"),
    )


def _settle(cells: DataFrame, widths: list[int]) -> DataFrame:
    """(name, around, a, b): offsets a to b at which a tuple that occurs once owns repeated strings."""
    key = ["name", "lo", "core", "edges"]
    settled = []
    for width, inner in zip(widths, [*widths[1:], None], strict=True):
        rows = cells.withColumn("edges", F.xxhash64("a", "b", "left", "right"))
        kinds = _stored(rows.groupBy(*key).agg(F.sum("n").alias("members"), F.min("rep").alias("first")))
        settled.append(
            _stored(
                rows.filter("n = 1")
                .join(kinds.filter("members > 1").select(*key), key, "left_semi")
                .select("name", F.col("rep").alias("around"), "a", "b")
            )
        )
        if inner is None:
            break
        differing = (
            kinds.groupBy("name", "lo", "core")
            .agg(F.count("*").alias("kinds"), F.min("members").alias("least"))
            .filter("kinds > 1 and least = 1")
        )
        differing = _stored(differing)
        chosen = kinds.join(differing.select("name", "lo", "core"), ["name", "lo", "core"], "left_semi")
        chosen = chosen.withColumnRenamed("first", "rep").withColumnRenamed("members", "total")
        cells = rows.join(chosen, [*key, "rep"]).withColumn("n", F.col("total")).drop("total", "edges")
        cells = _stored(_narrower(cells, width, inner))
    return reduce(DataFrame.union, settled)


def repeated_spans(docs: DataFrame, length: int = 400) -> DataFrame:
    """Byte spans (did, th, start, end), which may overlap, that repeats of ``length`` bytes cover."""
    widths = [w for w in WIDTHS if w <= reach_of(length)]
    keyed = _keyed(docs)
    samples = _stored(keyed.select("did", "th", "text").mapInArrow(_sampler(length), _SAMPLES))
    # Stored, so that a join with a hot name has two plain shuffles, which Spark can split.
    names = _stored(samples.groupBy("name").agg(F.count("*").alias("n")).filter("n > 1"))
    samples = _stored(samples.join(names, "name", "left_semi"))
    at = F.min(F.struct("did", "th", "pos", "low", "high")).alias("at")
    tuples = _stored(samples.groupBy("name", "around").agg(F.count("*").alias("n"), at))
    kinds = tuples.groupBy("name").agg(F.count("*").alias("kinds"), F.min("n").alias("least"))
    open_names = _stored(kinds.filter("kinds > 1 and least = 1"))
    found = (
        tuples.join(open_names, "name", "left_semi")
        .groupBy(F.col("at.did").alias("did"), F.col("at.th").alias("th"))
        .agg(F.collect_list(F.struct("at.pos", "at.low", "at.high", "name", "around", "n")).alias("found"))
    )
    # Of a row that is repeated as a whole every tuple occurs twice, so counting it again does no harm.
    cells = _stored(keyed.join(found, ["did", "th"]).select("text", "found").mapInArrow(_cells(length, widths[0]), _CELLS))
    once = tuples.filter("n = 1").select("name", "around", "at.did", "at.th", "at.pos")
    spans = [
        _settle(cells, widths).join(once, ["name", "around"]).select("did", "th", "pos", F.col("a").alias("low"), F.col("b").alias("high")),
        samples.join(tuples.filter("n > 1").select("name", "around"), ["name", "around"], "left_semi").select("did", "th", "pos", "low", "high"),
    ]
    return reduce(DataFrame.union, spans).select(
        "did", "th", (F.col("pos") - F.col("high")).alias("start"), (F.col("pos") - F.col("low") + length).alias("end")
    )


def merge_spans(starts: list[int], ends: list[int]) -> list[tuple[int, int]]:
    """Maximal runs of what overlapping or touching spans cover."""
    merged: list[list[int]] = []
    for start, end in sorted(zip(starts, ends, strict=True)):
        if merged and start <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([start, end])
    return [(a, b) for a, b in merged]


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in in_parts(batches):
        texts = texts_of(batch.column("text"))
        rows = {n: [] for n in ("n_bytes", "n_removed", "n_spans", "kept_sha256", "spans")}
        for text, starts, ends in zip(texts, batch.column("starts").to_pylist(), batch.column("ends").to_pylist(), strict=True):
            spans = merge_spans(starts or [], ends or [])
            digest, at = hashlib.sha256(), 0
            for a, b in spans:
                digest.update(text[at:a])
                at = b
            digest.update(text[at:])
            rows["n_bytes"].append(len(text))
            rows["n_removed"].append(sum(b - a for a, b in spans))
            rows["n_spans"].append(len(spans))
            rows["kept_sha256"].append(digest.hexdigest())
            rows["spans"].append([{"start": a, "end": b} for a, b in spans])
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        kinds = {"kept_sha256": pa.string(), "spans": span}
        arrays = [batch.column("doc_id"), *(pa.array(v, kinds.get(c, pa.int64())) for c, v in rows.items())]
        yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", *rows])


def remove_repeats(docs: DataFrame, length: int = 400) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the removed ``spans``."""
    spans = (
        repeated_spans(docs, length)
        .groupBy("did", "th")
        .agg(F.collect_set(F.struct("start", "end")).alias("s"))
        .select("did", "th", F.col("s.start").alias("starts"), F.col("s.end").alias("ends"))
    )
    spans = _stored(spans)
    joined = _keyed(docs).join(spans, ["did", "th"], "left").select("doc_id", "text", "starts", "ends")
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
        "spans array<struct<start: bigint, end: bigint>>"
    )
    return joined.mapInArrow(_remove, schema)
