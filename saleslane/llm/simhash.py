"""SimHash near-duplicates: fingerprints linked within a Hamming radius, and their components.

Links are found by pigeonring filtering.  With radius r the 64 bits are cut into r + 1 segments in a
ring.  If two fingerprints differ in r bits at most, then from some segment on every chain of l
consecutive segments differs in at most l * r / (r + 1) bits: none in the first segment, one in the
first two, and so on.  The first two links of the chain make the join key (the second segment also
with each of its zero bits set, which covers the one difference allowed); the others are checked on
the candidates before the full Hamming distance.

Only distinct fingerprints are compared, so any number of copies counts once.  A key that many
fingerprints share yields the links of a spanning forest instead of all its pairs; components are
the same.  Nothing is capped.

Cases: words are split at ASCII white space after A-Z are lower-cased.  A null, empty or blank text
has fingerprint zero, which is linked like any other.  Texts shorter than a shingle are one shingle.
Repeated rows get equal results, one row each.  A null doc_id is kept; it never names a component
unless all ids of the component are null (then component_id is null).  Extra columns are ignored.
An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleslane.llm.blocks import in_parts, texts_of
from saleslane.llm.components import components
from saleslane.plans.durable import durable

BITS = 64
SEED = 42
#: A key with more comparisons than this yields a spanning forest instead of its linked pairs.
FEW = 64
_CHUNK = 1 << 15
#: The number of the chain's first segment stands above the two segments of a key.
_RING_SHIFT = np.uint64(56)


def fingerprint(text: bytes, shingle: int) -> int:
    """The SimHash of a text: bit b is set if over half of the shingles' hashes have it set."""
    words = text.lower().split()
    if not words:
        return 0
    plain = b" ".join(words)
    end = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1)
    start = np.concatenate([[0], end[:-1]])
    n = max(1, len(words) - shingle + 1)
    stop = (end[-n:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(plain[a:b], SEED) for a, b in zip(start[:n].tolist(), stop, strict=True)], dtype="<u8")
    votes = np.zeros(BITS, dtype=np.int64)
    for at in range(0, n, _CHUNK):
        bits = np.unpackbits(hashes[at : at + _CHUNK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * votes > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """(doc_id, th, fp) per row: a hash of the text, and the 64 bits as a signed number."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches):
            found = np.array([fingerprint(t, shingle) for t in texts_of(batch.column("text"))], dtype="<u8")
            columns = [batch.column("doc_id"), batch.column("th"), pa.array(found.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "th", "fp"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", F.xxhash64(text).alias("th"), text.alias("text"))
    return rows.mapInArrow(hashed, f"doc_id {kind}, th long, fp long")


def segments(radius: int) -> list[tuple[int, int]]:
    """(first bit, width) of the radius + 1 segments of the ring."""
    if radius < 2:
        raise ValueError("the join key has room for a radius of 2 or more")
    cuts = [round(i * BITS / (radius + 1)) for i in range(radius + 2)]
    return [(a, b - a) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def _segment(fp: np.ndarray, at: tuple[int, int]) -> np.ndarray:
    return (fp >> np.uint64(at[0])) & np.uint64((1 << at[1]) - 1)


def _ring_keys(radius: int):
    ring = segments(radius)

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = batch.column("fp").to_numpy().view(np.uint64)
            for at in range(0, len(whole), _CHUNK):
                fp = whole[at : at + _CHUNK]
                for i, (here, after) in enumerate(zip(ring, ring[1:] + ring[:1], strict=True)):
                    head = (np.uint64(i) << _RING_SHIFT) | (_segment(fp, here) << np.uint64(after[1]))
                    tail = _segment(fp, after)
                    parts = [(head | tail, fp, False)]
                    for bit in range(after[1]):
                        clear = (tail >> np.uint64(bit)) & np.uint64(1) == 0
                        parts.append(((head | tail | np.uint64(1 << bit))[clear], fp[clear], True))
                    key = np.concatenate([p[0] for p in parts])
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(key.view(np.int64)),
                            pa.array(np.concatenate([np.full(len(p[0]), p[2]) for p in parts])),
                            pa.array(np.concatenate([p[1] for p in parts]).view(np.int64)),
                        ],
                        names=["key", "flipped", "fp"],
                    )

    return keys


def _linked(a: np.ndarray, b: np.ndarray, start: np.ndarray, radius: int) -> np.ndarray:
    """Pairs that pass every chain from their start segment; the last chain is the whole distance."""
    ring = np.array(segments(radius), dtype=np.uint64)
    m = radius + 1
    apart, total, ok = a ^ b, np.zeros(len(a), dtype=np.int64), np.ones(len(a), dtype=bool)
    for step in range(m):
        at = ring[(start + step) % m]
        part = (apart >> at[:, 0]) & ((np.uint64(1) << at[:, 1]) - np.uint64(1))
        total += np.bitwise_count(part)
        ok &= total * m <= (step + 1) * radius
    return ok


def _forest(fp: np.ndarray, n_base: int, start: int, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what all links of one key connect, one link fewer than members at most."""
    group = np.arange(len(fp))
    left, right = [], []
    for i in range(n_base):
        ok = _linked(np.full(len(fp), fp[i]), fp, np.full(len(fp), start), radius) & (group != group[i])
        if ok.any():
            joined, first = np.unique(group[ok], return_index=True)
            left.append(np.full(len(first), fp[i]))
            right.append(fp[np.flatnonzero(ok)[first]])
            group[np.isin(group, joined)] = group[i]
    none = np.empty(0, dtype=np.uint64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def _links_of(key: np.ndarray, flipped: np.ndarray, fp: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links among whole groups of equal keys, rows sorted by key with unflipped ones first."""
    cut = np.flatnonzero(np.diff(key)) + 1
    begin, end = np.concatenate([[0], cut]), np.concatenate([cut, [len(key)]])
    base = np.add.reduceat((~flipped).astype(np.int64), begin)
    size = end - begin
    work = base * (size - 1)
    lefts, rights = [], []
    for g in np.flatnonzero(work > FEW):
        a, b = _forest(fp[begin[g] : end[g]], int(base[g]), int(key[begin[g]]) >> 56, radius)
        lefts.append(a)
        rights.append(b)
    some = np.flatnonzero((work > 0) & (work <= FEW))
    if len(some):
        # Each base row meets the rows after it in its group.
        group = np.repeat(some, base[some])
        row = np.arange(len(group)) - np.repeat(np.cumsum(base[some]) - base[some], base[some]) + begin[group]
        after = end[group] - row - 1
        a = np.repeat(row, after)
        b = np.arange(len(a)) - np.repeat(np.cumsum(after) - after, after) + a + 1
        ok = _linked(fp[a], fp[b], key[a] >> 56, radius)
        lefts.append(fp[a][ok])
        rights.append(fp[b][ok])
    none = np.empty(0, dtype=np.uint64)
    return np.concatenate([none, *lefts]), np.concatenate([none, *rights])


def _link_groups(radius: int):
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[np.ndarray] | None = None
        for batch in _chained(batches):
            if batch is None:
                now, rest = rest, None
            else:
                columns = [batch.column("key").to_numpy(), batch.column("flipped").to_numpy(zero_copy_only=False), batch.column("fp").to_numpy().view(np.uint64)]
                if rest is not None:
                    columns = [np.concatenate(x) for x in zip(rest, columns, strict=True)]
                last = int(np.searchsorted(columns[0], columns[0][-1]))
                now, rest = [c[:last] for c in columns], [c[last:] for c in columns]
            if now is None or not len(now[0]):
                continue
            a, b = _links_of(*now, radius)
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    return found


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    """The batches that have rows, then a None that ends the last group."""
    for batch in batches:
        if batch.num_rows:
            yield batch
    yield None


def links(fps: DataFrame, radius: int = 4) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp`` that connect all within the radius."""
    keys = fps.select("fp").distinct().mapInArrow(_ring_keys(radius), "key long, flipped boolean, fp long")
    sorted_keys = keys.repartition("key").sortWithinPartitions("key", "flipped")
    return sorted_keys.mapInArrow(_link_groups(radius), "a long, b long")


def _grouped(docs: DataFrame, shingle: int, radius: int) -> DataFrame:
    """Per row: doc_id, th (hash of the text), fp, root (its component) and component_id."""
    rows = durable(fingerprints(docs, shingle))
    distinct = durable(rows.groupBy("fp").agg(F.min("doc_id").alias("first")))
    root = components(links(distinct, radius)).select(F.col("node").alias("fp"), "root")
    placed = durable(distinct.join(root, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root")))
    least = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    return rows.join(placed.join(least, "root").select("fp", "root", "component_id"), "fp")


def near_duplicates(docs: DataFrame, shingle: int = 4, radius: int = 4) -> DataFrame:
    """Per row: doc_id, fingerprint (16 hex digits) and component_id (smallest doc_id reachable)."""
    return _grouped(docs, shingle, radius).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_first(docs: DataFrame, shingle: int = 4, radius: int = 4) -> DataFrame:
    """One row of each component, with all its columns: smallest doc_id (nulls last), then text hash."""
    return first_of_groups(docs, _grouped(docs, shingle, radius))


def first_of_groups(docs: DataFrame, grouped: DataFrame) -> DataFrame:
    """One row of ``docs`` of each root in ``grouped``, which has doc_id, th and root of every row."""
    rows = grouped.groupBy("root", "doc_id", "th").agg(F.count("*").alias("n"))
    best = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "th", "n")).alias("best")
    first = durable(rows.groupBy("root").agg(best).select(F.col("best.doc_id").alias("kept_id"), "best.th", "best.n"))

    def rows_of(chosen: DataFrame) -> DataFrame:
        same = docs["doc_id"].eqNullSafe(chosen["kept_id"]) & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == chosen["th"])
        return docs.join(chosen, same, "left_semi")

    kept, again = rows_of(first.filter("n = 1")), first.filter("n > 1")
    if again.isEmpty():
        return kept
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    repeated = rows_of(again).select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("th"), whole)
    return kept.union(repeated.dropDuplicates(["doc_id", "th"]).select("row.*"))
