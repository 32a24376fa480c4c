"""Benchmark decontamination: item-sized windows of documents that nearly repeat a benchmark item.

Words are runs of letters and digits, lower-cased.  A window of as many words as the item is compared
with it by the 64-bit SimHash of its five-word shingles.  Fingerprints are cut into radius + 1
blocks; two within the radius agree in a whole block, so an equi-join over blocks finds all of them.
Candidates are verified by the exact weighted Jaccard similarity of their shingles, where a shingle
weighs as often as it occurs.

Only windows that hold a shingle of the item, laid over it, are fingerprinted; any other has
similarity zero.  Everything is DataFrame operations.  The shingles of the benchmark are broadcast
only after they have been counted; a larger benchmark is joined by shuffling.  The radius of 20 of
64 bits keeps a pair of similarity 0.8 (9.7 expected differing bits) with a chance of 99.9 percent,
exact copies always.

Cases: an item of fewer than five words has its whole sequence as its only shingle; an item without
words is skipped.  A document shorter than an item is one window.  A null text has no words.  A null
doc_id or item_id is kept.  Repeated rows (same id and text) give one row; equal items give one row
each.  Of equally similar windows the first is reported.  Extra columns are ignored.  Empty tables
give no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleslane.plans.durable import durable

SHINGLE = 5
#: Shingles of the benchmark (about 40 bytes each) up to which they are broadcast.
BROADCAST_ROWS = 500_000
#: A lane counts set bits of one place; 32 bits hold the shingles of any text.
_LANE_BITS = 32
_LANES = sum(1 << s for s in range(0, 64, _LANE_BITS))
_MISSING = -(1 << 63)


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def _shingled(df: DataFrame, keep: list[str], size: int) -> DataFrame:
    """Rows (keep, pos, h) of each place in ``words`` with the hash of the ``size`` words there."""
    names = [f"w{i}" for i in range(size)]
    shifted = [F.slice("words", i + 1, F.greatest(F.size("words"), F.lit(1))).alias(n) for i, n in enumerate(names)]
    zipped = df.select(*keep, *shifted).select(*keep, F.posexplode(F.arrays_zip(*names)).alias("pos", "z"))
    return zipped.filter(F.col(f"z.w{size - 1}").isNotNull()).select(*keep, "pos", F.xxhash64(*(F.col(f"z.{n}") for n in names)).alias("h"))


def _fingerprints(shingles: DataFrame, key: list[str]) -> DataFrame:
    """(key, fp, m): majority bits of the m hashes of a key, counted in two lanes of 32 bits."""
    sums = [F.sum(F.shiftrightunsigned("h", b).bitwiseAND(F.lit(_LANES))).alias(f"s{b}") for b in range(_LANE_BITS)]
    counted = shingles.groupBy(*key).agg(F.count("*").alias("m"), *sums)
    bits = [
        F.when(
            2 * F.shiftrightunsigned(f"s{b}", lane).bitwiseAND(F.lit((1 << _LANE_BITS) - 1)) > F.col("m"),
            F.lit((1 << (b + lane)) - (1 << 64 if b + lane == 63 else 0)),
        ).otherwise(F.lit(0).cast("long"))
        for lane in range(0, 64, _LANE_BITS)
        for b in range(_LANE_BITS)
    ]
    return counted.select(*key, "m", reduce(lambda a, b: a.bitwiseOR(b), bits).alias("fp"))


def _blocks(fp: Column, radius: int) -> Column:
    """(number, bits) of the radius + 1 blocks of a fingerprint."""
    cuts = [i * 64 // (radius + 1) for i in range(radius + 2)]
    return F.array(
        *(
            F.struct(F.lit(i).alias("block"), F.shiftrightunsigned(fp, a).bitwiseAND(F.lit((1 << (b - a)) - 1)).alias("bits"))
            for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True))
        )
    )


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(
        "doc_id",
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_MISSING)).alias("did"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("th"),
        words_of(F.col("text")).alias("words"),
    )


def _leaks_of_size(docs: DataFrame, items: DataFrame, size: int, radius: int, threshold: float) -> DataFrame:
    """Leaks of the items whose shingles have ``size`` words."""
    item_shingles = durable(_shingled(items, ["ikey", "n"], size))
    few = item_shingles.count() <= BROADCAST_ROWS
    sides = item_shingles.select("ikey", "n", F.col("pos").alias("at"), "h")
    doc_shingles = _shingled(docs.withColumn("n_doc", F.size("words")), ["did", "th", "n_doc"], size)
    windows = (
        doc_shingles.join(F.broadcast(sides) if few else sides, "h")
        .withColumn("s", F.greatest(F.lit(0), F.least(F.col("pos") - F.col("at"), F.col("n_doc") - F.col("n"))))
        .groupBy("did", "th")
        .agg(F.collect_set(F.struct("ikey", "n", "s")).alias("windows"))
    )
    # The words of a document are bound once, then cut for each of its windows.
    cut = F.transform(
        F.array("words"),
        lambda ws: F.transform(
            "windows",
            lambda w: F.struct(w["ikey"].alias("ikey"), w["s"].alias("s"), F.slice(ws, w["s"] + 1, w["n"]).alias("words")),
        ),
    )[0]
    inside = docs.join(windows, ["did", "th"]).select("did", "th", F.explode(cut).alias("w")).select("did", "th", "w.*")
    # Repeated rows have the same windows.
    key = ["did", "th", "ikey", "s"]
    shingles = durable(_shingled(inside.dropDuplicates(key), key, size))
    prints = durable(_fingerprints(shingles, key).withColumn("part", F.explode(_blocks(F.col("fp"), radius))).select(*key, "m", "fp", "part.*"))
    item_prints = _fingerprints(item_shingles, ["ikey"]).select(
        "ikey", F.col("m").alias("item_m"), F.col("fp").alias("item_fp"), F.explode(_blocks(F.col("fp"), radius)).alias("part")
    ).select("ikey", "item_m", "item_fp", "part.*")
    near = (
        prints.join(item_prints, ["ikey", "block", "bits"])
        .withColumn("hamming", F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))))
        .filter(F.col("hamming") <= radius)
        .select(*key, "m", "item_m", "hamming")
        .distinct()
    )
    held = shingles.groupBy(*key, "h").agg(F.count("*").alias("times"))
    wanted = item_shingles.groupBy("ikey", "h").agg(F.count("*").alias("item_times"))
    common = (
        held.join(wanted, ["ikey", "h"])
        .groupBy(*key)
        .agg(F.sum(F.least("times", "item_times")).alias("common"))
    )
    return (
        near.join(common, key)
        .withColumn("similarity", F.col("common") / (F.col("m") + F.col("item_m") - F.col("common")))
        .filter(F.col("similarity") >= threshold)
        .groupBy("did", "th", "ikey")
        .agg(F.max(F.struct("similarity", (-F.col("s")).alias("s"), "hamming")).alias("best"))
    )


def leaks(docs: DataFrame, benchmark: DataFrame, radius: int = 20, threshold: float = 0.8) -> DataFrame:
    """(did, th, doc_id, item_id, start_word, n_words, hamming, similarity) of each leak's best window."""
    text = F.coalesce("text", F.lit(""))
    items = benchmark.select(
        "item_id", F.xxhash64("item_id", text).alias("ikey"), words_of(F.col("text")).alias("words")
    ).withColumn("n", F.size("words"))
    items = durable(items.filter("n > 0").dropDuplicates(["ikey"]))
    keyed = _keyed(docs)
    # At most five different sizes.
    sizes = [r["k"] for r in items.select(F.least(F.lit(SHINGLE), "n").alias("k")).distinct().collect()]
    found = [
        _leaks_of_size(keyed, items.filter(F.least(F.lit(SHINGLE), F.col("n")) == k), k, radius, threshold) for k in sorted(sizes)
    ]
    if not found:
        empty = "did long, th long, doc_id long, item_id long, start_word int, n_words int, hamming int, similarity double"
        return docs.sparkSession.createDataFrame([], empty)
    missing = F.col("did") != F.lit(_MISSING)
    return reduce(DataFrame.union, found).join(items.select("ikey", "item_id", "n"), "ikey").select(
        "did",
        "th",
        F.when(missing, F.col("did")).alias("doc_id"),
        "item_id",
        (-F.col("best.s")).alias("start_word"),
        F.col("n").alias("n_words"),
        F.col("best.hamming").alias("hamming"),
        F.col("best.similarity").alias("similarity"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, radius: int = 20, threshold: float = 0.8) -> DataFrame:
    """The rows of ``docs`` in which no item leaks, with all their columns."""
    found = durable(leaks(docs, benchmark, radius, threshold).select("did", "th").distinct())
    keys = [
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_MISSING)) == found["did"],
        F.xxhash64(F.coalesce(F.col("text"), F.lit(""))) == found["th"],
    ]
    return docs.join(found, keys[0] & keys[1], "left_anti")
