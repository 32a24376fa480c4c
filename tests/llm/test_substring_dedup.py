import hashlib
import random

import pytest

from saleslane.llm import substring_dedup as op

SCHEMA = "doc_id long, text string"


def brute(rows, length):
    texts = [(d, (t or "").encode()) for d, t in rows]
    where = {}
    for i, (_, t) in enumerate(texts):
        for p in range(len(t) - length + 1):
            where.setdefault(t[p : p + length], []).append((i, p))
    out = []
    for i, (d, t) in enumerate(texts):
        hit = bytearray(len(t))
        for p in range(len(t) - length + 1):
            if len(where[t[p : p + length]]) > 1:
                hit[p : p + length] = b"\1" * length
        kept = bytes(b for b, h in zip(t, hit, strict=True) if not h)
        spans = sum(1 for p in range(len(t)) if hit[p] and (p == 0 or not hit[p - 1]))
        out.append((d, len(t), sum(hit), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def run(spark, rows, length):
    found = op.remove_repeats(spark.createDataFrame(rows, SCHEMA), length).drop("spans").collect()
    return sorted((tuple(r) for r in found), key=repr)


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abé ") for _ in range(rng.randint(1, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    shared = [prose(n) for n in (12, 20, 60)]
    rows = [(i, prose(rng.randint(0, 30)) + rng.choice(shared) + prose(rng.randint(0, 30))) for i in range(40)]
    rows += [(100 + i, rows[0][1]) for i in range(6)]
    edited = rows[1][1]
    for i in range(12):
        at = rng.randrange(len(edited))
        rows.append((200 + i, edited[:at] + "#" + edited[at + 1 :]))
    rows += [(300, "a" * 300), (301, "ab" * 200), (302, None), (303, ""), (304, "short"), (305, shared[2] + shared[2])]
    rows += [(None, shared[1]), (None, shared[1]), (7, rows[7][1])]
    return rows


@pytest.mark.parametrize(("seed", "length"), [(1, 32), (2, 60), (3, 100)])
def test_matches_brute_force(spark, seed, length):
    rows = corpus(seed)
    assert run(spark, rows, length) == brute(rows, length)


def test_long_texts_are_cut_into_slices(spark, monkeypatch):
    rng = random.Random(5)
    base = "".join(rng.choice("abcdefgh ") for _ in range(9000))
    rows = [(1, base), (2, base[2000:2600] + base[::-1]), (3, base[100:7000])]
    samples = lambda: {
        tuple(r) for r in spark.createDataFrame(
            [x for t in rows for batch in op._sampler(64)(iter([_batch(t)])) for x in batch.to_pylist()]
        ).collect()
    }
    whole = samples()
    monkeypatch.setattr(op, "SLICE_BYTES", 700)
    assert samples() == whole
    assert len(whole) > 300


def _batch(row):
    import pyarrow as pa

    return pa.RecordBatch.from_pydict(
        {"did": pa.array([row[0]], pa.int64()), "th": pa.array([0], pa.int64()), "text": [row[1]]}
    )


def test_empty_table(spark):
    assert run(spark, [], 400) == []


def test_extra_columns_with_clashing_names(spark):
    rows = [(i, "x" * 500, 1, 2, "s") for i in (1, 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, did long, pos long, spans string")
    assert {r.n_removed for r in op.remove_repeats(df).collect()} == {500}


def test_merge_spans():
    assert op.merge_spans([5, 0, 3], [9, 2, 5]) == [(0, 2), (3, 9)]
