import random
import re

import numpy as np
import pytest
import xxhash

from saleslane.llm import simhash as op
from saleslane.llm.components import components

UPPER = {i: i + 32 for i in range(ord("A"), ord("Z") + 1)}


def brute_print(text):
    words = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(UPPER))
    if not words:
        return 0
    grams = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(prints):
    """Smallest member of each component of numbered fingerprints, radius 4."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= 4:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(prints))]


def texts():
    rng = random.Random(3)
    make = lambda n: [rng.choice("Ann ber cid dÉf egg fox gnu".split()) + str(rng.randint(0, 30)) for _ in range(n)]
    out = [None, "", " \n", "one", "a b c", "A B C", "x " * 50]
    for n in (6, 40, 150, 400):
        base = make(n)
        out += [" ".join(base)] * 3
        for _ in range(12):
            near = list(base)
            near[rng.randrange(n)] = "Changed"
            out.append("\t\n".join(near))
    return out + [" ".join(make(80)) for _ in range(30)]


def test_matches_brute_force(spark):
    rows = list(enumerate(texts()))
    prints = [brute_print(t) for _, t in rows]
    groups = brute_groups(prints)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in op.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: (f"{p:016x}", g) for i, (p, g) in enumerate(zip(prints, groups, strict=True))}
    assert len(set(groups)) < len(rows) - 20


@pytest.mark.parametrize("few", [0, 64, 10**6])
def test_links_connect_all_within_the_radius(spark, monkeypatch, few):
    monkeypatch.setattr(op, "FEW", few)
    rng = random.Random(8)
    prints = {rng.getrandbits(64) for _ in range(60)}
    for p in list(prints)[:20]:
        for _ in range(6):
            q = p
            for _ in range(rng.randint(1, 6)):
                q ^= 1 << rng.randrange(64)
            prints.add(q)
    prints = sorted(prints)
    signed = np.array(prints, dtype=np.uint64).view(np.int64).tolist()
    pairs = [
        (r.a, r.b)
        for batch in [op._ring_keys(4)(iter([_column(signed)]))]
        for r in _sorted_links(batch)
    ]
    number = {p: i for i, p in enumerate(signed)}
    root = list(range(len(prints)))
    for a, b in pairs:
        assert (prints[number[a]] ^ prints[number[b]]).bit_count() <= 4
        x, y = root[number[a]], root[number[b]]
        root = [min(x, y) if r in (x, y) else r for r in root]
    assert root == brute_groups(prints)


def _column(signed):
    import pyarrow as pa

    return pa.RecordBatch.from_pydict({"fp": pa.array(signed, pa.int64())})


def _sorted_links(batches):
    import pyarrow as pa

    table = pa.Table.from_batches(list(batches)).sort_by([("key", "ascending"), ("flipped", "ascending")])
    for made in op._link_groups(4)(iter(table.combine_chunks().to_batches(max_chunksize=97))):
        yield from made.to_pandas().itertuples()


def test_null_ids_repeated_rows_extra_columns_and_empty(spark):
    rows = [(None, "q w e r t", 1), (5, "q w e r t", 1), (5, "q w e r t", 1), (None, "z1 z2 z3 z4 z5", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp int")
    got = sorted((str(r.doc_id), str(r.component_id)) for r in op.near_duplicates(df).collect())
    assert got == [("5", "5"), ("5", "5"), ("None", "5"), ("None", "None")]
    assert op.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_keep_first_keeps_one_row_of_each_component(spark):
    rows = [(None, "q w e r t", 1), (5, "q w e r t", 2), (5, "q w e r t", 3), (3, "Q w e r t", 4), (None, "z1 z2 z3 z4 z5", 0), (None, "z1 z2 z3 z4 z5", 0), (8, "m1 m2 m3 m4 m5 m6", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, th int")
    got = sorted(((r.doc_id, r.text) for r in op.keep_first(df).collect()), key=repr)
    assert got == [(3, "Q w e r t"), (8, "m1 m2 m3 m4 m5 m6"), (None, "z1 z2 z3 z4 z5")]
    assert op.keep_first(df).columns == df.columns


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(100, 140)]
    star = [(7, i) for i in range(8, 40)] + [(8, 8)]
    got = {r.node: r.root for r in components(spark.createDataFrame(chain + star, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 141)}, **{i: 7 for i in range(7, 40)}}


def test_keep_first_with_clashing_columns_and_repeated_rows(spark):
    names = "doc_id long, text string, kept_th int, th int, kept_id int, root int, n int, fp int, row int"
    rows = [(5, "q w e r t", *[i] * 7) for i in (1, 1, 2)] + [(9, "m1 m2 m3 m4 m5 m6", *[3] * 7)]
    df = spark.createDataFrame(rows, names)
    kept = op.keep_first(df)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [5, 9]
