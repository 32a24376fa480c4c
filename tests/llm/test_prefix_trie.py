import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from saleslane.llm import prefix_trie as op
from saleslane.llm import queries

SCHEMA = "conv_id long, turn int, role string, text string"
SF_DIR = "/root/testdata/sf0.001"


def rebuilt(rows):
    """conv_id to list of (role, text), by plain loops; rows with equal turns are alike here."""
    own = defaultdict(list)
    for c, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        own[c].append((role or "", text or ""))
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - c % 5, [])[:h] + turns[h:]
    return out


def brute(convs):
    members = defaultdict(list)
    for c in sorted(convs):
        for d in range(len(convs[c]) + 1):
            members[tuple(convs[c][:d])].append(c)
    children = defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, inside in members.items():
        gain = (len(inside) - 1) * len(node[-1][1].encode()) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in children
            saved[node[:d]] += gain
    rows = []
    for node, inside in members.items():
        ends = ",".join(str(c) for c in inside if len(convs[c]) == len(node))
        parent = members[node[:-1]][0] if node else None
        rows.append((inside[0], len(node), parent, len(inside), children.get(node, 0), leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(rows, key=repr)


def conversations():
    rng = random.Random(6)
    rows = []
    for c in range(90):
        first = rng.choice("ab")
        texts = [first] + [rng.choice("xyé") for _ in range(rng.choice([0, 1, 3, 4, 7, 8, 9, 13]))]
        rows += [(c, t if t else None, rng.choice(["user", "user", None]), x) for t, x in enumerate(texts)]
    rows += [(c, t, "user", "same" if t < 30 else f"{t}{c % 2}") for c in (100, 101, 102, 103, 500) for t in range(45)]
    rows += [(301, 0, "u", "own"), (302, 3, None, None), (None, 1, "u", "lost"), (777, 0, "r", "long " * 30_000)]
    return rows


@pytest.mark.parametrize(("block", "stretch", "piece"), [(1, 4096, 1), (4, 2, 9), (5, 4096, 1 << 16)])
def test_nodes_equal_brute_force(spark, monkeypatch, block, stretch, piece):
    monkeypatch.setattr(op, "STRETCH", stretch)
    monkeypatch.setattr(op, "PIECE_BYTES", piece)
    rows = conversations()
    turns = op.ordered(spark.createDataFrame([(*r, 0, 1) for r in rows], SCHEMA + ", pos int, d1 int").repartition(5))
    from pyspark.sql import functions as F

    conv = F.col("conv_id")
    members, new = op.rebuild(turns, conv - conv % 5, F.crc32(conv.cast("string").cast("binary")) % 9, 8)
    got = op.trie(members, new, block)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rebuilt(rows))
    if block == 5:
        texts = {(r.conv_id, r.depth): r.text for r in op.node_texts(got, new).collect()}
        want = rebuilt(rows)
        assert all(t == (want[c][d - 1][1] if d else None) for (c, d), t in texts.items())


def test_ties_repeated_rows_and_empty(spark):
    rows = [(1, 0, "u", "b"), (1, 0, "u", "a"), (1, 0, "u", "a"), (2, 5, "u", "a"), (2, 5, "u", "a"), (2, 5, "u", "b")]
    df = spark.createDataFrame(rows, SCHEMA)
    turns = op.ordered(df)
    members = turns.groupBy("conv_id").count().toDF("conv_id", "n_turns")
    got = op.trie(members, turns).collect()
    assert len(got) == 4 and {r.n_convs for r in got} == {2}
    empty = op.ordered(spark.createDataFrame([], SCHEMA))
    assert op.trie(empty.groupBy("conv_id").count().toDF("conv_id", "n_turns"), empty).count() == 0


def test_query_on_the_given_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = queries.op12_prefix_trie(spark, SF_DIR).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rebuilt(rows))
