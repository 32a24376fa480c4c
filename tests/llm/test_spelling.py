import itertools
import random
import zlib
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from saleslane.llm import queries
from saleslane.llm import spelling as op

SCHEMA = "doc_id long, text string"
SF_DIR = "/root/testdata/sf0.001"


def brute(rows):
    """All words, by plain loops; near words from each word's variants with a hole."""
    counts = Counter()
    for doc, text in rows:
        run = ""
        for ch in (text or "") + " ":
            if ("A" <= ch <= "Z") or ("a" <= ch <= "z") or ("À" <= ch <= "ÿ"):
                run += chr(ord(ch) + 32) if "A" <= ch <= "Z" else ch
            elif run:
                h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
                counts[run if h % 97 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
                run = ""
    counts = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    holes = defaultdict(set)
    for w in counts:
        for i in range(len(w)):
            holes[("replace", i, w[:i], w[i + 1 :])].add(w)
            holes[("delete", w[:i] + w[i + 1 :])].add(w)
    near = defaultdict(set)
    for key, inside in holes.items():
        if key[0] == "replace":
            for w in inside:
                near[w] |= inside - {w}
        elif key[1] in counts:
            near[key[1]] |= inside
            for w in inside:
                near[w].add(key[1])
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * n else None
    out = []
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), counts[form[w]] if form[w] else None))
    return sorted(out, key=repr)


def corpus():
    rng = random.Random(9)
    rows = []
    for i in range(60):
        texts = []
        for _ in range(60):
            w = "".join(rng.choice("abé") for _ in range(rng.choice([4, 5, 5, 6, 6, 7, 9])))
            texts.append(rng.choice([w, w.upper(), w.capitalize()]))
        rows.append((i, rng.choice([" ", "\n", "1", "×"]).join(texts)))
    rows += [(None, "aaaaa aaaaaa Öffnung ÖFFNUNG"), (7, None), (8, ""), (9, "banana " * 40_000), (9, "banane " * 9), (9, "banane " * 9)]
    return rows


@pytest.mark.parametrize("state_words", [2, 40, 20_000])
def test_groups_equal_brute_force(spark, state_words):
    rows = corpus()
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA + ", word int, n int").repartition(4)
    got = op.group(docs, state_words=state_words).select("word", "form", "root", "n", "n_near", "form_n")
    want = brute(rows)
    assert sorted(map(tuple, got.collect()), key=repr) == want
    assert len(want) > 100 and any(r[1] for r in want)


def test_pairs_of_a_dense_state_leave_in_batches():
    rows = [("word" + "".join(x), i) for i, x in enumerate(itertools.product("abcdefghijkl", repeat=3))]
    columns = {"m": [7], "head": [4], "tail": [0], "first": ["word"], "last": [""]}
    state = pa.table({k: v * len(rows) for k, v in columns.items()} | {"word": [w for w, _ in rows], "n": [n for _, n in rows]})
    made = list(op._enumerated(op.STATE_WORDS)(iter(state.to_batches())))
    assert sum(b.num_rows for b in made) == 12**3 * 11 * 3 // 2
    assert max(b.num_rows for b in made) <= 8192


def test_pairs_come_once_and_chains_lead_to_their_end(spark):
    rows = [(f"w{'x' * 6}{c}", n) for c, n in zip("abcd", (3, 6, 12, 24))] + [("aaaaaa", 9), ("aaaaa", 3), ("aaaaaaa", 18)]
    pairs = op.near_pairs(spark.createDataFrame(rows, "word string, n long"), state_words=3).collect()
    found = sorted((r.a, r.b) for r in pairs)
    assert len(found) == len(set(found)) == 6 + 2
    chain = spark.createDataFrame([(f"{i:03}", f"{i + 1:03}") for i in range(40)], "word string, form string")
    assert {r.root for r in op._roots(chain).collect()} == {"040"}


def test_empty_table(spark):
    assert op.group(spark.createDataFrame([], SCHEMA)).count() == 0


def test_query_on_the_given_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.op13_spelling(spark, SF_DIR).select("word", "form", "root", "n", "n_near", "form_n")
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)
