import random
import re
from collections import Counter

import pytest

from saleslane.llm import quality as op

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    grams = Counter(zip(words, words[1:], words[2:]))
    hit = {i + k for i, g in enumerate(zip(words, words[1:], words[2:])) if grams[g] > 1 for k in range(3)}
    n = len(words)
    failed = n < 50 or 100 * len(hit) > 50 * n
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(hit), failed


TEXTS = [
    None, "", " \n\t ", "one", "a b c a b c a b", "é ü x ñ y", "x\n\nx\n x\nx", "## ** <a> | & % $",
    "line one\nline one\n\nline two\nline one", "w " * 400, "a\rb\x0bc\x0cd e", "é" * 5000 + " " + "z" * 3000,
    " ".join(f"w{i}" for i in range(200)), " ".join(f"w{i % 60}" for i in range(200)),
]


def test_base_counts(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, TEXTS[8]), (8, TEXTS[8])]
    got = op.score(spark.createDataFrame(rows, "doc_id long, text string"), None).drop("kept", "probability").collect()
    want = [(d, *brute(t)) for d, t in rows]
    assert sorted((tuple(r) for r in got), key=repr) == sorted(want, key=repr)


def labelled(n=400, seed=0):
    rng = random.Random(seed)
    good = ["river", "stone", "and", "walks", "over", "green", "evening", "the", "house", "speaks"]
    rows = []
    for i in range(n):
        bad = i % 5 == 0
        words = [rng.choice(good) + rng.choice(["", "s", "ly"]) + ("&&&" if bad else "") for _ in range(80)]
        rows.append((i, " ".join(words), int(not bad)))
    return rows


def test_held_out_rows_are_judged_as_labelled(spark):
    rows = labelled()
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows if r[0] % 2], "doc_id long, quality int")
    got = {r.doc_id: r for r in op.score(docs, op.train(docs, labels)).collect()}
    right = [got[d].kept == (bool(q) and not got[d].base_failed) for d, _, q in rows if d % 2 == 0]
    assert sum(right) / len(right) > 0.97
    assert all(0 <= r.probability <= 1 for r in got.values())


@pytest.mark.parametrize("labels", [[], [(1, 1), (2, 1)], [(1, None), (None, 0)]])
def test_without_both_classes_the_rules_decide(spark, labels):
    docs = spark.createDataFrame([(1, "a " * 3), (2, TEXTS[12])], "doc_id long, text string")
    model = op.train(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
    assert model is None
    assert {r.doc_id: (r.kept, r.probability) for r in op.score(docs, model).collect()} == {1: (False, None), 2: (True, None)}


def test_empty_table_and_extra_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert op.score(empty, None).count() == 0
    extra = spark.createDataFrame([(1, "a b", True, 3)], "doc_id long, text string, kept boolean, n_words int")
    assert op.score(extra, None).first().n_words == 2
