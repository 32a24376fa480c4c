import random
import zlib

import numpy as np
import pytest

from saleslane.llm import toxicity as op
from saleslane.llm.blocks import Block

SMALL = op.ToxicityConfig(min_rows=3, neighbours=9)


def test_nearest_examples_are_exact():
    rng = np.random.default_rng(4)
    vectors = rng.random((500, 60)) * (rng.random((500, 60)) < 0.08)
    vectors[7] = vectors[8] = vectors[300]
    length = np.sqrt((vectors**2).sum(axis=1, keepdims=True))
    vectors = np.divide(vectors, length, out=np.zeros_like(vectors), where=length > 0).astype(np.float32)
    example, term = np.nonzero(vectors)
    index = op.Index(500, 60, 16, term, example, vectors[example, term])
    for query in vectors[::9]:
        t = np.flatnonzero(query)
        found, sims = index.nearest(t, query[t], 12)
        exact = vectors @ query
        best = [i for i in np.lexsort((np.arange(500), -exact.round(5)))[:12] if exact[i] > 0]
        assert np.allclose(np.sort(sims), np.sort(exact[best]), atol=1e-5)
        assert np.allclose(exact[found], sims, atol=1e-5)


def test_terms_are_words_and_beginnings():
    block = Block([b"ab, abcdef abcdef", b"", b"\xc3\xa9t\xc3\xa9s!"])
    found, doc = op.terms(block, (4,))
    assert np.bincount(doc, minlength=3).tolist() == [5, 0, 2]
    assert len(set(found.tolist())) == 5


def corpus(n=600):
    rng = random.Random(6)
    fill = [a + b for a in ("lo", "ma", "ri", "tu", "pe") for b in ("ka", "sen", "dor", "mil", "vant")]
    rows, labels = [], []
    for i in range(n):
        bad = rng.random() < 0.2
        words = [rng.choice(fill) for _ in range(60)]
        for _ in range(6 * bad):
            words[rng.randrange(60)] = rng.choice(["vilest", "odious", "grimly", "foulness"])
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    return rows, labels


def test_held_out_accuracy_and_evidence(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame([*rows, (None, None), (9999, ""), rows[3]], "doc_id long, text string")
    known = spark.createDataFrame([*labels, (5, None), (None, 1)], "doc_id long, toxic int")
    got = op.score(docs, op.train(docs, known, SMALL), SMALL).collect()
    truth = dict(labels)
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert {r.doc_id for r in held} == {i for i, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0}
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert all(zlib.crc32(str(e.doc_id).encode()) % 5 for r in got for e in r.evidence)
    assert len(got) == len(rows) + 3 and all(r.score < 0.5 for r in got if r.doc_id in (None, 9999))
    scores = [r.score for r in got if r.doc_id == rows[3][0]]
    assert len(scores) == 2 and scores[0] == scores[1]


@pytest.mark.parametrize(("labels", "want"), [([], 0.5), ([(1, 1)], 1.0), ([(1, 0), (2, 0)], 0.0)])
def test_without_both_classes(spark, labels, want):
    docs = spark.createDataFrame([(1, "x y", 0.1), (2, None, 0.2)], "doc_id long, text string, score double")
    model = op.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), SMALL)
    assert [r.score for r in op.score(docs, model, SMALL).collect()] == [want, want]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    model = op.train(docs, spark.createDataFrame([], "doc_id long, toxic int"), SMALL)
    assert op.score(docs, model, SMALL).count() == 0
