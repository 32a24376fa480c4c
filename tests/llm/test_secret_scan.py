import hashlib
import random
import re

from saleslane.llm import secret_scan as op

SCHEMA = "doc_id long, text string, source string"
CONFIG = op.SecretConfig(min_count=5, trees=15)


def corpus(n=240):
    rng = random.Random(7)
    prose = lambda: " ".join(rng.choice("an erst thon the of work files are there".split()) for _ in range(12))
    digits = lambda k, a: "".join(rng.choice(a) for _ in range(k))
    rows, truth = [], {}
    for i in range(n):
        kind = i % 4
        middle = ['token = "' + digits(40, "0123456789abcdef") + '"', digits(16, "0123456789"), "thefileswork2thereworkfiles", "plain"][kind]
        rows.append((i, f"{prose()} {middle} {prose()}", "src/code.py" if i % 2 else None))
        if kind != 3:
            truth[i] = kind == 0
    return rows, truth


def test_forest_keeps_secrets_and_drops_the_rest(spark):
    rows, truth = corpus()
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", length int, candidate string")
    labels = op.rule_labels(docs).filter("doc_id < 120")
    got = op.scan(docs, labels, CONFIG).collect()
    assert {r.doc_id: r.found for r in got} == truth and len(got) == len(truth)
    for r in got:
        words = re.split("[\x20\x09-\x0d]+", rows[r.doc_id][1])
        run = re.search(op.CANDIDATE, words[r.word]).group()
        assert (r.length, r.sha256) == (len(run), hashlib.sha256(run.encode()).hexdigest())


def test_candidates_match_brute_force(spark):
    texts = [None, "", "a1" * 8, "x" * 20, "k=" + "a1" * 9 + " b", "é " + "1" * 15 + "\n" + "1" * 16, ("q9" * 9 + " ") * 3, "z" * 60000 + "1", "b2" * 9 + ":" + "y" * 17 + "=c3" + "d" * 20 + "."]
    docs = spark.createDataFrame([(i, t, "p") for i, t in enumerate(texts)] + [(None, "a1" * 8, None)] * 2, SCHEMA)
    want = []
    for i, t in [*enumerate(texts), (None, "a1" * 8), (None, "a1" * 8)]:
        for n, w in enumerate(re.split("[\x20\x09-\x0d]+", t or "")):
            for k, m in enumerate(re.findall(op.CANDIDATE, w)):
                if re.search("[0-9]", m):
                    want.append((i, n, k, m))
    got = [(r.doc_id, r.word, r.part, r.candidate) for r in op.candidates(docs).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_without_labels_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a1" * 10, "s")], SCHEMA)
    none = spark.createDataFrame([(1, 0, None)], "doc_id long, word int, label int")
    for labels in (None, none):
        row = op.scan(docs, labels, CONFIG).first()
        assert (row.doc_id, row.score, row.found) == (1, None, True)
    assert op.scan(docs.limit(0), none, CONFIG).count() == 0
