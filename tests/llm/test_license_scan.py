import random

from saleslane.llm import license_scan as op

SCHEMA = "doc_id long, text string"


def corpus():
    rng = random.Random(2)
    prose = lambda: " ".join(rng.choice("ande erst thon the of work files are there und licence".split()) for _ in range(rng.randint(3, 30)))
    rows, want = [], set()
    for i in range(120):
        lines = [prose() for _ in range(rng.randint(1, 6))]
        if i % 3 == 0:
            family = rng.choice(list(op.NOTICES))
            at = rng.randrange(len(lines) + 1)
            lines.insert(at, rng.choice(op.NOTICES[family]))
            want.add((i, at, family))
        rows.append((i, "\n".join(lines)))
    return rows, want


def test_planted_notices_are_found_and_nothing_else(spark):
    rows, want = corpus()
    mit = op.NOTICES["mit"][0]
    rows += [(900, None), (901, ""), (902, f"{mit}\n\n{mit}"), (None, mit), (903, mit), (903, mit), (904, "The MIT campus.\nlicense of the public version 3")]
    want |= {(902, 0, "mit"), (902, 2, "mit"), (None, 0, "mit"), (903, 0, "mit")}
    docs = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA + ", family string")
    got = op.find(docs, op.train(spark, docs)).collect()
    assert {(r.doc_id, r.paragraph, r.family) for r in got} == want
    assert len(got) == len(want) + 1
    assert all(0.5 <= r.probability <= 1 and r.coverage == 1 for r in got)


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert op.find(docs, op.train(spark, docs)).count() == 0


def test_coverage_compares_word_pairs():
    assert op.coverage("released UNDER the mit license", "mit") == 1
    assert op.coverage("the mit", "mit") == 0.25


def test_reserved_rights_and_wrapped_notices_are_found(spark):
    gpl, mit = op.NOTICES["gpl-3.0"][1].split(), op.NOTICES["mit"][1].split()
    rows = corpus()[0]
    rows += [
        (800, "erst thon of\nAll rights reserved.\nund there"),
        (801, "of the\n\n" + "\n".join(" ".join(gpl[i : i + 8]) for i in range(0, len(gpl), 8)) + "\n\nund of"),
        (802, "\n".join(mit)),
        (803, " ".join(gpl[:8]) + "\n\n" + " ".join(gpl[8:14])),
    ]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = op.find(docs, op.train(spark, docs)).filter("doc_id >= 800").collect()
    assert sorted((r.doc_id, r.paragraph, r.family) for r in got) == [(800, 1, "all-rights-reserved"), (801, 2, "gpl-3.0"), (802, 0, "mit")]


def test_a_frequent_line_counts_once_in_the_sample(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "\n".join(["erst thon"] * 50 + [f"ande {i}"])) for i in range(20)], SCHEMA)
    seen = []
    stored = op.linear.stored
    monkeypatch.setattr(op.linear, "stored", lambda rows: seen.append(stored(rows)) or seen[-1])
    op.train(spark, docs)
    known = len(op.variants(op.LicenseConfig()))
    assert seen[0].count() == known + 21
