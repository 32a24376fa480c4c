import random
from collections import defaultdict

import pytest

from saleslane.llm import mixing as op

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CONFIG = op.MixConfig(
    margins={"source": op.Margin(temper=0.5), "lang": op.Margin({"en": 0.4, "de": 0.4, "xx": 0.1}), "topic": op.Margin()}, budget=0.5
)


def corpus(n=900):
    rng = random.Random(4)
    rows = []
    for i in range(n):
        lang = rng.choice(["en"] * 6 + ["de", "fr", None])
        text = " ".join(["word"] * rng.randint(1, 300)) + rng.choice(["", "", " | x", "\n*** y"])
        rows.append((i, text, lang, rng.choice(["a"] * 5 + ["b", "c", None]), 1))
    return rows


def brute(cells, config):
    """Raked tokens by plain loops."""
    total = sum(cells.values())
    goals = []
    for axis, name in enumerate(op.KEYS):
        margin, own = config.margins[name], defaultdict(float)
        for cell, t in cells.items():
            own[cell[axis]] += t
        listed = {v: margin.shares[v] for v in own if v in margin.shares}
        rest = {v: t**margin.temper for v, t in own.items() if v not in listed}
        left = max(0.0, 1 - sum(margin.shares.values()))
        share = listed | {v: left * x / sum(rest.values()) for v, x in rest.items()}
        goals.append({v: total * s / sum(share.values()) for v, s in share.items()})
    fitted = {c: float(t) for c, t in cells.items()}
    for _ in range(400):
        for axis, goal in enumerate(goals):
            now = defaultdict(float)
            for cell, w in fitted.items():
                now[cell[axis]] += w
            fitted = {c: w * goal[c[axis]] / now[c[axis]] if now[c[axis]] else 0 for c, w in fitted.items()}
    return fitted, goals


def test_raking_sampling_and_budget(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, SCHEMA)
    got = op.plan(docs, CONFIG).collect()
    assert len(got) == len(rows)
    cells = defaultdict(int)
    for r in got:
        cells[(r.source, r.lang, r.topic)] += r.n_tokens
    fitted, goals = brute(cells, CONFIG)
    for r in got:
        cell = (r.source, r.lang, r.topic)
        assert r.weight == pytest.approx(fitted[cell] / cells[cell], rel=1e-5)
    total = sum(cells.values())
    assert sum(r.chance * r.n_tokens for r in got) == pytest.approx(0.5 * total, rel=1e-6)
    assert sum(r.n_tokens for r in got if r.taken) == pytest.approx(0.5 * total, rel=0.1)
    open_cells = [r for r in got if r.chance < 1]
    assert len({round(r.chance / r.weight, 6) for r in open_cells}) == 1
    taken = {r.doc_id for r in got if r.taken}
    kept = op.mix(docs, CONFIG)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == taken
    langs = defaultdict(float)
    for (_, lang, _), w in fitted.items():
        langs[lang] += w / total
    assert langs["en"] == pytest.approx(0.4 / 0.9, rel=1e-6)


def test_tokens_and_topics(spark):
    texts = [None, "", "a", " a\tb\nc ", "é ü"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    assert [r[0] for r in df.select(op.tokens_of(df.text)).collect()] == [0, 0, 1, 3, 2]


def test_large_budget_takes_all_and_ties_stay_together(spark):
    rows = [(1, "x y", "en", "a", 3), (1, "x y", "en", "a", 3), (None, None, None, None, None), (2, "", "en", "a", 0)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("tokens", __import__("pyspark").sql.functions.lit("t"))
    assert op.mix(docs, op.MixConfig(budget=2.0)).count() == 4
    half = op.plan(docs, op.MixConfig(budget=0.5)).filter("doc_id = 1").collect()
    assert half[0].taken == half[1].taken and half[0].chance == pytest.approx(0.5)


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert op.plan(empty).count() == 0 and op.mix(empty).count() == 0


def test_unlisted_languages_keep_a_share(spark):
    rows = [(i, f"w{i} " * 20, ["en", "de", "fr", "es", "it", None][i % 6], "a", 1) for i in range(600)]
    got = op.plan(spark.createDataFrame(rows, SCHEMA)).collect()
    taken = {lang: sum(r.taken for r in got if r.lang == lang) for lang in ("en", "it", None)}
    assert taken["it"] > 0 and taken[None] > 0 and all(r.weight > 0 for r in got)


def test_clashing_columns_are_kept(spark):
    names = ("mix_weight", "mix_tokens", "mix_source", "mix_lang", "mix_topic", "mix_chance", "row", "tokens", "a.b")
    schema = SCHEMA + "".join(f", `{n}` int" for n in names)
    docs = spark.createDataFrame([(1, "x y", "en", "a", 3, *range(9)), (2, "x z", "en", "a", 3, *range(9))], schema)
    got = op.mix(docs, op.MixConfig(budget=2.0))
    assert got.columns == docs.columns
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, docs.collect()))
    assert op.plan(docs).count() == 2


def test_margins_that_cannot_hold_are_reported(spark):
    rows = [(1, "a b c", "en", "s", 1), (2, "a b", "de", "t", 1)]
    margins = {"source": op.Margin({"s": 0.9, "t": 0.1}), "lang": op.Margin({"en": 0.2, "de": 0.8}), "topic": op.Margin()}
    with pytest.warns(UserWarning, match="still off"):
        op.plan(spark.createDataFrame(rows, SCHEMA), op.MixConfig(margins=margins, sweeps=6)).collect()
