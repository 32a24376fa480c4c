import importlib
import sys

import duckdb
import pytest

import corpus_pipeline
from saleslane.llm import decontaminate, mixing, quality, queries, simhash, token_codes
from saleslane.plans.durable import durable

SF_DIR = "/root/testdata/sf0.001"


def test_run_equals_its_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, ids = docs.columns, [r.doc_id for r in docs.select("doc_id").collect()]
    counts = [len(ids)]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = durable(stage(spark, docs, SF_DIR))
        assert docs.columns == columns
        kept = [r.doc_id for r in docs.select("doc_id").collect()]
        assert len(set(kept)) == len(kept) and set(kept) <= set(ids)
        counts.append(len(kept))
        ids = kept
    assert counts[0] > counts[1] > counts[2] >= counts[3] > counts[4] > 0
    want = sorted(map(tuple, corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).collect()))
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF_DIR).collect())) == want
    assert [w[0] for w in want] == sorted(ids)


def test_stages_take_effect_as_their_operators_say(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels, bench = (spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("labels", "benchmark"))
    stages = dict(corpus_pipeline.STAGES)
    ids = lambda df, c="doc_id": {r[c] for r in df.select(c).collect()}
    model = quality.train(docs, labels)
    assert ids(quality.keep(docs, model)) == ids(quality.score(docs, model).filter("kept"))
    assert ids(stages["near_dedup"](spark, docs, SF_DIR)) == ids(simhash.near_duplicates(docs), "component_id")
    assert ids(stages["decontaminate"](spark, docs, SF_DIR)) == ids(docs) - ids(decontaminate.leaks(docs, bench))
    assert ids(stages["mix"](spark, docs, SF_DIR)) == ids(mixing.plan(docs).filter("taken"))


def test_pipeline_on_an_empty_table(spark, tmp_path):
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF_DIR}/{t}.parquet").limit(0).write.parquet(str(tmp_path / f"{t}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_sql_counterparts(spark, name):
    duck = duckdb.connect()
    for t in ("documents", "pages", "labels", "benchmark", "conversations"):
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    got = queries.queries()[name](spark, SF_DIR)
    found = duck.execute(queries.oracle_sql()[name])
    order = [[c[0] for c in found.description].index(c) for c in got.columns]
    want = sorted(repr(tuple(r[i] for i in order)) for r in found.fetchall())
    assert sorted(repr(tuple(r)) for r in got.collect()) == want and len(want) > 10


def test_entry_works_without_these_modules(monkeypatch):
    import __spark_entry__

    with monkeypatch.context() as m:
        for name in [n for n in sys.modules if n == "corpus_pipeline" or n.startswith("saleslane.llm")]:
            m.delitem(sys.modules, name)
        m.setitem(sys.modules, "saleslane.llm", None)
        m.setitem(sys.modules, "corpus_pipeline", None)
        entry = importlib.reload(__spark_entry__)
        assert "pipeline" not in entry.queries() and "category_rollup" in entry.queries()
    entry = importlib.reload(__spark_entry__)
    assert {"pipeline", "op8_url_rules"} <= set(entry.queries())


def test_tokens_are_the_librarys(spark):
    import numpy as np
    import public_tokenizers
    import zlib
    from tokenizers import Tokenizer

    tool = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    texts = {r.doc_id: tool.encode(r.text or "", add_special_tokens=False).ids + [0] for r in docs.collect()}
    got = token_codes.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.json")).collect()
    start = 0
    for r in sorted(got, key=lambda r: r.doc_id):
        assert (r.start, r.n_tokens) == (start, len(texts[r.doc_id]))
        assert r.ids_crc32 == zlib.crc32(np.array(texts[r.doc_id], dtype="<u4").tobytes())
        start += r.n_tokens
