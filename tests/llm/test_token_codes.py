import random
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest

from saleslane.llm import token_codes as op

tokenizers = pytest.importorskip("tokenizers")
public = pytest.importorskip("public_tokenizers")
PATH = public.path("byte_bpe_50k.json")
TEXTS = [
    None, "", " ", "\n", "a", "a b", "a  b", " a", "a ", "a\nb", "a\n\nb", "a\n\n\nb\n", "a \nb", "a\n b", "a\t\tb\r\nc", "it's we'll 'sx\n's",
    "x y z", "É\x1cé 12 3.5!", "<|endoftext|> tail", "😀 emoji 👩‍👩", "z" * 5000, "12345 678\n90", "a\x0bb \x85c", "日本語 の テキスト\nです", "end \n",
]


def library(texts):
    tool = tokenizers.Tokenizer.from_file(PATH)
    return [tool.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_encoder_equals_the_library(monkeypatch):
    rng = random.Random(2)
    made = ["".join(rng.choice(" \nab'sé1.,!<|") for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    texts = [t or "" for t in TEXTS] + made
    tool = op.Encoder(PATH)
    assert tool.by_word and not tool.words
    monkeypatch.setattr(op, "REMEMBERED_WORDS", 500)
    got = [x for at in range(0, len(texts), 100) for x in tool.encode(texts[at : at + 100])]
    assert [np.frombuffer(g, "<u2").tolist() for g in got] == library(texts)


def test_plain_words_go_to_the_model_together_and_long_texts_in_parts(monkeypatch):
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdeéüß") for _ in range(rng.randint(1, 9))) + rng.choice(["", "", ",", ".", "?!", "..."]) for _ in range(3000)]
    texts = ["".join(w + rng.choice("   \n") for w in words[at : at + 150]).strip() for at in range(0, 3000, 150)]
    texts += ["\n".join(words), " ".join(words) + " 12 don't ×é ÷", "  ".join(words[:300]), "x" * 900, "a " + "y" * 900 + " b", *(t or "" for t in TEXTS)]
    tool, calls = op.Encoder(PATH), []
    learn = op._Words.learn
    monkeypatch.setattr(op._Words, "learn", lambda self, text: calls.append(text) or learn(self, text))
    want = library(texts)
    assert [np.frombuffer(g, "<u2").tolist() for g in tool.encode(texts[:22])] == want[:22]
    assert len(calls) < 10
    for size in (1, 40, 700):
        monkeypatch.setattr(op, "CHARS_AT_ONCE", size)
        assert [np.frombuffer(g, "<u2").tolist() for g in tool.encode(texts)] == want


def test_memory_of_texts_that_are_looked_up_together():
    rng = random.Random(7)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 9))) for _ in range(2000)]
    tool, many = op.Encoder(PATH), [" ".join(rng.choices(words, k=600)) for _ in range(1300)]
    for texts in (many, [" ".join(many)]):
        tracemalloc.start()
        try:
            got, peak = tool.encode(texts), tracemalloc.get_traced_memory()[1]
        finally:
            tracemalloc.stop()
        assert peak < 48 << 20
        assert [len(x) // 2 for x in got] == [len(x) for x in library(texts)]


def test_groups_join_batches_and_cut_them(monkeypatch):
    monkeypatch.setattr(op, "CHARS_AT_ONCE", 10)
    sizes = [[4, 4], [], [1, 2, 25, 0, 10], [11], [3], [3, 3, 3]]
    batches = [pa.RecordBatch.from_pydict({"text": pa.array(["x" * n for n in b], pa.string())}) for b in sizes]
    got = [[len(t) for t in g.column("text").to_pylist()] for g in op._groups(iter(batches))]
    assert got == [[4, 4, 1], [2], [25], [0, 10], [11], [3, 3, 3], [3]]


def test_texts_reach_the_tasks_in_small_batches(spark, tmp_path, monkeypatch):
    def sizes(batches):
        for i, b in enumerate(batches):
            row = {"part": 0, "seq": i, "offset": b.nbytes, "doc_ids": [], "sizes": [], "n_ids": b.num_rows, "levels": []}
            yield pa.RecordBatch.from_pylist([row], schema)

    level = pa.list_(pa.struct([(c, pa.binary()) for c in ("chunks", "more", "ranks")]))
    longs = pa.list_(pa.int64())
    schema = pa.schema(
        [("part", pa.int32()), ("seq", pa.int32()), ("offset", pa.int64()), ("doc_ids", longs), ("sizes", longs), ("n_ids", pa.int64()), ("levels", level)]
    )
    monkeypatch.setattr(op, "_writer", lambda *_: sizes)
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    op.write_codes(spark.range(6000).selectExpr("id as doc_id", "repeat('x', 5000) as text").coalesce(1), str(tmp_path / "codes"), PATH)
    got = [(r.n_ids, r.offset) for r in spark.read.parquet(str(tmp_path / "codes")).collect()]
    assert sum(n for n, _ in got) == 6000 and max(size for _, size in got) < 5 << 20
    assert spark.conf.get(name) == before


def test_other_tokenizers_go_to_the_library_whole():
    path = public.path("word_bpe_49k.json")
    tool = op.Encoder(path)
    assert not tool.by_word
    plain = tokenizers.Tokenizer.from_file(path)
    texts = [t or "" for t in TEXTS]
    assert [np.frombuffer(g, tool.kind).tolist() for g in tool.encode(texts)] == [plain.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("top", [1, 255, 256, 50_000, 2**32 - 1])
@pytest.mark.parametrize("n", [0, 1, 511, 512, 513, 3000])
def test_codes_round_trip_and_random_access(n, top):
    ids = np.random.default_rng(n).integers(0, top, n, endpoint=True).astype(np.uint32)
    codes = op.Codes.of_row(op.Codes.encode(ids).rows())
    assert codes.decode().tolist() == ids.tolist()
    places = range(n) if n < 600 else range(0, n, 37)
    assert [codes.access(i) for i in places] == [int(ids[i]) for i in places]


def test_documents_round_trip(spark, tmp_path):
    rows = [(i * 7 % 25, t) for i, t in enumerate(TEXTS)] + [(None, "null id"), (3, "again"), (3, "again")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("part", __import__("pyspark").sql.functions.lit("x"))
    path = str(tmp_path / "codes")
    op.write_codes(docs.repartition(4), path, PATH, segment_ids=40)
    got = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in op.read_summary(spark, path).collect())
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    start, want = 0, []
    for (doc, _), ids in zip(order, library([t for _, t in order]), strict=True):
        packed = np.array([*ids, 0], dtype="<u4")
        want.append((start, doc, len(packed), zlib.crc32(packed.tobytes())))
        start += len(packed)
    assert got == want
    assert spark.read.parquet(path).count() > 3


def test_empty_table(spark):
    assert op.encode_documents(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0
