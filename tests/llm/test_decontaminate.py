import random
import re
from collections import Counter

from saleslane.llm import decontaminate as op

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def brute(docs, items, threshold=0.8):
    """Best similarity of any item-sized window, by (doc_id, item_id)."""
    out = {}
    for d, text in docs:
        w = words(text)
        for i, item in items:
            v = words(item)
            if not v or not w:
                continue
            k = min(5, len(v))
            grams = lambda x: Counter(tuple(x[j : j + k]) for j in range(len(x) - k + 1))  # noqa: B023, E731
            want = grams(v)
            best = 0.0
            for s in range(max(1, len(w) - len(v) + 1)):
                have = grams(w[s : s + len(v)])
                common = sum((have & want).values())
                best = max(best, common / max(1, sum(have.values()) + sum(want.values()) - common))
            if best >= threshold:
                out[(d, i)] = round(best, 9)
    return out


def corpus():
    rng = random.Random(9)
    word = lambda: rng.choice("alpha beta gamma delta épsilon zeta eta theta iota kappa".split()) + str(rng.randint(0, 60))
    prose = lambda n: [word() for _ in range(n)]
    items = [(i, " ".join(prose(rng.randint(8, 45)))) for i in range(12)]
    items += [(50, "Two words"), (51, ""), (52, None), (53, items[0][1]), (54, " ".join(["la"] * 30)), (None, " ".join(prose(9)))]
    docs = [(i, " ".join(prose(rng.randint(0, 120)))) for i in range(30)]
    for i, (_, item) in enumerate(items):
        own = (item or "").split()
        docs.append((100 + i, " ".join(prose(20) + own + prose(20))))
        docs.append((200 + i, (item or "").upper().replace(" ", ",\n")))
        if len(own) > 20:
            edited = own.copy()
            edited[0] = "changed"
            docs.append((300 + i, " ".join(prose(5) + edited + prose(7))))
            half = own[: len(own) // 2]
            docs.append((400 + i, " ".join(half + prose(20))))
    docs += [(500, None), (501, ""), (502, "two"), (None, items[3][1]), (103, docs[-1][1])]
    docs += [docs[30], docs[30]]
    return docs, items


def test_matches_brute_force(spark):
    docs, items = corpus()
    got = op.leaks(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)).collect()
    want = brute(docs, items)
    assert {(r.doc_id, r.item_id): round(r.similarity, 9) for r in got} == want
    assert len(got) == len(want) and len(want) > 25


def test_without_broadcast_and_with_clashing_columns(spark, monkeypatch):
    monkeypatch.setattr(op, "BROADCAST_ROWS", 0)
    docs, items = corpus()
    frame = spark.createDataFrame([(*d, 1, "x") for d in docs], DOCS + ", did int, words string")
    bench = spark.createDataFrame([(*i, 2) for i in items], ITEMS + ", n int")
    kept = op.decontaminate(frame, bench).collect()
    clean = [d for d, t in docs if not brute([(d, t)], items)]
    assert sorted((r.doc_id for r in kept), key=repr) == sorted(clean, key=repr)
    assert kept[0].did == 1 and kept[0].words == "x"


def test_empty_tables(spark):
    none, some = spark.createDataFrame([], DOCS), spark.createDataFrame([(1, "a b c d e f")], DOCS)
    bench = spark.createDataFrame([(1, "a b c d e f")], ITEMS)
    assert op.leaks(none, bench).count() == 0
    assert op.leaks(some, spark.createDataFrame([], ITEMS)).count() == 0
    assert op.decontaminate(some, spark.createDataFrame([], ITEMS)).count() == 1
    assert op.decontaminate(some, bench).count() == 0


def test_fingerprint_of_very_many_shingles(spark):
    shingles = spark.range(150_000).selectExpr("1 as k", "xxhash64(id) as h")
    hashes = [r.h % (1 << 64) for r in shingles.collect()]
    want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    row = op._fingerprints(shingles, ["k"]).first()
    assert (row.m, row.fp % (1 << 64)) == (len(hashes), want)
