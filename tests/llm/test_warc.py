import gzip
import hashlib
import io
import random

import pytest

from saleslane.llm import warc as op

SCHEMA = "page_id long, url string, html string"


def archive(*plain):
    return b"".join(op.member(p) for p in plain)


def test_pages_come_back_with_revisits(spark, tmp_path):
    rng = random.Random(5)
    big = "é" + "x" * 1200
    rows = [(i, f"http://a.org/{i}", rng.choice([big, big[:-1], "tiny", f"own {i} " * rng.randint(1, 400)])) for i in range(80)]
    rows += [(None, "http://n/", big), (200, None, None), (201, "http://a b\r\nX: y/%41", ""), (202, "", "z" * 300_000), (79, "u", "tiny"), (79, "u", "tiny")]
    pages = spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA + ", digest int, first int").repartition(3)
    files = op.write(pages, str(tmp_path / "w"), archive_bytes=4000)
    assert files.count() > 3 and sorted(files.columns) == ["archive", "n_bytes", "n_records"]
    got = op.read(spark, files).collect()
    largest = {}
    for i, _, html in rows:
        if html and len(html.encode()) >= 1000 and i is not None:
            largest[html] = max(i, largest.get(html, -1))
    want = []
    for i, url, html in rows:
        payload = (html or "").encode()
        target = largest.get(html)
        revisit = len(payload) >= 1000 and target is not None and target != i
        want.append((i, url, len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if revisit else "response", target if revisit else None, None if revisit else payload))
    key = repr
    found = [(r.page_id, r.url, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload)) for r in got]
    assert sorted(found, key=key) == sorted(want, key=key)
    light = op.read(spark, files, payload=False).drop("payload").collect()
    assert sorted(map(tuple, light), key=key) == sorted((tuple(r[c] for c in r.__fields__ if c != "payload") for r in got), key=key)
    for name in {r.archive for r in got}:
        with gzip.open(name) as whole:
            text = whole.read()
        assert text.count(b"WARC/1.1\r\n") == sum(r.archive == name for r in got)


def test_offsets_are_the_members(monkeypatch):
    plain = [op.record(i, b"http://x/", bytes([65 + i]) * (i * 5000)) for i in range(6)]
    data = archive(*plain)
    for size in (1, 7, 1 << 18):
        monkeypatch.setattr(op, "READ_BYTES", size)
        rows = list(op.records_of(io.BytesIO(data)))
        ends = [sum(len(op.member(p)) for p in plain[:i]) for i in range(6)]
        assert [r["offset"] for r in rows] == ends
        assert [r["payload"] for r in rows] == [bytes([65 + i]) * (i * 5000) for i in range(6)]


def test_broken_records_are_told():
    good, other = op.record(1, None, b"abc" * 400), op.record(2, b"u", b"")
    changed = good.replace(b"abcabc", b"abdabc", 1)
    longer = good + b"x"
    no_length = good.replace(b"Content-Length", b"Content-Size")
    for bad, message in ((changed, "digest"), (longer, "does not end"), (no_length, "length"), (b"hello\r\n\r\n", "start"), (good[:300], "header|inside"), (b"", "header")):
        data = archive(other, bad, other)
        with pytest.raises(op.BrokenRecord, match=message):
            list(op.records_of(io.BytesIO(data)))
        rows = list(op.records_of(io.BytesIO(data), strict=False))
        assert [r["error"] is None for r in rows] == [True, False, True] and rows[2]["page_id"] == "2"
    cut = archive(other, good)[:-20]
    rows = list(op.records_of(io.BytesIO(cut), strict=False))
    assert [r["error"] is None for r in rows] == [True, False]
    assert list(op.records_of(io.BytesIO(b""))) == []


def test_empty_table(spark, tmp_path):
    files = op.write(spark.createDataFrame([], SCHEMA), str(tmp_path / "w"))
    assert files.count() == 0 and op.read(spark, files).count() == 0
