import random

import pytest

from saleslane.llm import url_rules as op

RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]
SCHEMA = "host string, path string, verdict string"


def brute(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        n = min([i for i in map(rest.find, "/?#") if i >= 0], default=len(rest))
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:n])
        rest = rest[n:]
        path = rest[: min([i for i in map(rest.find, "?#") if i >= 0], default=len(rest))]
    fits = [(len(h + p), v == "block", h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[2], best[3] if best else "allow"


URLS = [
    None, "", "no scheme", "http://", "https://Example.ORG/es/x?q=1", "https://a.b.example.org/en/12#t", "http://org/", "http://org", "ftp://x.com/fr/", "http://com/de/9",
    "http://notexample.org/es/", "http://example.org/e", "http://example.org/es", "http://x.com?a=/fr/", "http://u:p@y.com:80/de/", "a://b://c/d", "http://x.com/fr/\n/z", "http://É.org/É", "http://x..org/", "http://.org/q",
]


@pytest.mark.parametrize("salts", [1, 5])
def test_matches_brute_force(spark, salts):
    rows = [(i, u) for i, u in enumerate(URLS)] + [(None, URLS[4]), (4, URLS[4])]
    rules = spark.createDataFrame(RULES, SCHEMA)
    got = op.judge_urls(spark.createDataFrame(rows, "page_id long, url string"), rules, salts=salts).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(repr((i, *brute(u, RULES))) for i, u in rows)


def test_nested_rules_and_ties(spark):
    rng = random.Random(1)
    hosts = ["org", "b.org", "a.b.org", "c.org", "b", "ab.org"]
    paths = ["", "/", "/x", "/x/", "/x/y", "/xx", "/é"]
    rules = list({(rng.choice(hosts), rng.choice(paths)): rng.choice(["allow", "block", "other"]) for _ in range(40)}.items())
    rules = [(h, p, v) for (h, p), v in rules]
    rows = [(i, f"http://{rng.choice(['', 'q.'])}{rng.choice(hosts)}{rng.choice(paths)}{rng.choice(['', 'z', '/y'])}") for i in range(300)]
    got = op.judge_urls(spark.createDataFrame(rows, "page_id long, url string"), spark.createDataFrame(rules + [(None, "/", "block")], SCHEMA)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(((i, *brute(u, rules)) for i, u in rows), key=repr)


def test_empty_tables_and_extra_columns(spark):
    rules = spark.createDataFrame([], SCHEMA)
    assert op.judge_urls(spark.createDataFrame([], "page_id long, url string"), rules).count() == 0
    pages = spark.createDataFrame([(1, "http://a.org/", "h", 5, "k")], "page_id long, url string, host string, salt int, key string")
    assert tuple(op.judge_urls(pages, rules, default="keep").first()) == (1, "a.org", "/", None, "keep")
