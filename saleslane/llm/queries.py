"""The operators as queries over the given tables, whole tables and whole texts."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saleslane.llm import (
    decontaminate,
    license_scan,
    mixing,
    prefix_trie,
    quality,
    secret_scan,
    simhash,
    spelling,
    substring_dedup,
    token_codes,
    toxicity,
    url_rules,
    warc,
)

Query = Callable[[SparkSession, str], DataFrame]

TOKENIZER = "byte_bpe_50k.json"
URL_RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents"), 400).drop("spans")


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("did", "th")


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secret_scan.scan(docs, secret_scan.rule_labels(docs))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return license_scan.find(docs, license_scan.train(spark, docs))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, radius=4)


def op7_token_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_codes.encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), end_id=0)


def op8_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_rules.judge_urls(table(spark, sf_dir, "pages"), rules, default="allow")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan(table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", "held_out", "score", "predicted", F.col("evidence.doc_id").alias("nearest"))


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = warc.write(table(spark, sf_dir, "pages"))
    found = warc.read(spark, archives, payload=False)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.ordered(table(spark, sf_dir, "conversations"))
    conv = F.col("conv_id")
    shared = F.crc32(conv.cast("string").cast("binary")) % 9
    return prefix_trie.trie(*prefix_trie.rebuild(turns, conv - conv % 5, shared, most=8))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group(table(spark, sf_dir, "documents")).select("word", "form", "root", "n", "n_near", "form_n")


def queries() -> dict[str, Query]:
    return {
        f.__name__: f
        for f in (
            op1_substring_dedup,
            op2_decontaminate,
            op3_secret_scan,
            op4_quality,
            op5_license_scan,
            op6_simhash,
            op7_token_codes,
            op8_url_rules,
            op9_mixing,
            op10_toxicity,
            op11_warc,
            op12_prefix_trie,
            op13_spelling,
        )
    }


_RULE_ROWS = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)
_OP8 = f"""
WITH rules(h, p, v) AS (VALUES {_RULE_ROWS}),
urls AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) AS path,
         row_number() OVER () AS n
  FROM pages
),
fits AS (
  SELECT n, h || p AS rule, v, row_number() OVER (PARTITION BY n ORDER BY length(h || p) DESC, v DESC, h || p DESC) AS place
  FROM urls JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
)
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict
FROM urls LEFT JOIN (SELECT * FROM fits WHERE place = 1) USING (n)
"""


_OP11 = """
WITH sizes AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
),
largest AS (SELECT payload_digest, max(page_id) AS first FROM sizes WHERE payload_bytes >= 1000 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM sizes LEFT JOIN largest USING (payload_digest)
"""


def _crc32(hex_of: str) -> str:
    """SQL for the CRC-32 of bytes given as hexadecimal digits; ``crc_table`` must be at hand."""
    byte = f"('0x' || substr({hex_of}, 2 * i - 1, 2))::UBIGINT"
    numbers = f"list_transform(range(1, length({hex_of}) // 2 + 1), lambda i: {byte})"
    step = "xor(c >> 8, crc_table[(xor(c, b) % 256)::BIGINT + 1])"
    return f"xor(list_reduce({numbers}, lambda c, b: {step}, 4294967295::UBIGINT), 4294967295::UBIGINT)"


_CRC_TABLE = """
crc AS (
  SELECT list(list_reduce(range(8), lambda c, k: xor(c >> 1, (c % 2) * 3988292384::UBIGINT), n::UBIGINT) ORDER BY n) AS crc_table
  FROM range(256) AS numbers(n)
)"""

_OP12 = f"""
WITH RECURSIVE {_CRC_TABLE},
turns AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL
),
sizes AS (
  SELECT c, n, c - c % 5 AS base, {_crc32("hex(encode(c::VARCHAR))")} % 9 AS h FROM (SELECT c, count(*) AS n FROM turns GROUP BY c), crc
),
plans AS (
  SELECT s.*, least(s.h, coalesce(b.n, 0)) AS taken FROM sizes s LEFT JOIN sizes b ON b.c = s.base
),
rebuilt AS (
  SELECT p.c, t.pos, role, text FROM plans p JOIN turns t ON t.c = p.base AND t.pos < h
  UNION ALL
  SELECT p.c, t.pos - h + taken, role, text FROM plans p JOIN turns t ON t.c = p.c AND t.pos >= h
),
-- A prefix is the digest of the prefix before it and of its last turn.
chain AS (
  SELECT c, 0::BIGINT AS depth, '' AS node, NULL::VARCHAR AS up, 0::BIGINT AS bytes FROM plans
  UNION ALL
  SELECT r.c, depth + 1, sha256(node || length(role) || ' ' || role || text), node, strlen(text)
  FROM chain JOIN rebuilt r ON r.c = chain.c AND r.pos = chain.depth
),
lasts AS (SELECT c, max(depth) AS depth FROM chain GROUP BY c),
nodes AS (
  SELECT node, chain.depth, any_value(up) AS up, min(chain.c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(bytes) AS own,
         sha256(coalesce(string_agg(chain.c::VARCHAR, ',' ORDER BY chain.c) FILTER (WHERE chain.depth = lasts.depth), '')) AS ends_sha256
  FROM chain JOIN lasts ON lasts.c = chain.c GROUP BY node, chain.depth
),
children AS (SELECT up AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY up),
full_nodes AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN children USING (node)),
above AS (
  SELECT node, node AS top, up FROM nodes
  UNION ALL
  SELECT a.node, n.node, n.up FROM above a JOIN nodes n ON n.node = a.up
),
sums AS (
  SELECT top AS node, sum((n_children = 0)::BIGINT)::BIGINT AS n_leaves, sum(own)::BIGINT AS saved_tokens
  FROM above JOIN full_nodes USING (node) GROUP BY top
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, n_leaves, saved_tokens, n.ends_sha256
FROM full_nodes n JOIN sums USING (node) LEFT JOIN nodes p ON p.node = n.up
"""

# The CRC-32 of op13 is linear: each byte's share depends on the bytes that follow it, and the shares
# and that of the length (row 256) are joined by xor.  That keeps it relational for very many runs.
_OP13 = f"""
WITH RECURSIVE {_CRC_TABLE},
steps AS (SELECT unnest(range(256)) AS low, unnest(crc_table) AS v FROM crc),
runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS doc,
         translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents
),
counted AS MATERIALIZED (
  SELECT row_number() OVER () AS row, run, n, hex(encode(doc || ':' || run)) AS digits, length(digits) // 2 AS size
  FROM (SELECT doc, run, count(*) AS n FROM runs GROUP BY doc, run)
),
shares(after, byte, v) AS (
  SELECT 0, low, v FROM steps
  UNION ALL
  SELECT 0, 256, 4294967295::UBIGINT
  UNION ALL
  SELECT after + 1, byte, xor(shares.v >> 8, steps.v) FROM shares JOIN steps ON low = shares.v % 256 WHERE after < (SELECT max(size) FROM counted)
),
bytes AS (SELECT row, size, digits, unnest(range(size)) AS i FROM counted),
joined AS (
  SELECT row, bit_xor(v) AS share FROM bytes JOIN shares ON after = size - 1 - i AND byte = ('0x' || substr(digits, 2 * i + 1, 2))::BIGINT GROUP BY row
),
hashed AS (
  SELECT run, n, xor(xor(share, v), 4294967295::UBIGINT) AS h FROM counted JOIN joined USING (row) JOIN shares ON after = size AND byte = 256
),
words AS MATERIALIZED (
  SELECT word, sum(n)::BIGINT AS n
  FROM (
    SELECT n, CASE WHEN h % 97 = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word
    FROM hashed
  )
  WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
),
holes AS (
  SELECT word, n, i, length(word) AS size, substr(word, 1, i) || substr(word, i + 2) AS rest
  FROM words, LATERAL (SELECT unnest(range(length(word))) AS i)
),
pairs AS MATERIALIZED (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM holes a JOIN holes b USING (size, i, rest) WHERE a.word <> b.word
  UNION
  SELECT h.word, h.n, w.word, w.n FROM holes h JOIN words w ON w.word = rest
  UNION
  SELECT w.word, w.n, h.word, h.n FROM holes h JOIN words w ON w.word = rest
),
best AS MATERIALIZED (
  SELECT word, n, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS form, max(other_n) AS form_n FROM pairs GROUP BY word, n
),
forms AS MATERIALIZED (SELECT word, form, form_n FROM best WHERE form_n >= 2 * n),
paths(word, root) AS (
  SELECT word, form AS root FROM forms
  UNION ALL
  SELECT p.word, f.form FROM paths p JOIN forms f ON f.word = p.root
),
roots AS (SELECT word, root FROM paths WHERE root NOT IN (SELECT word FROM forms))
SELECT w.word, f.form, coalesce(r.root, w.word) AS root, w.n, coalesce(b.n_near, 0) AS n_near, f.form_n
FROM words w LEFT JOIN best b USING (word) LEFT JOIN forms f USING (word) LEFT JOIN roots r USING (word)
"""


def oracle_sql() -> dict[str, str]:
    """SQL for the operators that it expresses at the speed of whole tables."""
    return {"op8_url_rules": _OP8, "op11_warc": _OP11, "op12_prefix_trie": _OP12, "op13_spelling": _OP13}
