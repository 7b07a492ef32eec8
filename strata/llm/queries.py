"""Registered queries of the operators, with the SQL that checks them where SQL can express them.

The tokenizer files are found by the public_tokenizers package; the operators take their paths as parameters.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import (bm25_search, byte_bpe, jaccard_join, line_dedup, minhash_dedup, packing, prefix_trie, quality_rules, secrets,
                        suffix_dedup, token_counts, url_filter, whitening)
from strata.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# The rules that op10 applies.
URL_RULES = [
    url_filter.Rule("org", "/", "allow"),
    url_filter.Rule("example.org", "/es/", "block"),
    url_filter.Rule("example.org", "/en/1", "block"),
    url_filter.Rule("com", "/fr/", "allow"),
    url_filter.Rule("com", "/de/", "block"),
]


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLE[fn.__name__] = sql
        return fn

    return register


@query()
def op1_suffix_dedup(spark, sf_dir):
    return suffix_dedup.deduplicate(table(spark, sf_dir, "documents"))


@query()
def op2_secret_scan(spark, sf_dir):
    return secrets.scan(table(spark, sf_dir, "documents")).drop("found")


@query("""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS i
  FROM documents),
e AS (
  SELECT *, substr(md5(coalesce(lag(md5(line)) OVER (PARTITION BY doc_id ORDER BY i), '') || md5(line)), 1, 1)
            IN ('0', '4', '8', 'c') AS ends FROM l),
c AS (
  SELECT *, coalesce(sum(ends::INT) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
            AS chunk FROM e),
g AS (
  SELECT doc_id, chunk, string_agg(line, chr(10) ORDER BY i) AS body,
         count(*) FILTER (WHERE regexp_matches(line, '[^\x20\x09-\x0D]')) AS filled
  FROM c GROUP BY ALL),
r AS (
  SELECT doc_id, chunk, row_number() OVER (PARTITION BY body ORDER BY doc_id, chunk) > 1 AND filled > 1 AS gone FROM g)
SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (WHERE gone))::BIGINT AS n_removed,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM c JOIN r USING (doc_id, chunk) GROUP BY doc_id""")
def op3_line_dedup(spark, sf_dir):
    left = line_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return left.select("row.doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


@query()
def op4_quality_rules(spark, sf_dir):
    judged = quality_rules.filter_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
                         "failed_rule")


@query()
def op5_sequence_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query()
def op6_token_counts(spark, sf_dir):
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query()
def op7_jaccard_join(spark, sf_dir):
    return jaccard_join.cluster(table(spark, sf_dir, "documents"), n=3, percent=90)


@query()
def op8_byte_bpe(spark, sf_dir):
    return byte_bpe.encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                                  public_tokenizers.PATTERN)


@query()
def op9_bm25_search(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return bm25_search.search(documents, documents.where("doc_id % 100 = 0"), k=10)


@query("""
WITH cut AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest
  FROM pages),
parts AS (
  SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw_host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
lowered AS (
  SELECT page_id, translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path FROM parts),
rules(h, p, v) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
                          ('com', '/fr/', 'allow'), ('com', '/de/', 'block'))
SELECT page_id, host, path,
       (SELECT max_by(h || p, length(h || p)) FROM rules
        WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)) AS rule,
       coalesce((SELECT max_by(v, length(h || p)) FROM rules
                 WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)), 'allow') AS verdict
FROM lowered""")
def op10_url_filter(spark, sf_dir):
    return url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES)


@query("""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
places AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM words WHERE len(w) > 0),
grams AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS g FROM places),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY ALL),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT p.a, p.b FROM pairs p JOIN sizes x ON x.doc_id = p.a JOIN sizes y ON y.doc_id = p.b WHERE 100 * c >= 80 * (x.n + y.n - c)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM words UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
least AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY ALL)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM least LEFT JOIN sizes USING (doc_id)""")
def op11_minhash_dedup(spark, sf_dir):
    return minhash_dedup.cluster(table(spark, sf_dir, "documents"), n=4, percent=80)


@query()
def op12_embedding_whitening(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@query("""
WITH crc AS (
  SELECT list(list_reduce(list_concat([b], range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1))) ORDER BY b) AS t FROM range(256) r(b)),
turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (
           PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 AS i
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT conv_id, xor(list_reduce(list_concat([4294967295], list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c))),
                                  lambda x, b: xor(x >> 8, t[(xor(x, b) & 255) + 1])), 4294967295) % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM turns), crc),
rebuilt AS (
  SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY part, i) AS d
  FROM (SELECT c.conv_id, 1 AS part, i, role, text FROM convs c JOIN turns t ON t.conv_id = c.conv_id - c.conv_id % 5 AND i < h
        UNION ALL SELECT c.conv_id, 2, i, role, text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND i >= h)),
paths AS (
  SELECT conv_id, d, strlen(text) AS n_bytes, string_agg(md5(role) || md5(text), '') OVER (PARTITION BY conv_id ORDER BY d) AS path FROM rebuilt
  UNION ALL SELECT conv_id, 0, 0, '' FROM convs),
members AS (SELECT *, d = max(d) OVER (PARTITION BY conv_id) AS is_end FROM paths),
nodes AS (
  SELECT path, d, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(n_bytes) AS n_bytes,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE is_end), '')) AS ends_sha256
  FROM members GROUP BY ALL),
linked AS (
  SELECT n.*, p.conv_id AS parent_conv_id, count(k.path) OVER (PARTITION BY n.path, n.d) AS n_children,
         row_number() OVER (PARTITION BY n.path, n.d) AS copy
  FROM nodes n LEFT JOIN nodes p ON p.d = n.d - 1 AND p.path = left(n.path, 64 * p.d) LEFT JOIN nodes k ON k.d = n.d + 1 AND left(k.path, 64 * n.d) = n.path),
single AS (SELECT * FROM linked WHERE copy = 1),
below AS (
  SELECT a.path, a.d, count(*) FILTER (WHERE s.n_children = 0) AS n_leaves, sum((s.n_convs - 1) * s.n_bytes) AS saved_tokens
  FROM single s JOIN members m ON m.conv_id = s.conv_id AND m.d <= s.d JOIN nodes a ON a.path = m.path AND a.d = m.d GROUP BY ALL)
SELECT conv_id, d::BIGINT AS depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens::BIGINT AS saved_tokens, ends_sha256
FROM single JOIN below USING (path, d)""")
def op13_prefix_trie(spark, sf_dir):
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))
