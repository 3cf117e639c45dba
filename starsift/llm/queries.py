"""The operators as queries over whole tables, with SQL where it can state the rows."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starsift.llm.common import new_folder, read_table
from starsift.llm.content_sort import exact_groups
from starsift.llm.curriculum import in_training_order, mix_plan
from starsift.llm.lexical_search import ranked_documents
from starsift.llm.licences import scan_licences, summary
from starsift.llm.prefix_trie import prefix_trie as trie_nodes
from starsift.llm.repeats import without_repeats
from starsift.llm.severity import fit_severity, score_severity
from starsift.llm.shingle_join import Likeness, linked_groups
from starsift.llm.token_counts import count_tokens, with_limit
from starsift.llm.token_store import store_tokens
from starsift.llm.tree_search import nearest
from starsift.llm.vector_links import near_vectors
from starsift.llm.word_codec import digests, encode_decode

WORD_BPE = "word_bpe_49k.json"
BYTE_BPE = "byte_bpe_50k.json"


def tree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


def shingle_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked_groups(read_table(spark, sf_dir, "documents"), Likeness(words=3, percent=90), count_links=True)


def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_limit(count_tokens(read_table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE)))


def licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary(scan_licences(read_table(spark, sf_dir, "documents")))


def repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = without_repeats(read_table(spark, sf_dir, "documents"), 50)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def content_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(read_table(spark, sf_dir, "documents"))


def token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return store_tokens(docs, public_tokenizers.path(WORD_BPE), 2, new_folder(spark))


def word_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(encode_decode(read_table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE)))


def severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return score_severity(docs, fit_severity(docs, read_table(spark, sf_dir, "labels")))


def curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mix_plan(read_table(spark, sf_dir, "documents"))
    return in_training_order(plan).select("doc_id", "size", "source_size", "target", "taken", "position")


def prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie_nodes(read_table(spark, sf_dir, "conversations"))


def lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), 10)


def vector_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(read_table(spark, sf_dir, "embeddings"), 0.93)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_tree_search": tree_search,
    "op2_shingle_join": shingle_join,
    "op3_token_counts": token_counts,
    "op4_licence_scan": licence_scan,
    "op5_repeated_passages": repeated_passages,
    "op6_content_sort": content_sort,
    "op7_token_store": token_store,
    "op8_word_codec": word_codec,
    "op9_severity": severity,
    "op10_curriculum_mix": curriculum_mix,
    "op11_prefix_trie": prefix_trie,
    "op12_lexical_search": lexical_search,
    "op13_vector_links": vector_links,
}

ORACLE: dict[str, str] = {
    "op6_content_sort": r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
    sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256
  FROM documents),
g AS (
  SELECT *, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM n WINDOW w AS (PARTITION BY text_sha256 ORDER BY points DESC, doc_id))
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g""",
    "op10_curriculum_mix": r"""
WITH d AS (
  SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS digest,
    CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
t AS (
  SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS turn, source_size * 2e0 AS cap FROM s),
w AS (
  SELECT *, CASE turn WHEN 0 THEN 5e0 WHEN 1 THEN 2e0 ELSE 1e0 END AS weight,
    CASE turn WHEN 0 THEN 1.5e0 WHEN 1 THEN 1e0 ELSE 0.5e0 END AS a,
    CASE turn WHEN 0 THEN 0.5e0 WHEN 1 THEN 1e0 ELSE 1.5e0 END AS b FROM t),
l AS (
  SELECT *, row_number() OVER o AS place,
    ((SELECT sum(source_size) FROM s) * 1.5e0 - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0e0))
      / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM w WINDOW o AS (ORDER BY cap / weight, source NULLS LAST)),
f AS (SELECT place, level FROM l WHERE level * weight <= cap ORDER BY place LIMIT 1),
g AS (
  SELECT l.source, l.source_size, a, b,
    CASE WHEN f.place IS NULL OR l.place < f.place THEN cap ELSE f.level * weight END AS target
  FROM l LEFT JOIN f ON true),
p AS (
  SELECT d.doc_id, d.size, g.source_size, g.target, a, b, CAST(floor(g.target + 0.5) AS BIGINT) AS wanted,
    coalesce(CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.digest, d.doc_id, d.size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0) AS off
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source),
q AS (SELECT *, wanted // greatest(source_size, 1) AS passes FROM p),
r AS (
  SELECT *, passes * size + greatest(0, least(size, wanted - passes * source_size - off)) AS taken,
    off / CAST(greatest(wanted, 1) AS DOUBLE) AS u FROM q)
SELECT doc_id, size, source_size, target, CAST(taken AS BIGINT) AS taken,
  CASE WHEN taken > 0 THEN CASE WHEN u > 0 THEN u * 2 * ((a + b) / 2) / (a + sqrt(a * a + (b - a) * 2 * u * ((a + b) / 2)))
    ELSE 0e0 END END AS position
FROM r""",    "op11_prefix_trie": r"""
WITH RECURSIVE c AS (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL),
crc(conv_id, s, i, bit, v) AS (
  SELECT conv_id, CAST(conv_id AS VARCHAR), 0, 8, CAST(4294967295 AS BIGINT) FROM c
  UNION ALL
  SELECT conv_id, s, CASE WHEN bit = 8 THEN i + 1 ELSE i END, CASE WHEN bit = 8 THEN 0 ELSE bit + 1 END,
    CASE WHEN bit = 8 THEN xor(v, CAST(ascii(substr(s, i + 1, 1)) AS BIGINT))
      WHEN v % 2 = 1 THEN xor(v // 2, CAST(3988292384 AS BIGINT)) ELSE v // 2 END
  FROM crc WHERE i < length(s) OR bit < 8),
h AS (SELECT conv_id, xor(v, CAST(4294967295 AS BIGINT)) % 9 AS h FROM crc WHERE i = length(s) AND bit = 8 AND i > 0),
t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
      sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS k
  FROM conversations WHERE conv_id IS NOT NULL),
r AS (
  SELECT h.conv_id, 0 AS own, k, role, text FROM h JOIN t ON t.conv_id = h.conv_id - h.conv_id % 5 AND k <= h
  UNION ALL
  SELECT h.conv_id, 1, k, role, text FROM h JOIN t ON t.conv_id = h.conv_id AND k > h),
p AS (
  SELECT c.conv_id, coalesce(x.path, []) AS path FROM c LEFT JOIN (
    SELECT conv_id, list({'role': role, 'text': text} ORDER BY own, k) AS path FROM r GROUP BY conv_id) x ON x.conv_id = c.conv_id),
m AS (SELECT conv_id, path[1:d] AS node, d, len(path) AS n FROM p, LATERAL (SELECT unnest(range(0, len(path) + 1)) AS d)),
g AS (
  SELECT node, d AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE n = d), '')) AS ends_sha256
  FROM m GROUP BY node, d),
k AS (SELECT node[1:depth - 1] AS node, depth - 1 AS depth, count(*) AS n_children FROM g WHERE depth > 0 GROUP BY 1, 2),
o AS (
  SELECT g.node, g.depth, coalesce(n_children, 0) AS n_children,
    CASE WHEN g.depth > 0 THEN (n_convs - 1) * strlen(g.node[g.depth].text) ELSE 0 END AS saved
  FROM g LEFT JOIN k ON k.node = g.node AND k.depth = g.depth),
a AS (
  SELECT node[1:d] AS node, d AS depth, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(saved) AS saved_tokens
  FROM o, LATERAL (SELECT unnest(range(0, depth + 1)) AS d) GROUP BY 1, 2)
SELECT g.conv_id, CAST(g.depth AS BIGINT) AS depth, u.conv_id AS parent_conv_id, g.n_convs, o.n_children,
  CAST(a.n_leaves AS BIGINT) AS n_leaves, CAST(a.saved_tokens AS BIGINT) AS saved_tokens, g.ends_sha256
FROM g JOIN o ON o.node = g.node AND o.depth = g.depth JOIN a ON a.node = g.node AND a.depth = g.depth
LEFT JOIN g u ON u.depth = g.depth - 1 AND u.node = g.node[1:g.depth - 1]""",
    "op12_lexical_search": r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents),
i AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
t AS (SELECT r, doc_id, term, count(*) AS tf FROM d GROUP BY r, doc_id, term),
n AS (SELECT r, CAST(sum(tf) AS BIGINT) AS n FROM t GROUP BY r),
c AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS len FROM n),
f AS (SELECT term, count(*) AS df FROM t GROUP BY term),
w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS w FROM f, c),
s AS (
  SELECT i.item_id, t.r, t.doc_id, CAST(sum(w.w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n.n * c.docs) // c.len)))) AS BIGINT) AS score
  FROM i JOIN t ON t.term = i.term JOIN w ON w.term = t.term JOIN n ON n.r = t.r CROSS JOIN c
  GROUP BY i.item_id, t.r, t.doc_id),
o AS (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank
  FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM o WHERE rank <= 10""",
}
