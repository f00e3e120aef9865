"""One query per operator over its whole table, with the SQL twin where SQL can say it."""

from __future__ import annotations

import os

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import (bpe, context_trees, decontamination, html_text, language, manifest, resampling, sharding, simhash, surrogates,
                           target_resampling, topk, toxicity)
from plumbline.llm.common import read_table

#: The key of surrogates; a real corpus sets its own, and keeps it from readers.
SURROGATE_KEY = os.environ.get("PLUMBLINE_SURROGATE_KEY", "a key for tests only").encode()
VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def _remainder(column: Column, divisor: int) -> Column:
    return F.crc32(column.cast("string").cast("binary")) % divisor


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"),
                             held_out=lambda doc_id: _remainder(doc_id, 4) == 2)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(read_table(spark, sf_dir, "documents"), held_out=_remainder(F.col("doc_id"), 3) == 1)


def op4_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return surrogates.replace_personal_data(docs, SURROGATE_KEY)


def op5_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op6_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(read_table(spark, sf_dir, "pages"))


def op7_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.quantised(read_table(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors, vectors.where("vec_id % 50 = 0"), k=5)


def op8_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(read_table(spark, sf_dir, "documents"), shards=24)


def op9_simhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"), shingle=4, max_bits=4)
    return found.select(F.col("id").alias("doc_id"), simhash.hex_of("fp").alias("fingerprint"), "component_id")


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(read_table(spark, sf_dir, "documents"), VOCABULARY, public_tokenizers.PATTERN,
                                carry=["doc_id"], with_ids=False)


def op11_context_tree_weighting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_trees.score_documents(read_table(spark, sf_dir, "documents"), held_out=_remainder(F.col("doc_id"), 5) == 1)


def op12_target_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return target_resampling.resample_towards(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.manifest(read_table(spark, sf_dir, "documents"), tampered=_remainder(F.col("doc_id"), 3) == 0)


QUERIES = {f.__name__: f for f in (
    op1_benchmark_decontamination, op2_toxicity, op3_language_id, op4_pii_surrogates, op5_importance_resampling,
    op6_html_main_text, op7_exact_top_k, op8_minimax_shards, op9_simhash_near_duplicates, op10_byte_bpe,
    op11_context_tree_weighting, op12_target_resampling, op13_merkle_manifest)}

#: CRC-32 of a hex text of bytes, for the SQL twins: a table by rule, one row, and a fold over the bytes.
_CRC_TABLE = """crc_table AS (
  SELECT list_transform(range(256), lambda v: list_reduce(range(8), lambda c, bit:
    CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, v)) AS t)"""


def _crc(text: str) -> str:
    byte = f"CAST('0x' || substr(hex({text}), 2 * i + 1, 2) AS BIGINT)"
    return (f"xor(4294967295, list_reduce(list_transform(range(strlen({text})), lambda i: {byte}), "
            "lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8), 4294967295))")


_LOWER = "translate(%s, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = f"list_filter(regexp_split_to_array({_LOWER % "coalesce(text, '')"}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '')"
_FIELDS = ", ".join(f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in manifest.FIELDS)

SQL = {
    "op1_benchmark_decontamination": r"""
WITH item_words AS (
  SELECT CAST(item_id AS VARCHAR) AS item, list_filter(regexp_split_to_array(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w
  FROM benchmark),
windows AS (
  SELECT DISTINCT item, least(len(w), 10) AS size, w[i:i + 9] AS words
  FROM (SELECT item, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS i FROM item_words WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM windows),
doc_words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w
  FROM documents),
spots AS (
  SELECT doc_id, size, i, w[i:i + size - 1] AS words
  FROM (SELECT doc_id, w, size, unnest(generate_series(1, len(w) - size + 1)) AS i FROM doc_words, sizes WHERE len(w) >= size)),
found AS (SELECT doc_id, s.size, i, item FROM spots s JOIN windows v ON s.size = v.size AND s.words = v.words),
hits AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(generate_series(i, i + size - 1)) AS p FROM (SELECT DISTINCT doc_id, size, i FROM found)) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS named
  FROM (SELECT DISTINCT doc_id, item FROM found WHERE item IS NOT NULL) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(named, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op7_exact_top_k": r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda c: CAST(floor(256 * CAST(c AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(coalesce(list_sum(list_transform(list_zip(q.x, c.x), lambda p: p[1] * p[2])), 0) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.x) = len(c.x) WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored) WHERE rank <= 5""",
    "op12_target_resampling": f"""
WITH {_CRC_TABLE},
words AS (
  SELECT 0 AS side, doc_id, row_number() OVER () AS place, {_WORDS} AS w FROM documents
  UNION ALL SELECT 1, NULL, 0, {_WORDS} FROM benchmark),
features AS (
  SELECT side, place, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM words),
hashed AS (SELECT f, {_crc("f")} % 10000 AS bucket FROM (SELECT DISTINCT f FROM features), crc_table),
sums AS (SELECT bucket, count(*) FILTER (WHERE side = 0) AS s, count(*) FILTER (WHERE side = 1) AS t
         FROM features JOIN hashed USING (f) GROUP BY bucket),
gains AS (
  SELECT bucket, floor(1000 * ln(CAST(t + 1 AS DOUBLE) * ((SELECT sum(s) FROM sums) + 10000)
    / (CAST(s + 1 AS DOUBLE) * ((SELECT sum(t) FROM sums) + 10000)))) AS gain FROM sums),
means AS (SELECT place, count(*) AS n_features, CAST(floor(sum(gain) / count(*)) AS BIGINT) AS weight
          FROM features JOIN hashed USING (f) JOIN gains USING (bucket) WHERE side = 0 GROUP BY place),
scored AS (
  SELECT doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('7:' || doc_id), 1, 8) AS BIGINT) + 0.5)
           / CAST(4294967296 AS DOUBLE)))) AS BIGINT) AS score
  FROM words LEFT JOIN means USING (place) WHERE side = 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS place,
         count(*) OVER (PARTITION BY n_words >= 20) * 25 // 100 AS drawn FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND place <= drawn THEN place END AS rank FROM ranked""",
    "op13_merkle_manifest": f"""
WITH RECURSIVE {_CRC_TABLE},
leaves AS (
  SELECT doc_id, lang, sha256(concat({_FIELDS})) AS leaf,
    CASE WHEN {_crc("CAST(doc_id AS VARCHAR)")} % 3 = 0 THEN sha256(concat({_FIELDS.replace("CAST(text AS VARCHAR)", _LOWER % "text")})) END AS changed,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS idx, count(*) OVER (PARTITION BY lang) AS n
  FROM documents, crc_table),
low AS (
  SELECT coalesce('=' || lang, '') AS tree, 0 AS level, idx, leaf AS digest, n FROM leaves
  UNION ALL
  SELECT tree, level + 1, idx // 8, sha256(string_agg(digest, '' ORDER BY idx)), any_value((n + 7) // 8) FROM low WHERE n > 1
  GROUP BY tree, level, idx // 8),
subroots AS (SELECT tree, digest, row_number() OVER (ORDER BY tree) - 1 AS idx, count(*) OVER () AS n FROM low WHERE n = 1),
high AS (
  SELECT 'top' AS tree, 0 AS level, idx, digest, n FROM subroots
  UNION ALL
  SELECT tree, level + 1, idx // 8, sha256(string_agg(digest, '' ORDER BY idx)), any_value((n + 7) // 8) FROM high WHERE n > 1
  GROUP BY tree, level, idx // 8),
runs AS (
  SELECT tree, level, idx // 8 AS run, list(digest ORDER BY idx) AS kids FROM (SELECT * FROM low WHERE n > 1 UNION ALL SELECT * FROM high WHERE n > 1)
  GROUP BY tree, level, idx // 8),
climb AS (
  SELECT l.doc_id, l.leaf, s.digest AS subroot, s.tree AS own, s.idx AS number, l.n,
         CASE WHEN l.n = 1 THEN 'top' ELSE s.tree END AS tree, 0 AS level, CASE WHEN l.n = 1 THEN s.idx ELSE l.idx END AS idx,
         CASE WHEN l.n = 1 THEN s.n ELSE l.n END AS width, coalesce(l.changed, l.leaf) AS folded, '' AS proof, s.n AS trees
  FROM leaves l JOIN subroots s ON s.tree = coalesce('=' || l.lang, '')
  UNION ALL
  SELECT doc_id, leaf, subroot, own, number, n,
         CASE WHEN width <= 8 THEN 'top' ELSE c.tree END,
         CASE WHEN width <= 8 AND c.tree <> 'top' THEN 0 ELSE c.level + 1 END,
         CASE WHEN width <= 8 AND c.tree <> 'top' THEN number ELSE idx // 8 END,
         CASE WHEN width <= 8 AND c.tree <> 'top' THEN trees ELSE (width + 7) // 8 END,
         sha256(concat(array_to_string(kids[:idx % 8], ''), folded, array_to_string(kids[idx % 8 + 2:], ''))),
         concat(proof, array_to_string(kids[:idx % 8], ''), array_to_string(kids[idx % 8 + 2:], '')), trees
  FROM climb c JOIN runs r ON r.tree = c.tree AND r.level = c.level AND r.run = c.idx // 8)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified
FROM climb, (SELECT digest AS root FROM high WHERE n = 1) WHERE climb.tree = 'top' AND climb.width = 1""",
}
