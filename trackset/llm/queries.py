"""The contract queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    byte_bpe,
    common,
    forest,
    language_mix,
    line_quality,
    mixing,
    passages,
    simhash,
    token_counts,
    toxicity,
    warc_zip,
)

#: Documents of more tokens are over the limit.
TOKEN_LIMIT = 512


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cache starts empty at each call, so that the figures of a run show the whole work."""
    counts = token_counts.count_tokens(
        common.read_table(spark, sf_dir, "documents"),
        Path(public_tokenizers.path("byte_bpe_50k.json")).read_text(encoding="utf-8"),
        common.scratch_path(spark, "token-cache"),
    )
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op2_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = forest.near_duplicates(common.read_table(spark, sf_dir, "embeddings"))
    return found.withColumn("kept", F.col("vec_id") == F.col("component_id"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (common.read_table(spark, sf_dir, t) for t in ("documents", "labels"))
    found = toxicity.score(docs, labels)
    return found.withColumn("predicted", (F.col("score") >= toxicity.THRESHOLD).cast("int"))


def op4_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc_zip.round_trip(common.read_table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = passages.remove_repeats(common.read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("row.doc_id", "n_words", "n_removed", "kept_sha256")


def op6_language_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_mix.identify(common.read_table(spark, sf_dir, "documents"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(common.read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(common.read_table(spark, sf_dir, "documents"))


def op10_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = line_quality.judge(common.read_table(spark, sf_dir, "documents"), ["doc_id"])
    return judged.select("row.doc_id", "*").drop("row", "lost")


def rank_file() -> bytes:
    return Path(public_tokenizers.path("byte_bpe_50k.tiktoken")).read_bytes()


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read_table(spark, sf_dir, "documents")
    done = byte_bpe.round_trip(docs, rank_file(), public_tokenizers.PATTERN)
    return done.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        "n_split",
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_forest": op2_forest,
    "op3_toxicity": op3_toxicity,
    "op4_warc_zip": op4_warc_zip,
    "op5_passages": op5_passages,
    "op6_language_mix": op6_language_mix,
    "op7_simhash": op7_simhash,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_mixing": op9_mixing,
    "op10_line_quality": op10_line_quality,
}

OP5_SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 19], ' ') AS seq
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM w WHERE len(ws) >= 20)),
again AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY seq ORDER BY doc_id, i) AS nth FROM s)
  WHERE nth > 1),
gone AS (SELECT DISTINCT doc_id, pos FROM (SELECT doc_id, unnest(range(i, i + 20)) AS pos FROM again)),
words AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS pos FROM w),
kept AS (
  SELECT doc_id, count(*) AS n_kept, string_agg(word, ' ' ORDER BY pos) AS txt
  FROM words ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n_kept, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(txt, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""

OP2_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL)) = 0
    AND len(list_filter(embedding, lambda e: NOT isfinite(e))) = 0
    AND len(list_filter(embedding, lambda e: e <> 0)) > 0),
l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.x, b.x) >= 0.98),
r AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT vec_id, (SELECT count(*) FROM l WHERE l.a = vec_id) AS n_links,
       least(vec_id, coalesce((SELECT min(b) FROM r WHERE r.a = vec_id), vec_id)) AS component_id,
       vec_id <= coalesce((SELECT min(b) FROM r WHERE r.a = vec_id), vec_id) AS kept
FROM embeddings
"""

OP4_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b) AS payload_bytes, sha256(b) AS payload_digest FROM p),
f AS (SELECT payload_digest, min(page_id) AS first_id FROM d WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN first_id IS NULL OR first_id = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first_id <> page_id THEN first_id END AS refers_to
FROM d LEFT JOIN f USING (payload_digest)
"""

OP9_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) >> 30 AS p
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
r AS (
  SELECT *, 2 * CAST(source_size AS DOUBLE) AS cap,
         CAST([3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS DOUBLE) AS weight,
         row_number() OVER (ORDER BY source NULLS LAST) AS place FROM s),
l AS (
  SELECT *, row_number() OVER (ORDER BY cap / weight, place) AS nth,
         (1.5 * CAST(sum(source_size) OVER () AS DOUBLE)
          - coalesce(sum(cap) OVER (ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
         / sum(weight) OVER (ORDER BY cap / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM r),
t AS (
  SELECT source, source_size, least(cap, coalesce(
    (SELECT arg_min(level, nth) FROM l WHERE level * weight <= cap) * weight, cap)) AS target FROM l),
g AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS passes FROM t),
b AS (
  SELECT d.source, d.p, sum(d.size) AS words, any_value(g.target - g.passes * g.source_size) AS rest
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source WHERE g.target - g.passes * g.source_size >= 0.5
  GROUP BY d.source, d.p),
c AS (SELECT *, sum(words) OVER (PARTITION BY source ORDER BY p) AS upto FROM b),
e AS (
  SELECT source, p + CASE WHEN upto - rest < rest - (upto - words) THEN 1 ELSE 0 END AS cut
  FROM c WHERE upto > rest AND upto - words <= rest)
SELECT doc_id, size, source_size, target, passes + CASE WHEN p < coalesce(cut, 0) THEN 1 ELSE 0 END AS copies,
       size * (passes + CASE WHEN p < coalesce(cut, 0) THEN 1 ELSE 0 END) AS taken
FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source LEFT JOIN e ON d.source IS NOT DISTINCT FROM e.source
"""

OP10_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id, coalesce(source, '') AS host, coalesce(text, '') AS txt,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM documents),
w AS (
  SELECT k, i, array_to_string(ws[i:i + 2], ' ') AS seq
  FROM (SELECT k, ws, unnest(range(1, len(ws) - 1)) AS i FROM d WHERE len(ws) >= 3)),
again AS (SELECT k, i FROM (SELECT k, i, count(*) OVER (PARTITION BY k, seq) AS n FROM w) WHERE n > 1),
rep AS (
  SELECT k, count(DISTINCT pos) AS n_repeat_words FROM (SELECT k, unnest([i, i + 1, i + 2]) AS pos FROM again)
  GROUP BY k),
ln AS (
  SELECT k, host, doc_id, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS lw
  FROM (SELECT k, host, doc_id, unnest(ls) AS line FROM d)),
nl AS (
  SELECT k, host, doc_id, translate(array_to_string(lw, ' '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz') AS line, len(lw) AS n FROM ln),
b AS (
  SELECT d.k, len(ws) < 50 OR 100 * coalesce(n_repeat_words, 0) > 50 * len(ws) AS failed FROM d LEFT JOIN rep USING (k)),
f AS (
  SELECT host, line, count(DISTINCT doc_id) AS n_docs, min(doc_id) FILTER (NOT failed) AS first_id
  FROM nl JOIN b USING (k) GROUP BY host, line),
lost AS (
  SELECT nl.k, sum(nl.n) AS n_lost FROM nl JOIN f USING (host, line)
  WHERE f.n_docs > 20 AND nl.doc_id IS DISTINCT FROM f.first_id GROUP BY nl.k),
m AS (
  SELECT d.k, doc_id, CAST(len(ws) AS BIGINT) AS n_words,
         CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
         CAST(length(txt) - length(translate(txt, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
         CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words, coalesce(n_lost, 0) AS n_lost
  FROM d LEFT JOIN rep USING (k) LEFT JOIN lost ON lost.k = d.k)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, CAST(n_lost AS BIGINT) AS n_lost,
       (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 100 * (n_words - n_lost) >= 30 * n_words AS kept
FROM m
"""

ORACLE_SQL: dict[str, str] = {"op4_warc_zip": OP4_SQL, "op2_forest": OP2_SQL, "op9_mixing": OP9_SQL, "op10_line_quality": OP10_SQL, "op5_passages": OP5_SQL}
