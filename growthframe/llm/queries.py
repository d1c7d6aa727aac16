"""One query per text operator, with production parameters, over its whole table; oracles where SQL can state the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from growthframe.llm.common import table
from growthframe.llm.decontaminate import find_leaks
from growthframe.llm.jaccard_join import jaccard_components
from growthframe.llm.line_dedup import dedup_lines
from growthframe.llm.piece_codec import encode
from growthframe.llm.pii import BASE, KINDS, find_pii
from growthframe.llm.quality import quality
from growthframe.llm.sharding import assign_shards
from growthframe.llm.simhash import near_duplicates
from growthframe.llm.spelling import spelling_variants
from growthframe.llm.substring_dedup import remove_repeats
from growthframe.llm.token_counts import token_counts
from growthframe.llm.toxicity import score
from growthframe.llm.whitening import whiten

#: Byte limit of a shard in the registered query: small, so that the small tables split as well and hold single rows over it.
SHARD_BYTES = 1 << 16


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every document."""
    found = near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    hexed = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return found.select(F.col("id").alias("doc_id"), hexed.alias("fingerprint"), F.col("component").alias("component_id"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every document."""
    found = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id``, the base statistics, ``base_failed``, ``kept``, perplexity and band of every document."""
    return quality(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` and the length that fits 4096 tokens, of every document."""
    return token_counts(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, item_id, cosine, n_common, n_item`` of every benchmark item in every document."""
    found = find_leaks(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), "item_id", F.round("cosine", 3).alias("cosine"), "n_common", "n_item")


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, n_bytes, shard, depth, shard_bytes`` of every document, in shards of at most 64 KiB (a longer row alone)."""
    return assign_shards(table(spark, sf_dir, "documents").select("doc_id", "text"), SHARD_BYTES).drop("text")


def op6_sql(limit: int) -> str:
    """SQL of the shards for any limit: the shallowest prefix that fits, or parts of a full hash that doesn't."""
    return f"""
WITH hashed AS (
  SELECT row_number() OVER () AS r, doc_id, strlen(coalesce(text, '')) AS n_bytes,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))), 1, 15))::BIGINT AS h
  FROM documents
), prefixed AS (
  SELECT h.*, d.depth, h.h >> (60 - d.depth)::INTEGER AS prefix FROM hashed h, range(0, 61) d(depth)
), nodes AS (
  SELECT depth, prefix, sum(n_bytes)::BIGINT AS shard_bytes FROM prefixed GROUP BY ALL HAVING sum(n_bytes) <= {limit}
), fitting AS (
  SELECT r, doc_id, n_bytes, CASE WHEN depth = 0 THEN '' ELSE lpad(bin(prefix), depth::INTEGER, '0') END AS shard, depth, shard_bytes
  FROM prefixed JOIN nodes USING (depth, prefix)
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY depth) = 1
), dealt AS (
  SELECT *, greatest(1, {limit} // n_bytes) AS per, count(*) OVER (PARTITION BY h) AS n, row_number() OVER (PARTITION BY h ORDER BY r) - 1 AS k
  FROM hashed WHERE r NOT IN (SELECT r FROM fitting)
)
SELECT doc_id, n_bytes, shard, depth, shard_bytes FROM fitting
UNION ALL
SELECT doc_id, n_bytes, lpad(bin(h), 60, '0') || '.' || (k // per), 60::BIGINT, least(per, n - k // per * per) * n_bytes FROM dealt
"""


def op7_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, ids, n_tokens, round_trip`` of every document."""
    return encode(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans`` of every document."""
    found = find_pii(table(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = [F.expr(f"cast(size(filter(base, s -> s.kind = '{k}')) AS bigint)").alias(f"n_{k}") for k in BASE]

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["first"].cast("string"), s["past"].cast("string"))), ",")

    order = F.array(*[F.lit(k) for k in KINDS])
    both = F.concat("base", "added")
    keyed = F.transform(both, lambda s: F.struct(F.array_position(order, s["kind"]).alias("n"), s["first"].alias("first"), s["past"].alias("past"), s["kind"].alias("kind")))
    return found.select(F.col("id").alias("doc_id"), *counts, F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.array_sort(keyed)).alias("spans"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document; learnt from `labels` outside the held-out quarter."""
    found = score(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return found.withColumnRenamed("id", "doc_id")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, n_lines, n_removed, n_runs, kept_sha256`` of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = dedup_lines(docs)
    return done.select("doc_id", "n_lines", "n_removed", "n_runs", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


OP10_SQL = r"""
WITH raw AS (
  SELECT DISTINCT doc_id, text FROM documents WHERE text IS NOT NULL
), lined AS (
  SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS ln FROM raw
), worded AS (
  SELECT *, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS w,
         row_number() OVER (PARTITION BY doc_id, text ORDER BY ln) AS i
  FROM lined WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), grown AS (
  SELECT a.doc_id, a.text, a.ln AS first_ln, b.ln AS last_ln, b.i - a.i + 1 AS n,
         sum(c.w) AS w, string_agg(c.line, chr(10) ORDER BY c.i) AS run
  FROM worded a JOIN worded b ON a.doc_id = b.doc_id AND a.text = b.text AND b.i BETWEEN a.i AND a.i + 3
  JOIN worded c ON a.doc_id = c.doc_id AND a.text = c.text AND c.i BETWEEN a.i AND b.i
  GROUP BY ALL
), later AS (
  SELECT *, row_number() OVER (PARTITION BY run, n ORDER BY doc_id, first_ln) AS copy FROM grown WHERE n >= 4 OR w >= 50
), gone AS (
  SELECT DISTINCT doc_id, text, ln FROM (
    SELECT doc_id, text, unnest(range(first_ln, last_ln + 1)) AS ln FROM later WHERE copy > 1)
), marked AS (
  SELECT l.*, g.ln IS NOT NULL AS out,
         coalesce(lag(g.ln IS NOT NULL) OVER (PARTITION BY l.doc_id, l.text ORDER BY l.ln), false) AS out_before
  FROM lined l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.text = g.text AND l.ln = g.ln
), per_doc AS (
  SELECT doc_id, text, count(*) AS n_lines, count(*) FILTER (out) AS n_removed,
         count(*) FILTER (out AND NOT out_before) AS n_runs,
         sha256(coalesce(string_agg(line, chr(10) ORDER BY ln) FILTER (NOT out), '')) AS kept_sha256
  FROM marked GROUP BY doc_id, text
)
SELECT d.doc_id, coalesce(p.n_lines, 0) AS n_lines, coalesce(p.n_removed, 0) AS n_removed,
       coalesce(p.n_runs, 0) AS n_runs, coalesce(p.kept_sha256, sha256('')) AS kept_sha256
FROM documents d LEFT JOIN per_doc p ON d.doc_id = p.doc_id AND d.text = p.text
"""

def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every frequent word of the documents."""
    return spelling_variants(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op12_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every document: sets of 3-word shingles with 90 % of their union in common."""
    found = jaccard_components(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``: eight components of every valid vector."""
    return whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding")).withColumnRenamed("id", "vec_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash_near_dedup": op1_simhash_near_dedup,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_quality_rules": op3_quality_rules,
    "op4_token_counts": op4_token_counts,
    "op5_decontamination": op5_decontamination,
    "op6_sharding": op6_sharding,
    "op7_piece_codec": op7_piece_codec,
    "op8_pii": op8_pii,
    "op9_toxicity": op9_toxicity,
    "op10_line_dedup": op10_line_dedup,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_jaccard_join": op12_jaccard_join,
    "op13_whitening": op13_whitening,
}
ORACLES: dict[str, str] = {
    "op6_sharding": op6_sql(SHARD_BYTES).strip(),
    "op10_line_dedup": OP10_SQL.strip(),
}
