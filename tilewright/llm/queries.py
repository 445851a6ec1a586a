"""The queries of this subpackage's operators, and SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tilewright.llm import (
    bit_sliced,
    host_reputation,
    oracles,
    piece_bpe,
    sentence_spans,
    sharding,
    simhash,
    site_style,
    spaced_seeds,
    toxicity,
    viterbi,
)
from tilewright.llm.common import read

#: Vocabulary file of ops 4 and 7.
PIECES = public_tokenizers.path("piece_bpe_32k.model")
#: Rules of op 1 and what they say (fixed values).
URL_RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))

#: Shards of op 3 and the seed of their shuffle.
SHARDS, SHARD_SEED = 24, 2024


def op1_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on all page urls."""
    return host_reputation.judge_urls(read(spark, sf_dir, "pages"), read(spark, sf_dir, "labels"), URL_RULES)


def op2_bit_sliced_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best inner products of every 20th vector with all."""
    vectors = read(spark, sf_dir, "embeddings")
    return bit_sliced.top_inner_products(vectors, vectors.where("vec_id % 20 = 0"), k=20, scale=64)


def op3_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of all documents."""
    return sharding.feistel_shards(read(spark, sf_dir, "documents"), SHARDS, SHARD_SEED)


def op4_viterbi_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram token counts of all documents."""
    return viterbi.token_counts(read(spark, sf_dir, "documents"), PIECES)


def op5_nb_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents."""
    return toxicity.toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op6_site_style(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    return site_style.site_style_text(read(spark, sf_dir, "pages"))


def op7_piece_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of all documents' ids and decoded texts."""
    return piece_bpe.piece_bpe_digests(read(spark, sf_dir, "documents"), PIECES)


def op8_simhash_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of all documents."""
    return simhash.simhash_components(read(spark, sf_dir, "documents"))


def op9_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' texts without repeated runs of sentences."""
    return sentence_spans.substring_dedup(read(spark, sf_dir, "documents")).select("doc_id", "text", "n_removed")


def op10_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlaps of all documents with test items."""
    return spaced_seeds.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus pipeline over all documents."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_host_reputation,
        op2_bit_sliced_topk,
        op3_feistel_shards,
        op4_viterbi_counts,
        op5_nb_toxicity,
        op6_site_style,
        op7_piece_bpe,
        op8_simhash_anchors,
        op9_sentence_spans,
        op10_spaced_seeds,
        pipeline,
    )
}

#: Whole-table SQL of the queries that SQL can express.
ORACLES: dict[str, str] = {
    "op1_host_reputation": oracles.host_reputation_sql(URL_RULES),
    "op3_feistel_shards": oracles.feistel_shards_sql(SHARDS, SHARD_SEED),
    "op9_sentence_spans": oracles.sentence_spans_sql(),
    "op2_bit_sliced_topk": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id
  WHERE a.vec_id % 20 = 0
), ranked AS (
  SELECT query_id, vec_id, score,
         CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
  FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
""",
}
