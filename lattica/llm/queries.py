"""The registered queries of the corpus operators, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, byte_bpe, exact_dedup, language_id, lm_score, mixing, near_dedup, sharding, span_dedup, token_counts
from .common import table

Query = Callable[[SparkSession, str], DataFrame]
#: Bytes of text in a shard.
SHARD_BYTES = 1 << 20


def vocabulary(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.group_texts(table(spark, sf_dir, "documents"), keep="largest")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op3_span_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return span_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op4_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), every=50, k=5)


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.allot(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), percent=85, width=3)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn("held_out", language_id.bucket("doc_id", 5) == 0)
    model = language_id.fit(docs, ~F.col("held_out"))
    return language_id.predict(docs, model, carry=("held_out",))


def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score(table(spark, sf_dir, "documents"), language_id.bucket("doc_id", 7) == 2)


def op10_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(table(spark, sf_dir, "documents"), limit=SHARD_BYTES)


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (op1_exact_dedup, op2_token_counts, op3_span_dedup, op4_nearest, op5_byte_bpe, op6_mix_sources, op7_near_dedup, op8_language_id, op9_lm_score, op10_shard)}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_exact_dedup": """
WITH n AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM n JOIN g USING (t)""",
        "op6_mix_sources": mixing.ORACLE,
        "op10_shard": sharding.ORACLE.format(limit=SHARD_BYTES),
    }
