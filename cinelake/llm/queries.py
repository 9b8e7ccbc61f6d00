"""One query per operator over its whole table, with production parameters, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinelake.llm import (
    byte_pairs, cascade, jaccard, langid, mixing, neighbours, pieces, secret_scan, substrings, tokens, toxicity,
    vector_codes, whitening,
)
from cinelake.llm.oracle import ORACLES

__all__ = ["ORACLES", "QUERIES", "model_path"]

TOKENIZER = "piece_bpe_32k.model"
RANKS = "byte_bpe_multi_50k.tiktoken"


def model_path(name: str = TOKENIZER) -> str:
    """Where this machine and every worker keep the public tokenizer."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(table(spark, sf_dir, "documents"), model_path())


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, sf_dir, "documents"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target weights by the square root of each node's tokens, domain, language and source alike."""
    return mixing.mix(table(spark, sf_dir, "documents"), alpha=0.5)


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_shingles", "component_id", "n_links")


def op5_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op6_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), every=50)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cascade.verdicts(table(spark, sf_dir, "documents"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return toxicity.score(documents, toxicity.train(documents, table(spark, sf_dir, "labels")))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = pieces.encode(table(spark, sf_dir, "documents"), model_path(), decoded=True)
    return encoded.select("doc_id", "n_pieces", "ids", "round_trip", F.sha2("text", 256).alias("decoded_sha256"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(table(spark, sf_dir, "embeddings"))


def op13_byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = model_path(RANKS)
    encoded = byte_pairs.encode(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return byte_pairs.decode(encoded, path).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_token_counts, op2_substring_dedup, op3_mixing, op4_ngram_jaccard, op5_secret_scans, op6_nearest_neighbours,
    op7_quality_rules, op8_language_id, op9_toxicity, op10_sentencepiece, op11_whitening, op12_vector_codes,
    op13_byte_level_bpe)}
