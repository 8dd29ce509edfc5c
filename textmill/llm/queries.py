"""The registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.llm import oracles, substring, suffix
from textmill.llm.bpe import encode_decode
from textmill.llm.common import documents, table
from textmill.llm.exact import exact_dedup
from textmill.llm.jaccard import jaccard_join
from textmill.llm.lm import backoff_scores
from textmill.llm.mixing import mix_sources
from textmill.llm.quality import quality_scores
from textmill.llm.resample import resample
from textmill.llm.simhash import near_dedup
from textmill.llm.syncmers import fingerprint_documents
from textmill.llm.toxicity import toxicity_scores
from textmill.llm.whitening import whiten_embeddings

Query = Callable[[SparkSession, str], DataFrame]
BPE_VOCABULARY = "word_bpe_49k.json"


def bpe_digests(docs: DataFrame) -> DataFrame:
    """``doc_id, n_tokens`` and digests of the ids and of the decoded text."""
    encoded = encode_decode(docs, public_tokenizers.path(BPE_VOCABULARY))
    return encoded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.substring_dedup(documents(spark, sf_dir), substring.DIGEST)


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.suffix_dedup(documents(spark, sf_dir), suffix.DIGEST)


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir))


def op3_quality_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op5_bpe_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(documents(spark, sf_dir))


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(documents(spark, sf_dir))


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    # no document is passed more than twice
    mixed = mix_sources(documents(spark, sf_dir))
    return mixed.withColumn("second_position", F.get("positions", F.lit(1))).drop("positions")


def op8_backoff_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = backoff_scores(documents(spark, sf_dir))
    return scored.withColumns({c: F.round(c, 4) for c in ("log_score", "mean_log_score")})


def op9_syncmer_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(documents(spark, sf_dir))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten_embeddings(table(spark, sf_dir, "embeddings"), most=4)


def op12_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(documents(spark, sf_dir))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resample(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


REGISTRY: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_substring_dedup,
        op2_exact_dedup,
        op3_quality_ranking,
        op4_toxicity,
        op5_bpe_encoding,
        op6_simhash_near_dedup,
        op7_source_mixing,
        op8_backoff_scores,
        op9_syncmer_fingerprints,
        op10_suffix_dedup,
        op11_embedding_whitening,
        op12_jaccard_join,
        op13_importance_resampling,
    )
}

ORACLES: dict[str, str] = {
    "op2_exact_dedup": oracles.EXACT,
    "op7_source_mixing": oracles.MIX,
    "op8_backoff_scores": oracles.BACKOFF,
    "op12_jaccard_join": oracles.JACCARD,
    "op13_importance_resampling": oracles.RESAMPLE,
}
