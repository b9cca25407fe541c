"""The registered queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import ann, bpe, chat, codes, decontam, divergence, jaccard, langid, licenses, pii, quality, urls, warc
from .shared import table

VOCABULARY = "byte_bpe_50k.tiktoken"


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of ids and digests of ids and decoded bytes of every document."""
    return bpe.encode_digests(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)


def op2_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows of each row whose vec_id is divisible by 20."""
    return ann.nearest(table(spark, sf_dir, "embeddings"))


def op3_quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document."""
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_maximal_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation that is no beginning of a longer one, rendered."""
    return chat.rendered(table(spark, sf_dir, "conversations"))


def op5_url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on the url of every page."""
    return urls.judged(table(spark, sf_dir, "pages"))


def op6_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    return langid.languages(table(spark, sf_dir, "documents"))


def op7_benchmark_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the benchmark items they hold."""
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents linked by a Jaccard similarity of word 5-grams of 0.8 or more."""
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op10_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as read back from the archives written of all pages."""
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and spans of licence templates in every document."""
    return licenses.scanned(table(spark, sf_dir, "documents"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product code of every vector with finite components."""
    return codes.vector_codes(table(spark, sf_dir, "embeddings"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the sources of each language differ in their terms."""
    return divergence.source_divergence(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_byte_bpe, op2_nearest_vectors, op3_quality_scores, op4_maximal_chats, op5_url_verdicts, op6_languages, op7_benchmark_hits,
        op8_ngram_jaccard_join, op9_personal_data, op10_warc_round_trip, op11_license_scan, op12_vector_codes, op13_source_divergence)}
