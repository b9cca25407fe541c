"""A corpus pipeline over ``documents``: quality, near duplicates, benchmark decontamination, personal data, tokens.

Every stage takes (spark, docs, sf_dir) and works on all that the one before it kept. All but the last return the columns of
``documents``. Rows are judged one by one, so null or repeated ids do no harm; each operator's module states what else it does with odd rows.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statledger.llm import bpe, decontam, jaccard, pii, quality
from statledger.llm.queries import VOCABULARY
from statledger.llm.shared import folder, stored, table


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality classifier accepts."""
    return quality.kept(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest doc_id."""
    return jaccard.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no benchmark item."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their personal data replaced by marks; n_chars follows the text."""
    found = pii.redacted(docs)
    return found.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else found


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number of ids and digests of ids and decoded bytes of every document."""
    return bpe.encode_digests(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)


STAGES = [
    ("quality", quality_filter), ("near_duplicates", near_duplicates), ("decontaminate", decontaminate), ("personal_data", personal_data),
    ("tokens", tokens),
]
#: SQL cannot express the learned and latent stages; the tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over ``documents``; each result is written to the shared folder and read again."""
    where, docs = folder(spark), table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name, where)
    return STAGES[-1][1](spark, docs, sf_dir)
