"""A corpus pipeline over the text operators (counted as part of vesseltrack.llm).

Five stages, each a function (spark, docs, sf_dir) -> DataFrame over everything
its predecessor kept; between stages the rows are written as Parquet under the
shared checkpoint folder and read again, so a lost executor costs a part of one
stage only. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from vesseltrack.llm import bpe, decontaminate, ngram_join, quality_rules, toxicity
from vesseltrack.llm.common import table
from vesseltrack.session import materialize


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the machine, trained on the labelled ones, scores below 0.7."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither a base rule nor the verdict on their host rejects."""
    return quality_rules.keep_good(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group linked at 80 % of shared 5-word shingles."""
    return ngram_join.keep_one_each(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their benchmark passages; those that are mostly such passages go."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and digests of the ids and of the bytes decoded from them."""
    return bpe.encode_digests(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", toxicity_stage),
    ("quality_rules", quality_stage),
    ("ngram_jaccard_join", near_duplicate_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("byte_bpe", encoding_stage),
]

#: Learned scores are not expressible in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
