"""From raw documents to token ids: quality, exact and near copies, mixture, encoding.

Every stage is a function of (spark, docs, sf_dir); its result is written as
Parquet and read again as the next one's ``docs``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from affinity.llm.bpe_backtrack import encode_documents
from affinity.llm.common import stored, table
from affinity.llm.exact_dedup import drop_exact_copies
from affinity.llm.mixing_ipf import sample_mixture
from affinity.llm.quality_qda import drop_low_quality
from affinity.llm.simhash_ball import drop_near_copies


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_low_quality(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_exact_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_copies(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sample_mixture(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encode_documents(docs, public_tokenizers.path("word_bpe_49k.json"), decoded=False)


STAGES = [("quality_classifier", quality_classifier), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup),
          ("mixing", mixing), ("encoding", encoding)]

#: no SQL expresses the classifier or the encoder; the tests hold run() against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
