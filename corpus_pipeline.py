"""Documents to packed training sequences, in five written stages.

Every stage reads all rows that the one before kept. A lost executor costs no more than the
running stage: its input is a written table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from meshfold.llm import decontaminate, nearcopies, packing, pii, quality, tokens
from meshfold.llm.common import store, table
from meshfold.llm.queries import pii_key
from meshfold.session import prepare


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the positive-unlabelled classifier does not reject."""
    return quality.keep_good(docs, table(prepare(spark), sf_dir, "labels"))


def keep_one_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8 or more."""
    return nearcopies.keep_one(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def replace_personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with pseudonyms for personal data."""
    return pii.pseudonymise(docs, pii_key(spark))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed token sequences, with their ids."""
    return packing.pack(docs, tokens.word_bpe_path())


STAGES = [("quality_classifier", keep_quality), ("simhash_near_dedup", keep_one_copy),
          ("benchmark_decontamination", remove_benchmark), ("pii_pseudonyms", replace_personal),
          ("lexical_packing", pack_sequences)]

#: A fitted classifier, keyed digests and token ids have no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), name)
    return docs
