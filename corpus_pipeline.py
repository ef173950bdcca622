"""From raw documents to token ids: each stage is one corpus operator, applied to what its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from leadtime.llm import decontaminate, mixing, near_dedup, quality, token_ids
from leadtime.llm.common import small_batches, table
from leadtime.plans.lineage import materialize

#: The near-duplicate rule is the operator's contract: four words, a similarity of 0.8.
SHINGLE, PERCENT, TOKENIZER = 4, 80, "word_bpe_49k.json"


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that the rule ensemble scores below 0.5 go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest id."""
    small_batches(spark)
    return near_dedup.drop_near_copies(docs, SHINGLE, PERCENT)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that benchmark windows cover by a twentieth or more go."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows are repeated, cut or left out so that the sources meet their weights."""
    small_batches(spark)
    return mixing.mixed_documents(docs)


def token_id_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Grammar-compressed shards of token ids, reported from the files."""
    small_batches(spark)
    return token_ids.token_ids(docs, TOKENIZER)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("minhash_near_dedup", minhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mixing", source_mixing),
    ("token_id_output", token_id_output),
]

#: SQL can express neither the classifier nor the tokenizer; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
