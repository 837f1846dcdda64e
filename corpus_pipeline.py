"""A corpus pipeline from five operators, each working on what the one before it kept.

Stages take (spark, docs, sf_dir).  All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.llm import bpe, decontamination, jaccard, ranking, rules
from tierflow.llm.common import table
from tierflow.sources.scratch import staged


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and lose little text to the line rules, unchanged."""
    return docs.where(rules.passes(F.col("text")))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored at 0.5 or more; the model is learned from the labelled documents of
    the whole corpus, since the rules have removed most bad ones from ``docs``."""
    model = ranking.learn(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return docs.where(ranking.score(F.col("text"), model) >= 0.5)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return jaccard.one_of_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    return decontamination.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, number of ids and digests of the ids and of the decoded text."""
    return bpe.digests(bpe.encoded(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES = [
    ("quality_rules", quality_rules),
    ("quality_classifier", quality_classifier),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("bpe_encoding", bpe_encoding),
]

#: Ranking, MinHash and encoding have no SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
