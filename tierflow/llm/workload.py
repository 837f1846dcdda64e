"""The registered queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tierflow.llm import (
    bpe, chat, ctw, decontamination, html, imatch, jaccard, licences, negatives,
    ranking, rules, search, tokens,
)
from tierflow.llm.common import table
from tierflow.sources.scratch import scratch_path


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.quality_figures(table(spark, sf_dir, "documents"))


def html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extracted(table(spark, sf_dir, "pages"))


def benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


def token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = scratch_path(spark, "tokens")
    tokens.write(
        table(spark, sf_dir, "documents"), target, public_tokenizers.path("byte_bpe_50k.json")
    )
    return tokens.read(spark, target)


def bpe_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return bpe.digests(bpe.encoded(table(spark, sf_dir, "documents"), path))


def lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctw.scored(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat_formatting": chat.query,
    "op2_html_extraction": html_extraction,
    "op3_quality_rules": quality_rules,
    "op4_benchmark_decontamination": benchmark_decontamination,
    "op5_quality_classifier": quality_classifier,
    "op6_ngram_jaccard_join": jaccard_join,
    "op7_token_ids": token_ids,
    "op8_bpe_encoding": bpe_encoding,
    "op9_lm_scoring": lm_scoring,
    "op10_licence_scan": licences.query,
    "op11_ranked_search": search.query,
    "op12_document_fingerprints": imatch.query,
    "op13_hard_negatives": negatives.query,
    "pipeline": corpus_pipeline.run,
}

#: The others are iterative, need a tokenizer or depend on hashing; tests check them.
ORACLES: dict[str, str] = {
    "op1_chat_formatting": chat.ORACLE,
    "op2_html_extraction": html.ORACLE,
    "op3_quality_rules": rules.ORACLE,
    "op10_licence_scan": licences.ORACLE,
    "op11_ranked_search": search.ORACLE,
    "op12_document_fingerprints": imatch.ORACLE,
    "op13_hard_negatives": negatives.ORACLE,
}
