"""The registered queries of the numbered operators, and their SQL where it exists.

Each query applies its operator to the whole table that it is meant for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from threatlens.llm import decontam, divergence, fingerprint, langid, linededup, lmscore, neardup, pii, quality, secrets, sentencepiece, spelling, suffixdedup
from threatlens.llm.common import table


def op1_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprints(spark, table(spark, sf_dir, "documents"))


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(spark, sf_dir)


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secrets(spark, table(spark, sf_dir, "documents"))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(spark, table(spark, sf_dir, "documents"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_id(spark, table(spark, sf_dir, "documents"))


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lmscore.lm_score(spark, sf_dir)


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.line_dedup(spark, table(spark, sf_dir, "documents"))


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece.sentencepiece_ids(spark, table(spark, sf_dir, "documents"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixdedup.suffix_dedup(spark, table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_groups(spark, table(spark, sf_dir, "documents"))


def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(spark, table(spark, sf_dir, "documents"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(spark, table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_document_fingerprints,
        op2_benchmark_decontamination,
        op3_quality_classifier,
        op4_secret_scan,
        op5_near_duplicates,
        op6_language_id,
        op7_lm_scoring,
        op8_line_dedup,
        op9_sentencepiece,
        op10_suffix_dedup,
        op11_spelling_variants,
        op12_personal_data,
        op13_source_divergence,
    )
}

ORACLE: dict[str, str] = {
    "op11_spelling_variants": spelling.SQL,
    "op13_source_divergence": divergence.SQL,
}
