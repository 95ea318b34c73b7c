"""The training-data pipeline: language ID, line dedup, near-dedup, benchmark
decontamination, SentencePiece encoding.

Each stage takes what its predecessor kept, written as Parquet and read again; all but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from threatlens.llm import decontam, langid, linededup, neardup, sentencepiece
from threatlens.llm.common import table
from threatlens.session import scratch_path

STAGES = [
    ("language_id", langid.stage),
    ("line_dedup", linededup.stage),
    ("near_duplicates", neardup.stage),
    ("benchmark_decontamination", decontam.stage),
    ("sentencepiece", sentencepiece.stage),
]

#: The stages learn models and run tokenizers, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
