"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text bytes that a task holds as Python objects at a time.
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_text(docs: DataFrame) -> DataFrame:
    """The two columns the operators work on; any other column may have any name."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def fold(doc_id: str, modulus: int):
    """crc32 of the document id as text, modulo ``modulus``: the deterministic folds."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus


def text_slices(batches: Iterable[pa.RecordBatch], column: str, max_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that a slice has at most ``max_bytes`` of text, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes)
        start = 0
        while start < batch.num_rows:
            before = int(ends[start - 1]) if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + max_bytes, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a batch; null counts as the empty text."""
    return [t or "" for t in batch.column(column).to_pylist()]


def input_bytes(docs: DataFrame, column: str = "text") -> int:
    """Bytes of text, from one scan of the one column; it sizes the number of shards."""
    return docs.agg(F.sum(F.octet_length(column)).alias("n")).first()["n"] or 0


def partitions_for(spark: SparkSession, total_bytes: int, target_bytes: int) -> int:
    """Partitions of about ``target_bytes`` each, and never fewer than the session's."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total_bytes // target_bytes), 1)
