"""Snapshots laid out along a space-filling curve, for filters on any of several columns.

Sorted by one column, a table lets the Parquet statistics skip row groups for that column
only.  Here each column is cut into 2**bits ranges of about equal rows (bounds from a
sample of the rows, ``selection.quantile_bounds``), the bits of the range numbers are interleaved,
and the rows are range-partitioned and sorted by the result.  Rows near each other in all
columns are then near each other in the files, and a row group spans a small part of every
column, so a filter on any one or two of them skips most groups without an index.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threatlens.functions.selection import quantile_bounds, range_number


def interleaved(numbers: Sequence[Column], bits: int) -> Column:
    """The bits of the numbers, taken in turns from the highest, as one long."""
    if len(numbers) * bits > 62:
        raise ValueError("at most 62 bits in all")
    out = F.lit(0).cast("long")
    for bit in reversed(range(bits)):
        for n in numbers:
            out = F.shiftleft(out, 1).bitwiseOR(F.shiftright(n.cast("long"), bit).bitwiseAND(F.lit(1)))
    return out


def with_curve_position(df: DataFrame, columns: Sequence[str], name: str, bits: int = 6) -> DataFrame:
    """Adds the place of a row on the curve over the columns' ranges; a null is in the first range."""
    bounds = quantile_bounds(df, columns, 1 << bits)
    numbers = {f"_range{i}": range_number(F.col(c), b) for i, (c, b) in enumerate(zip(columns, bounds))}
    placed = df.withColumns(numbers).withColumn(name, interleaved([F.col(n) for n in numbers], bits))
    return placed.select(*df.columns, name)


def write_clustered(
    df: DataFrame, path: str, columns: Sequence[str], files: int | None = None, bits: int = 6, row_group_bytes: int = 16 << 20, mode: str = "overwrite"
) -> None:
    """Parquet files clustered by the columns.  ``df`` is counted, and read once for the sample,
    once for the files' bounds and once for the write; files hold row groups of about
    ``row_group_bytes``.  Rows of one place are parted by a hash, so that a frequent
    combination of values is not one task's."""
    if not columns:
        raise ValueError("name at least one column")
    placed = with_curve_position(df, columns, "_place", bits)
    # Spark hashes no maps and no variants
    hashed = [f.name for f in df.schema.fields if not any(t in f.dataType.simpleString() for t in ("map<", "variant"))]
    placed = placed.withColumn("_part", F.xxhash64(*hashed))
    placed = placed.repartitionByRange(*([files] if files else []), "_place", "_part").sortWithinPartitions("_place").drop("_place", "_part")
    placed.write.mode(mode).option("parquet.block.size", row_group_bytes).parquet(path)
