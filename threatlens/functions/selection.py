"""Rows of given ranks in a sorted table, without sorting the table.

``orderBy(...).offset(n).limit(k)`` is a top-(n + k): every task keeps that many rows and
one task merges them, so a deep page goes through one task.  Here the sort columns become
one key that only ascends; two keys of a sample of the rows enclose the wanted ranks, one
partial aggregate counts the rows below and between them, and only the rows between them
are looked at again.  A range that is still large is cut in the same way, so a task at the
end sorts at most ``range_rows`` rows of one range, whatever the depth.

Each round scans the table for its sample and its counts (no shuffle of rows): read from
a table, a snapshot or a checkpoint.  A row costs two comparisons a scan.  A round divides
the candidates by about ``sqrt(sample_rows) / 4`` in the middle of the table, and by up to
``ranges`` near its ends.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows sampled for the bounds of one round, about; one task sorts their keys.
SAMPLE_ROWS = 8192

_HEX, _XEH = "0123456789ABCDEF", "FEDCBA9876543210"


def _descending(c: Column, kind: T.DataType) -> Column:
    """A value that ascends where the column descends."""
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return F.bitwise_not(c.cast("long"))
    if isinstance(kind, T.BooleanType):
        return ~c
    if isinstance(kind, (T.FloatType, T.DoubleType, T.DecimalType)):
        return -c
    if isinstance(kind, T.DateType):
        return F.bitwise_not(F.unix_date(c).cast("long"))
    if isinstance(kind, T.TimestampType):
        return F.bitwise_not(F.unix_micros(c))
    if isinstance(kind, T.TimestampNTZType):
        epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        return F.bitwise_not(F.timestamp_diff("MICROSECOND", epoch, c))
    if isinstance(kind, T.StringType):
        # a digit more at the end, so that a text sorts after those it begins
        return F.concat(F.translate(F.hex(F.encode(c, "UTF-8")), _HEX, _XEH), F.lit("G"))
    raise ValueError(f"cannot sort {kind.simpleString()} downwards")


def sort_key(df: DataFrame, order: Sequence[tuple[str, bool]]) -> Column:
    """One ascending struct for ``(column, descending)`` pairs; nulls first upwards and
    last downwards, as ``orderBy`` has them."""
    parts = []
    for name, down in order:
        c = F.col(name)
        if down:
            parts += [c.isNull(), _descending(c, df.schema[name].dataType)]
        else:
            parts.append(c)
    return F.struct(*[p.alias(f"k{i}") for i, p in enumerate(parts)])


def _literal(value: Any, kind: T.DataType) -> Column:
    if isinstance(kind, T.TimestampNTZType) and value is not None:
        return F.lit(value.isoformat(sep=" ")).cast(kind)
    return F.lit(value).cast(kind)


def _sampled(df: DataFrame, rows: int, sample_rows: int, seed: int = 0) -> DataFrame:
    """About ``sample_rows`` of the ``rows`` rows.  Every row is as likely as any other, so a
    value has its share of the sample however often it occurs."""
    return df if rows <= sample_rows else df.sample(sample_rows / rows, seed)


def quantile_bounds(df: DataFrame, columns: Sequence[str], ranges: int, sample_rows: int = SAMPLE_ROWS) -> list[list[Column]]:
    """For each column the distinct values, ascending and without null, that cut it into at
    most ``ranges`` parts of about equal rows (a frequent value is one part), from one sample."""
    names = [f"v{i}" for i in range(len(columns))]
    values = df.select(*[F.col(c).alias(v) for c, v in zip(columns, names)])

    def cuts(name: str) -> Column:
        held = F.sort_array(F.collect_list(name))
        places = F.sequence(F.lit(1), F.lit(ranges - 1))
        at = F.transform(places, lambda i: F.get(held, F.floor(i * F.size(held) / ranges).cast("int")))
        return F.array_distinct(F.filter(at, lambda v: v.isNotNull())).alias(name)

    found = _sampled(values, df.count(), sample_rows).agg(*[cuts(v) for v in names]).first()
    return [[_literal(b, values.schema[v].dataType) for b in found[v]] for v in names]


def range_number(value: Column, bounds: Sequence[Column]) -> Column:
    """The number of ascending bounds that are at most the value, by halving; 0 for null."""

    def among(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(value >= bounds[middle], among(middle + 1, high)).otherwise(among(low, middle))

    return among(0, len(bounds))


def _enclosing(rows: DataFrame, held: int, start: int, stop: int, ranges: int, sample_rows: int, seed: int) -> tuple[Any, Any]:
    """Two keys of a sample of the ``held`` rows between which the ranks from ``start`` to
    before ``stop`` most likely lie; None for no bound.  Four standard errors are left on
    either side, and a half of one of ``ranges`` parts."""
    keys = _sampled(rows.select("_key"), held, sample_rows, seed).agg(F.sort_array(F.collect_list("_key")).alias("keys"))
    n = F.size("keys")

    def place(rank: int, side: int) -> Column:
        share = rank / held
        room = F.floor(n / (2 * ranges))
        if held > sample_rows:
            room = F.greatest(room, F.ceil(4 * F.sqrt(n * share * (1 - share))) + 1)
        return (F.floor(n * share) + side * room).cast("int")

    low, high = place(start, -1), place(stop - 1, 1)
    # get is null beyond either end
    return tuple(keys.select(F.get("keys", low).alias("low"), F.get("keys", high).alias("high")).first())


def rows_between(
    df: DataFrame,
    order: Sequence[tuple[str, bool]],
    start: int,
    count: int,
    range_rows: int = 100_000,
    ranges: int = 256,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """The rows of ranks ``start`` to ``start + count - 1`` (from 0) in ``order``, sorted.

    ``order`` lists (column, descending) and should be unique, as for any stable page; of
    rows with equal keys any may be taken."""
    if start < 0 or count < 1 or range_rows < 1 or ranges < 2:
        raise ValueError("need start >= 0, count >= 1, range_rows >= 1 and ranges >= 2")
    rows = df.select("*", sort_key(df, order).alias("_key"))
    kind = rows.schema["_key"].dataType
    held, skipped, seed = df.count(), 0, 0
    if start >= held:  # the page lies behind the last row
        return df.filter(F.lit(False))
    stop = min(start + count, held)
    everything = rows
    bottom = top = None  # keys that enclose the candidates
    while held > max(range_rows, count):
        low, high = _enclosing(rows, held, start - skipped, stop - skipped, ranges, sample_rows, seed)
        seed += 1
        below = F.col("_key") < _key_literal(low, kind) if low is not None else F.lit(False)
        within = F.col("_key") <= _key_literal(high, kind) if high is not None else F.lit(True)
        sizes = rows.agg(F.count_if(below).alias("below"), F.count_if(within).alias("within")).first()
        # counted, not estimated: a side that the sample misjudged keeps its old bound
        from_low = low is not None and skipped + sizes["below"] <= start
        to_high = high is not None and skipped + sizes["within"] >= stop
        kept = (sizes["within"] if to_high else held) - (sizes["below"] if from_low else 0)
        if kept == held:  # keys that bounds can't part
            break
        held = kept
        if from_low:
            bottom, skipped = low, skipped + sizes["below"]
        if to_high:
            top = high
        rows = everything
        if bottom is not None:
            rows = rows.filter(F.col("_key") >= _key_literal(bottom, kind))
        if top is not None:
            rows = rows.filter(F.col("_key") <= _key_literal(top, kind))
    return rows.orderBy("_key").drop("_key").offset(start - skipped).limit(count)


def _key_literal(key: Sequence, kind: T.StructType) -> Column:
    return F.struct(*[_literal(v, f.dataType).alias(f.name) for v, f in zip(key, kind.fields)])
