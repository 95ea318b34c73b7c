"""Small Column-expression helpers shared by the views and operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def pick(values: Sequence, index: Column) -> Column:
    """``values[index]`` for a non-negative index column (null when out of range)."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), index.cast("int") + 1)


def pick_mod(values: Sequence, key: Column) -> Column:
    """``values[key mod len(values)]`` with a non-negative modulus."""
    return pick(values, F.pmod(key, F.lit(len(values))))


def lookup(mapping: Sequence[tuple], key: Column, default=None) -> Column:
    """CASE key WHEN k1 THEN v1 ... ELSE default (exact, case-sensitive)."""
    expr = None
    for k, v in mapping:
        expr = F.when(key == k, F.lit(v)) if expr is None else expr.when(key == k, F.lit(v))
    return expr.otherwise(F.lit(default)) if expr is not None else F.lit(default)


def text(prefix: str, value: Column) -> Column:
    return F.concat(F.lit(prefix), value.cast("string"))


def is_true(c: Column) -> Column:
    """Null-safe truth test: null counts as false."""
    return F.coalesce(c, F.lit(False))


def escape_text(c: Column) -> Column:
    """Text for one line of a text file: backslash, line breaks and NUL as ``\\\\``,
    ``\\n``, ``\\r`` and ``\\0``, the empty text as ``\\e`` (null stays null)."""
    out = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    for char, name in (("\n", "n"), ("\r", "r"), ("\0", "0")):
        out = F.replace(out, F.lit(char), F.lit(f"\\{name}"))
    return F.when(c == "", F.lit("\\e")).otherwise(out)


def unescape_text(c: Column) -> Column:
    """The text that ``escape_text`` was given."""

    def part(x: Column) -> Column:
        for char, name in (("\n", "n"), ("\r", "r"), ("\0", "0"), ("", "e")):
            x = F.replace(x, F.lit(f"\\{name}"), F.lit(char))
        return x

    # doubled backslashes part the text; what remains between them are the other escapes
    return F.array_join(F.transform(F.split(c, r"\\\\", -1), part), "\\")
