"""Spelling variants by Bloom-guided neighbourhoods.

Runs of Latin letters are counted in one pass over the texts; the frequent ones are the
vocabulary.  Two words are near if one inserted, deleted or replaced code point leads from
one to the other.

Filters: the vocabulary is sharded by word length (and a large length by hash), and a task
for each shard builds its blocked Bloom filter: a word sets ``PROBES`` bits of one block of
512.  A broadcast holds the filters of as many shards as fit into ``broadcast_bytes``; a
larger vocabulary takes several passes, each over the vocabulary and never over the texts.

Probes: from each word all deletions, and the replacements by larger letters, are made as
hashes only (the hash of a word is a sum over its places, so an edit changes one term or
shifts a suffix).  That finds each near pair from one side: an insertion is the other
word's deletion, a replacement by a smaller letter the other's by a larger one.  Only edits
that a filter holds become strings and meet the vocabulary in an exact join, which removes
the filter's false positives.

Forms point to a word at least ``ratio`` times as frequent, so a chain of forms has at most
log(largest n) links and the number of pointer-doubling rounds is known beforehand.

Defined results: a null text has no runs; the text of a null doc_id is empty in the hash
that picks the runs to shorten; rows that share a doc_id are separate texts; ties of n go
to the smallest word in code-point order; an empty table, or one without frequent words,
gives an empty result.  Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threatlens.llm.common import id_text, text_slices, texts
from threatlens.session import ensure_checkpoint_dir

PROBES = 6
BLOCK_BITS = 512
BITS_PER_WORD = 12
#: Words of this length and longer share a shard.
LONGEST = 64
#: Words of a shard; a task builds a shard's filter.
SHARD_WORDS = 500_000
#: Edits that a task holds at a time.
EDITS = 1 << 20
#: Words that a task counts before it hands them on.
COUNTED = 200_000
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_GOLD = np.uint64(0x9E3779B97F4A7C15)
#: Latin-1 codes: A-Z to a-z, a-z and U+00C0 to U+00FF as they are, the rest to blanks.
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def letter_runs(text: str) -> Counter:
    """Lower-cased runs (Latin-1 bytes, one for each code point) of a text and their counts."""
    return Counter(text.encode("latin-1", "replace").translate(_LETTERS).split())


def shortened(run: bytes, id_crc: int, every: int) -> bytes:
    """The run, without one code point if its hash with the document's id says so."""
    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), id_crc)
    if h % every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def _count_rows(min_length: int, every: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted: Counter = Counter()

        def rows() -> pa.RecordBatch:
            words = pa.array([w.decode("latin-1") for w in counted], pa.string())
            out = pa.RecordBatch.from_arrays([words, pa.array(list(counted.values()), pa.int64())], names=["word", "n"])
            counted.clear()
            return out

        for batch in text_slices(batches, "text"):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts(batch), strict=True):
                id_crc = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for word, n in letter_runs(text).items():
                    if len(word) >= min_length:
                        word = shortened(word, id_crc, every)
                        if len(word) >= min_length:
                            counted[word] += n
                if len(counted) >= COUNTED:
                    yield rows()
        if counted:
            yield rows()

    return run


def vocabulary(docs: DataFrame, min_length: int = 6, min_count: int = 5, every: int = 199) -> DataFrame:
    """word, n of the frequent words."""
    partial = id_text(docs).mapInArrow(_count_rows(min_length, every), "word string, n long")
    return partial.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


def _terms(place: np.ndarray, code: np.ndarray) -> np.ndarray:
    """The hash term of a code at a place."""
    return _mix(((place.astype(np.uint64) << np.uint64(8)) | code.astype(np.uint64)) * _GOLD + np.uint64(1))


def word_hashes(codes: np.ndarray) -> np.ndarray:
    """Of words of one length, as rows of Latin-1 codes."""
    return _terms(np.arange(codes.shape[1]), codes).sum(axis=1, dtype=np.uint64)


def _bits(hashes: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each hash, the first cell of its block and the number that its bits come from."""
    cell = ((hashes >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)) * np.uint64(BLOCK_BITS // 64)
    return cell, _mix(hashes + _GOLD)


def bloom_filter(hashes: np.ndarray) -> np.ndarray:
    blocks = max(1, -(-len(hashes) * BITS_PER_WORD // BLOCK_BITS))
    cells = np.zeros(blocks * (BLOCK_BITS // 64), dtype=np.uint64)
    first, bits = _bits(_mix(hashes), blocks)
    for k in range(PROBES):
        at = (bits >> np.uint64(9 * k)) & np.uint64(511)
        np.bitwise_or.at(cells, (first + (at >> np.uint64(6))).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
    return cells


def bloom_holds(cells: np.ndarray, mixed: np.ndarray) -> np.ndarray:
    """The places of the mixed hashes that the filter holds."""
    first, bits = _bits(mixed, len(cells) // (BLOCK_BITS // 64))
    left = np.arange(len(mixed))
    for k in range(PROBES):
        at = (bits >> np.uint64(9 * k)) & np.uint64(511)
        hit = (cells[(first + (at >> np.uint64(6))).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1
        left, first, bits = left[hit], first[hit], bits[hit]
    return left


def _codes(words: list[str]) -> np.ndarray:
    """Words of one length as rows of Latin-1 codes."""
    return np.frombuffer("".join(words).encode("latin-1"), dtype=np.uint8).reshape(len(words), -1)


def _build_filter(table: pa.Table) -> pa.Table:
    """One shard's filter, and the letters of its words."""
    by_length: dict[int, list[str]] = {}
    for w in table.column("word").to_pylist():
        by_length.setdefault(len(w), []).append(w)
    hashes, letters = [], np.zeros(256, dtype=bool)
    for words in by_length.values():
        for k in range(0, len(words), max(1, EDITS // len(words[0]))):
            codes = _codes(words[k : k + max(1, EDITS // len(words[0]))])
            hashes.append(word_hashes(codes))
            letters[np.unique(codes)] = True
    cells = bloom_filter(np.concatenate(hashes))
    return pa.table(
        {
            "shard": pa.array([table.column("shard")[0].as_py()], pa.int32()),
            "part": pa.array([table.column("part")[0].as_py()], pa.int32()),
            "cells": pa.array([cells.tobytes()], pa.binary()),
            "letters": pa.array([np.packbits(letters).tobytes()], pa.binary()),
        }
    )


def _found(hashes: np.ndarray, shard: int, parts: dict[int, int], filters: dict) -> np.ndarray:
    """The places of the hashes that the broadcast filters of the shard hold."""
    mixed = _mix(hashes)
    total = parts.get(shard, 0)
    out = []
    for part in range(total):
        if (shard, part) in filters:
            at = np.flatnonzero(mixed % np.uint64(total) == part) if total > 1 else np.arange(len(mixed))
            out.append(at[bloom_holds(filters[shard, part], mixed[at])])
    return np.concatenate(out) if out else np.zeros(0, dtype=np.int64)


def probe_edits(codes: np.ndarray, letters: np.ndarray, parts: dict[int, int], filters: dict) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rows, places and letters (-1: deletion) of the edits of words of one length that the
    filters hold.  Of equal letters in a row only the last is deleted."""
    n, length = codes.shape
    place = np.arange(length)
    term = _terms(place, codes)
    whole = term.sum(axis=1, dtype=np.uint64)
    shard, shorter = min(length, LONGEST), min(length - 1, LONGEST)
    if any(s == shorter for s, _ in filters):
        before = np.cumsum(term, axis=1, dtype=np.uint64) - term
        moved = _terms(np.maximum(place - 1, 0), codes)
        after = moved.sum(axis=1, dtype=np.uint64)[:, None] - np.cumsum(moved, axis=1, dtype=np.uint64)
        last = np.ones(codes.shape, dtype=bool)
        last[:, :-1] = codes[:, :-1] != codes[:, 1:]
        row, at = np.nonzero(last)
        hit = _found((before + after)[row, at], shorter, parts, filters)
        yield row[hit], at[hit], np.full(len(hit), -1)
    if any(s == shard for s, _ in filters):
        step = max(1, EDITS // max(1, n * len(letters)))
        for start in range(0, length, step):
            part = codes[:, start : start + step]
            row, at, new = np.nonzero(letters[None, None, :] > part[:, :, None])
            at = at + start
            hashes = whole[row] - term[row, at] + _terms(at, letters[new])
            hit = _found(hashes, shard, parts, filters)
            yield row[hit], at[hit], letters[new[hit]].astype(np.int64)


def _probe_rows(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, parts, packed = model.value
        letters = np.array(letters, dtype=np.uint8)
        filters = {k: np.frombuffer(x, dtype=np.uint64) for k, x in packed.items()}
        for batch in batches:
            by_length: dict[int, list[int]] = {}
            words, counts = batch.column("word").to_pylist(), batch.column("n").to_pylist()
            for i, w in enumerate(words):
                by_length.setdefault(len(w), []).append(i)
            for length, rows in by_length.items():
                size = max(1, EDITS // (length * max(1, len(letters))))
                for k in range(0, len(rows), size):
                    some = rows[k : k + size]
                    for row, at, new in probe_edits(_codes([words[i] for i in some]), letters, parts, filters):
                        word = [words[some[r]] for r in row.tolist()]
                        edits = [w[:a] + (chr(c) if c >= 0 else "") + w[a + 1 :] for w, a, c in zip(word, at.tolist(), new.tolist(), strict=True)]
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(word, pa.string()),
                                pa.array([counts[some[r]] for r in row.tolist()], pa.int64()),
                                pa.array(edits, pa.string()),
                            ],
                            names=["word", "n", "edit"],
                        )

    return run


def _part_rows(parts: dict[int, int]):
    """word, shard, part: the part by the same hash that the probes use."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column("word").to_pylist()
            part = np.zeros(len(words), dtype=np.int32)
            by_length: dict[int, list[int]] = {}
            for i, w in enumerate(words):
                if parts[min(len(w), LONGEST)] > 1:
                    by_length.setdefault(len(w), []).append(i)
            for length, rows in by_length.items():
                mixed = _mix(word_hashes(_codes([words[i] for i in rows])))
                part[rows] = (mixed % np.uint64(parts[min(length, LONGEST)])).astype(np.int32)
            shard = pa.array([min(len(w), LONGEST) for w in words], pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("word"), shard, pa.array(part)], names=["word", "shard", "part"])

    return run


def near_pairs(words: DataFrame, broadcast_bytes: int = 32 << 20, shard_words: int = SHARD_WORDS) -> DataFrame:
    """word, n, other, other_n: each near pair of the vocabulary (word, n) once.

    ``words`` is read once for the shard sizes, once for the filters and once a pass; it
    should be a checkpoint or a table."""
    spark = words.sparkSession
    sizes = words.groupBy(F.least(F.length("word"), F.lit(LONGEST)).alias("shard")).agg(F.count(F.lit(1)).alias("n")).collect()
    parts = {r["shard"]: -(-r["n"] // shard_words) for r in sizes}  # at most LONGEST rows
    filters = words.mapInArrow(_part_rows(parts), "word string, shard int, part int")
    filters = filters.groupBy("shard", "part").applyInArrow(_build_filter, "shard int, part int, cells binary, letters binary").checkpoint()
    seen = np.zeros(256, dtype=bool)
    bound = [(r["shard"], r["part"], r["size"], r["letters"]) for r in filters.select("shard", "part", F.octet_length("cells").alias("size"), "letters").collect()]
    passes: list[list[tuple[int, int]]] = []
    room = 0
    for shard, part, size, mask in sorted(bound):
        seen |= np.unpackbits(np.frombuffer(mask, dtype=np.uint8)).astype(bool)
        if not passes or size > room:
            passes.append([])
            room = broadcast_bytes
        passes[-1].append((shard, part))
        room -= size
    found = None
    for some in passes:
        keep = F.concat_ws(":", "shard", "part").isin([f"{s}:{p}" for s, p in some])
        cells = {(r["shard"], r["part"]): bytes(r["cells"]) for r in filters.filter(keep).select("shard", "part", "cells").collect()}
        model = spark.sparkContext.broadcast((np.flatnonzero(seen).tolist(), parts, cells))
        edits = words.mapInArrow(_probe_rows(model), "word string, n long, edit string")
        exact = edits.join(words.select(F.col("word").alias("edit"), F.col("n").alias("other_n")), "edit")
        exact = exact.select("word", "n", F.col("edit").alias("other"), "other_n")
        found = exact if found is None else found.unionByName(exact)
    return found if found is not None else words.select("word", "n", F.col("word").alias("other"), F.col("n").alias("other_n")).filter("false")


def _roots(forms: DataFrame, most: int, ratio: int, min_count: int) -> DataFrame:
    """word, root of the words with a form, by pointer doubling."""
    links, n = 1, min_count * ratio
    while n * ratio <= most:
        links, n = links + 1, n * ratio
    roots = forms.select("word", F.col("form").alias("root"))
    covered = 1
    while covered < links:
        step = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roots = roots.join(step, "root", "left").select("word", F.coalesce("next", "root").alias("root")).checkpoint()
        covered *= 2
    return roots


def spelling_variants(
    docs: DataFrame, min_length: int = 6, min_count: int = 5, ratio: int = 5, every: int = 199, broadcast_bytes: int = 32 << 20, shard_words: int = SHARD_WORDS
) -> DataFrame:
    """word, form, root, n, n_near, form_n for each word of the vocabulary."""
    ensure_checkpoint_dir(docs.sparkSession)
    words = vocabulary(docs, min_length, min_count, every).checkpoint()
    pairs = near_pairs(words, broadcast_bytes, shard_words)
    sides = F.array(
        F.struct("word", F.col("other").alias("other"), F.col("other_n").alias("other_n")),
        F.struct(F.col("other").alias("word"), F.col("word").alias("other"), F.col("n").alias("other_n")),
    )
    near = pairs.select(F.explode(sides).alias("p")).groupBy(F.col("p.word").alias("word"))
    near = near.agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("p.other_n")).alias("less"), F.col("p.other").alias("other"))).alias("best"))
    ruled = -F.col("best.less") >= ratio * F.col("n")
    formed = words.join(near, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(ruled, F.col("best.other")).alias("form"),
        F.when(ruled, -F.col("best.less")).alias("form_n"),
    ).checkpoint()
    most = formed.agg(F.max("n").alias("n")).first()["n"] or 0
    roots = _roots(formed.filter("form is not null"), most, ratio, min_count)
    return formed.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_groups(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """op11: runs of six letters or more, five occurrences, a form five times as frequent."""
    return spelling_variants(docs)


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: crc32 byte by byte with the table of its polynomial; near words meet on a word with one
#: place left out (a deletion) or masked (a replacement).
SQL = f"""
with recursive d as (
  select row_number() over () as u, coalesce(doc_id::varchar, '') as id, translate(text, '{_UPPER}', '{_LOWER}') as text
  from documents where text is not null
), r as (
  select u, run, id || ':' || run as hashed, count(*) as k
  from (select u, id, unnest(regexp_extract_all(text, '[a-z\u00C0-\u00FF]+')) as run from d) group by all having length(run) >= 6
), crc_table as (
  select list(c order by i) as t from (
    select i, list_reduce(list_prepend(i::bigint, range(8)),
      lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384::bigint) else c >> 1 end) as c
    from range(256) x(i)
  )
), h as (
  select run, k, xor(list_reduce(
    list_prepend(4294967295::bigint, list_transform(range(0, octet_length(encode(hashed)) * 2, 2),
      lambda i: ('0x' || substr(hex(encode(hashed)), i + 1, 2))::bigint)),
    lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295::bigint) as h
  from r, crc_table
), cut_runs as (
  select k, case when h % 199 = 0 then run[1:h % length(run)] || run[h % length(run) + 2:] else run end as word from h
), v as (
  select word, sum(k)::bigint as n from cut_runs where length(word) >= 6 group by word having sum(k) >= 5
), cut as (
  select word, n, unnest(range(1, length(word) + 1)) as i from v
), masked as (
  select word, n, word[1:i - 1] || chr(1) || word[i + 1:] as mask from cut
), pairs as (
  select x.word, y.word as other, y.n as other_n from masked x join masked y on x.mask = y.mask and x.word <> y.word
  union
  select c.word, v.word, v.n from cut c join v on v.word = c.word[1:i - 1] || c.word[i + 1:]
  union
  select v.word, c.word, c.n from cut c join v on v.word = c.word[1:i - 1] || c.word[i + 1:]
), best as (
  select word, count(*) as n_near, arg_min(other, (-other_n, encode(other))) as other, max(other_n) as other_n from pairs group by all
), formed as (
  select v.word, n, coalesce(n_near, 0) as n_near, case when other_n >= 5 * n then other end as form, case when other_n >= 5 * n then other_n end as form_n
  from v left join best using (word)
), chain as (
  select word, word as at from formed
  union all
  select chain.word, formed.form from chain join formed on formed.word = chain.at where formed.form is not null
), ends as (
  select chain.word, chain.at as root from chain join formed on formed.word = chain.at where formed.form is null
)
select word, form, root, n, n_near, form_n from formed join ends using (word)
"""
