"""Benchmark decontamination by greedy string tiling.

Texts and benchmark items become words (runs of letters and digits, small letters; each
character of a script without blanks between words is a word).  The
words of the benchmark get ids.  A document is a candidate for an item if they share a
seed of ``min_match`` words in a row; seeds are found by a rolling hash over the word
ids.  For each candidate pair the longest match of words not yet marked is sought by
running Karp-Rabin matching (seed hashes, then comparison word by word), marked, and the
search repeated until none of ``min_match`` words is left.  The marked share of the
item's words is its coverage; tiles may stand in any order, so a reordered passage is
found too.  Coverage of ``threshold`` or more is contamination.  An item of fewer than
``min_match`` words is found by all its words in a row.

The benchmark is taken in blocks whose text is at most ``block_bytes`` each; a block is
broadcast and held against all documents, so nothing grows with the benchmark but the
number of passes.

Defined results: null or empty texts match nothing; an item without words matches nothing,
and one of a single word each document with that word; repeated items of one id are told
apart by their text and give a row each if both match; repeated documents give repeated
rows; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threatlens.llm.common import id_text, table, text_slices, texts

#: Thai, Lao, Tibetan, Myanmar, Khmer, kana and Han: no blanks between words.
_UNSPACED = (
    "\u0e01-\u0e3a\u0e40-\u0e4e\u0e81-\u0ece\u0f40-\u0fbc\u1000-\u103f\u1050-\u109f\u1780-\u17d3\u3005-\u3007"
    "\u3041-\u3096\u309d-\u309f\u30a1-\u30fa\u30fc-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9d"
    "\U00020000-\U0003ffff"
)
WORD = re.compile(r"[^\W_]+")
WORD_OR_CHARACTER = re.compile(rf"[{_UNSPACED}]|[^\W_{_UNSPACED}]+")
_BASE = np.uint64(0x9E3779B97F4A7C15)
PAIRS = "doc_id long, item_id long, n_item_words int, n_covered int, n_tiles int, coverage double"


@dataclass(frozen=True)
class TilingRules:
    min_match: int = 5
    threshold: float = 0.5
    block_bytes: int = 8 << 20


def words(text: str) -> list[str]:
    return (WORD if text.isascii() else WORD_OR_CHARACTER).findall(text.lower())


def _rolling(ids: np.ndarray, k: int) -> np.ndarray:
    """Hash of each window of k ids, modulo 2**64."""
    n = len(ids) - k + 1
    h = np.zeros(max(n, 0), dtype=np.uint64)
    if n > 0:
        x = ids.astype(np.uint64)
        for i in range(k):
            h = h * _BASE + x[i : i + n]
    return h


def build_block(items: list[tuple[int, str]], rules: TilingRules) -> SimpleNamespace:
    """Word ids, for each seed hash the items, sorted by hash, and by length the items that
    are shorter than a seed."""
    vocab: dict[str, int] = {}
    item_ids, item_words = [], []
    for item_id, text in items:
        w = np.array([vocab.setdefault(x, len(vocab) + 1) for x in words(text or "")], dtype=np.int64)
        if len(w):
            item_ids.append(item_id)
            item_words.append(w)
    hashes = [_rolling(w, rules.min_match) for w in item_words]
    flat = np.concatenate(hashes) if hashes else np.zeros(0, dtype=np.uint64)
    of_item = np.repeat(np.arange(len(hashes)), [len(h) for h in hashes]).astype(np.int64)
    order = np.argsort(flat, kind="stable")
    short: dict[int, dict[tuple[int, ...], list[int]]] = {}
    for i, w in enumerate(item_words):
        if len(w) < rules.min_match:
            short.setdefault(len(w), {}).setdefault(tuple(w.tolist()), []).append(i)
    whole = {k: (np.unique([_rolling(np.array(w), k)[0] for w in found]), found) for k, found in short.items()}
    return SimpleNamespace(vocab=vocab, item_ids=item_ids, item_words=item_words, seeds=flat[order], of_item=of_item[order], short=whole)


def short_items(ids: np.ndarray, block: SimpleNamespace) -> list[tuple[int, int, int, int]]:
    """The items shorter than a seed whose words stand in a row in the text."""
    out = []
    for k, (hashes, found) in block.short.items():
        windows = np.flatnonzero(np.isin(_rolling(ids, k), hashes))
        if len(windows):
            hits = np.unique(ids[windows[:, None] + np.arange(k)], axis=0)
            out += [(item, k, k, 1) for w in hits.tolist() for item in found.get(tuple(w), ())]
    return out


def greedy_tiles(item: np.ndarray, doc: np.ndarray, starts: np.ndarray, min_match: int) -> list[tuple[int, int, int]]:
    """Tiles (item position, document position, length): the longest match of unmarked
    words first; equal lengths by document, then item position.  ``starts`` are the
    document positions whose seed stands in the item."""
    item_hash = _rolling(item, min_match)
    at_hash: dict[int, list[int]] = {}
    for i, h in enumerate(item_hash.tolist()):
        at_hash.setdefault(h, []).append(i)
    doc_hash = _rolling(doc, min_match)
    item_used, doc_used = np.zeros(len(item), dtype=bool), np.zeros(len(doc), dtype=bool)
    tiles: list[tuple[int, int, int]] = []
    a, b = item.tolist(), doc.tolist()
    live = [(int(s), at_hash.get(int(doc_hash[s]), ())) for s in starts]
    while live and not item_used.all():
        best: list[tuple[int, int, int]] = []
        longest = min_match
        still = []
        for s, places in live:
            if doc_used[s]:
                continue
            open_places = [i for i in places if not item_used[i]]
            if not open_places:
                continue
            still.append((s, open_places))
            for i in open_places:
                # skip if the match can begin earlier: that start is tried as well
                if s and i and a[i - 1] == b[s - 1] and not item_used[i - 1] and not doc_used[s - 1]:
                    continue
                k = 0
                while i + k < len(a) and s + k < len(b) and a[i + k] == b[s + k] and not item_used[i + k] and not doc_used[s + k]:
                    k += 1
                if k > longest:
                    longest, best = k, []
                if k == longest:
                    best.append((i, s, k))
        live = still
        if not best:
            break
        for i, s, k in best:
            if not item_used[i : i + k].any() and not doc_used[s : s + k].any():
                item_used[i : i + k] = True
                doc_used[s : s + k] = True
                tiles.append((i, s, k))
    return tiles


def tile_text(text: str, block: SimpleNamespace, rules: TilingRules) -> list[tuple[int, int, int, int]]:
    """(item index, words, covered words, tiles) of the items the text contaminates."""
    get = block.vocab.get
    ids = np.array([get(w, 0) for w in words(text)], dtype=np.int64)
    out = short_items(ids, block)
    if len(ids) < rules.min_match or not len(block.seeds):
        return sorted(out)
    h = _rolling(ids, rules.min_match)
    unknown = np.concatenate([[0], np.cumsum(ids == 0)])
    starts = np.flatnonzero(unknown[rules.min_match :] == unknown[: -rules.min_match])
    left = np.searchsorted(block.seeds, h[starts], side="left")
    right = np.searchsorted(block.seeds, h[starts], side="right")
    hit = right > left
    starts, left, right = starts[hit], left[hit], right[hit]
    by_item: dict[int, list[int]] = {}
    for s, lo, hi in zip(starts.tolist(), left.tolist(), right.tolist(), strict=True):
        for item in np.unique(block.of_item[lo:hi]).tolist():
            by_item.setdefault(item, []).append(s)
    for item, at in by_item.items():
        w = block.item_words[item]
        # an upper bound of the coverage by seeds alone spares most tilings
        if len(at) + rules.min_match - 1 < rules.threshold * len(w) and len(at) * rules.min_match < rules.threshold * len(w):
            continue
        tiles = greedy_tiles(w, ids, np.array(at), rules.min_match)
        covered = sum(k for _, _, k in tiles)
        if covered >= rules.threshold * len(w):
            out.append((item, len(w), covered, len(tiles)))
    return sorted(out)


def blocks(benchmark: DataFrame, rules: TilingRules) -> Iterator[SimpleNamespace]:
    """The benchmark's blocks, each collected alone and of bounded size."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).filter("text is not null")
    total = items.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    n = max(1, -(-2 * total // rules.block_bytes))
    for k in range(n if total else 0):
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k) if n > 1 else items
        yield build_block([(r["item_id"], r["text"]) for r in part.orderBy("item_id", "text").collect()], rules)


def contaminated(docs: DataFrame, benchmark: DataFrame, rules: TilingRules = TilingRules()) -> DataFrame:
    """One row for each document and item that it covers to ``threshold`` or more."""
    spark, source, out = docs.sparkSession, id_text(docs), None
    for block in blocks(benchmark, rules):
        model = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], model=model) -> Iterator[pa.RecordBatch]:
            block = model.value
            for batch in text_slices(batches, "text"):
                rows = [
                    (doc_id, block.item_ids[item], n, covered, tiles, covered / n)
                    for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts(batch), strict=True)
                    for item, n, covered, tiles in tile_text(text, block, rules)
                ]
                cols = list(zip(*rows, strict=True)) if rows else [()] * 6
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.float64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(cols, kinds, strict=True)],
                    names=["doc_id", "item_id", "n_item_words", "n_covered", "n_tiles", "coverage"],
                )

        part = source.mapInArrow(run, PAIRS)
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], PAIRS) if out is None else out


def clean_documents(docs: DataFrame, benchmark: DataFrame, rules: TilingRules = TilingRules()) -> DataFrame:
    """The rows, all columns kept, that cover no item."""
    spark, out = docs.sparkSession, docs
    for block in blocks(benchmark, rules):
        model = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], model=model) -> Iterator[pa.RecordBatch]:
            for batch in text_slices(batches, "text"):
                yield batch.filter(pa.array([not tile_text(t, model.value, rules) for t in texts(batch)], pa.bool_()))

        out = out.mapInArrow(run, docs.schema)
    return out


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return clean_documents(docs, table(spark, sf_dir, "benchmark"))
