"""Language identification by prediction by partial matching (PPM).

Each language has a variable-order byte context tree (orders 0 to 3).  A byte that a
context has seen costs ``-log2(c / (T + d))`` bits, with ``T`` the context's count and
``d`` its number of different followers; another byte costs the escape ``d / (T + d)``
and then its price in the next shorter context, with the followers already ruled out
excluded (PPM method C with exclusion).  Order -1 is uniform.  The statistics are frozen
after training, so the code length of a text under a language is a sum over its bytes,
and the language with the shortest code wins.

Bytes are folded first: ASCII capitals to small letters, digits to ``0``, white space to
a blank; bytes that training never met share one symbol.

Training reads a bounded sample of labelled documents (``docs_per_lang``), counted by
Spark.  Every language is learned, from its own ``grams_per_lang`` most frequent counts.
The trees are frozen and broadcast in blocks of ``langs_per_block`` languages of at most
``max_table_bytes`` each, over one common alphabet, so code lengths compare across blocks;
a worker holds all blocks, so its memory grows with the number of languages.

Defined results: a null text, an empty text and one without any letter are ``und`` with
score 0, and so is every text if there is nothing to learn from; equal code lengths take
the first language by name; rows are scored one by one, so repeated rows and ids give
repeated results; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from threatlens.llm.common import fold, id_text, text_slices, texts

UND = "und"
ORDER = 3

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[49:58] = 48
_FOLD[9:14] = 32


@dataclass(frozen=True)
class TrainRules:
    #: expected number of training documents per language; a language with fewer gives all
    docs_per_lang: int = 2000
    #: different (context, byte) pairs kept of each language, its most frequent ones
    grams_per_lang: int = 150_000
    #: languages of one frozen table
    langs_per_block: int = 4
    #: symbols of the folded byte alphabet, the most frequent ones; the rest share one
    max_symbols: int = 110
    #: a context of order 3 is kept from so many occurrences on
    min_context: int = 6
    #: bound of a block's frozen table
    max_table_bytes: int = 48 << 20


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, code, n): four folded bytes as one number, counted per slice."""
    for batch in text_slices(batches, "text"):
        by_lang: dict[str, list[bytes]] = {}
        for lang, text in zip(batch.column("lang").to_pylist(), texts(batch), strict=True):
            by_lang.setdefault(lang, []).append(b"   " + text.encode())
        for lang, parts in by_lang.items():
            raw = np.frombuffer(b"".join(parts), dtype=np.uint8)
            b = _FOLD[raw].astype(np.uint32)
            codes = (b[:-3] << 24) | (b[1:-2] << 16) | (b[2:-1] << 8) | b[3:]
            value, n = np.unique(codes, return_counts=True)
            yield pa.RecordBatch.from_pydict(
                {"lang": pa.array([lang] * len(value)), "code": value.astype(np.int64), "n": n.astype(np.int64)}
            )


def train(docs: DataFrame, rules: TrainRules = TrainRules()) -> list[SimpleNamespace] | None:
    """Learn from the documents with a language outside fold 2 of 4: the trees of each block
    of languages, in the order of the names."""
    known = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & (fold("doc_id", 4) != 2)
    )
    sizes = known.groupBy("lang").agg(F.count(F.lit(1)).alias("size")).collect()
    if not sizes:
        return None
    share = docs.sparkSession.createDataFrame([(r["lang"], rules.docs_per_lang / r["size"]) for r in sizes], "lang string, share double")
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / F.lit(1 << 30)
    sample = known.join(F.broadcast(share), "lang").filter(draw < F.col("share"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "code"))
    counts = (
        sample.select("lang", "text")
        .mapInArrow(_grams, "lang string, code long, n long")
        .groupBy("lang", "code")
        .agg(F.sum("n").alias("n"))
        .withColumn("place", place)
        .filter(F.col("place") <= rules.grams_per_lang)
        .drop("place")
    )
    langs = sorted(r["lang"] for r in sizes)
    if len(langs) <= rules.langs_per_block:
        found = counts.toArrow().to_pandas()
        return [freeze(found, rules)] if len(found) else None
    counts = counts.persist()
    try:
        # every language has the same weight in the common alphabet
        by_byte = counts.groupBy("lang", F.col("code").bitwiseAND(F.lit(255)).alias("byte")).agg(F.sum("n").alias("n")).toArrow().to_pandas()
        weight = by_byte["n"] / by_byte.groupby("lang")["n"].transform("sum")
        common = np.bincount(by_byte["byte"].to_numpy(dtype=np.int64), weights=weight.to_numpy(dtype=np.float64), minlength=256)
        out = []
        for k in range(0, len(langs), rules.langs_per_block):
            found = counts.filter(F.col("lang").isin(langs[k : k + rules.langs_per_block])).toArrow().to_pandas()
            if len(found):
                out.append(freeze(found, rules, common))
    finally:
        counts.unpersist()
    return out or None


def freeze(counts: pd.DataFrame, rules: TrainRules, by_byte: np.ndarray | None = None) -> SimpleNamespace:
    """The frozen trees of a block of languages, over the alphabet of the weights ``by_byte``
    (those of the counts if there is but one block): ``symbols`` folds a byte, ``nodes`` gives the
    longest known context that ends three symbols, ``bits[node, symbol, language]`` the
    code length."""
    langs = sorted(counts["lang"].unique())
    lang = counts["lang"].map({x: i for i, x in enumerate(langs)}).to_numpy()
    code, n = counts["code"].to_numpy(), counts["n"].to_numpy().astype(np.float64)
    by_byte = np.bincount(code & 255, weights=n, minlength=256) if by_byte is None else by_byte.copy()
    by_byte[32] += 1  # the start of a text is a blank
    frequent = np.argsort(-by_byte, kind="stable")[: rules.max_symbols]
    frequent = np.sort(frequent[by_byte[frequent] > 0])
    symbols = np.zeros(256, dtype=np.int64)  # 0: any other byte
    symbols[frequent] = np.arange(1, len(frequent) + 1)
    symbols = symbols[_FOLD]
    a, k = len(frequent) + 1, len(langs)
    raw = [symbols[(code >> s) & 255] for s in (24, 16, 8, 0)]
    ctx = {0: np.zeros_like(raw[0]), 1: raw[2], 2: raw[1] * a + raw[2], 3: (raw[0] * a + raw[1]) * a + raw[2]}
    low = np.full((1, a, k), 1.0 / a)  # order -1
    parent_of = np.zeros(1, dtype=np.int64)
    tables, index = [], np.zeros(1, dtype=np.int64)  # index: context of the last order -> row of all tables
    first = 0
    for order in range(ORDER + 1):
        total = np.bincount(ctx[order], weights=n, minlength=a**order)
        keep = np.flatnonzero(total >= (1 if order < ORDER else rules.min_context))
        room = rules.max_table_bytes // (a * k * 4) - first
        if len(keep) > room:
            keep = np.sort(keep[np.argsort(-total[keep], kind="stable")[: max(room, 0)]])
        row = np.full(a**order, -1, dtype=np.int64)
        row[keep] = np.arange(len(keep))
        c = np.zeros((len(keep), a, k))
        at = row[ctx[order]]
        np.add.at(c, (at[at >= 0], raw[3][at >= 0], lang[at >= 0]), n[at >= 0])
        seen = c > 0
        t, d = c.sum(axis=1, keepdims=True), seen.sum(axis=1, keepdims=True)
        if order:
            # a context's suffix drops its first symbol
            parent_of = index[keep % (a ** (order - 1))] if order > 1 else np.zeros(len(keep), dtype=np.int64)
            low = np.concatenate(tables)[parent_of]
        else:
            low = np.broadcast_to(low, c.shape)
        left = 1.0 - np.where(seen, low, 0.0).sum(axis=1, keepdims=True)
        escape = np.divide(d, t + d, out=np.ones_like(t), where=t > 0)
        fresh = escape * low / np.maximum(left, 1e-12)
        p = np.where(seen, c / np.maximum(t + d, 1e-300), fresh)
        tables.append(p)
        full = np.where(row >= 0, first + row, 0)
        if order:
            shorter = np.arange(a**order) % (a ** (order - 1))
            full = np.where(row >= 0, first + row, index[shorter])
        index = full
        first += len(keep)
    bits = -np.log2(np.maximum(np.concatenate(tables), 1e-12)).astype(np.float32)
    return SimpleNamespace(langs=langs, symbols=symbols, size=a, nodes=index.astype(np.int32), bits=bits)


def code_lengths(docs: list[str], trees: SimpleNamespace) -> np.ndarray:
    """Bits of each text under each language."""
    parts = [b"   " + t.encode() for t in docs]
    out = np.zeros((len(docs), len(trees.langs)))
    a = trees.size
    for i, part in enumerate(parts):
        for start in range(0, max(len(part) - 3, 0), 1 << 19):
            s = trees.symbols[np.frombuffer(part[start : start + (1 << 19) + 3], dtype=np.uint8)]
            node = trees.nodes[(s[:-3] * a + s[1:-2]) * a + s[2:-1]]
            out[i] += trees.bits[node, s[3:]].sum(axis=0, dtype=np.float64)
    return out


def predict_texts(docs: list[str], trees: list[SimpleNamespace] | None) -> tuple[list[str], list[float]]:
    """Language and confidence: the softmax of the code lengths, over the root of the
    number of bytes so that long texts don't all reach 1."""
    pred, score = [UND] * len(docs), [0.0] * len(docs)
    if trees is None:
        return pred, score
    lettered = [i for i, t in enumerate(docs) if any(map(str.isalpha, t))]
    langs = [x for block in trees for x in block.langs]
    bits = np.concatenate([code_lengths([docs[i] for i in lettered], block) for block in trees], axis=1)
    for i, row in zip(lettered, bits, strict=True):
        best = int(row.argmin())
        scale = np.sqrt(len(docs[i]))
        pred[i], score[i] = langs[best], float(1.0 / np.exp2((row[best] - row) / scale).sum())
    return pred, score


def _broadcast(docs: DataFrame, trees: list[SimpleNamespace] | None) -> list[Broadcast] | None:
    return trees and [docs.sparkSession.sparkContext.broadcast(block) for block in trees]


def predict(docs: DataFrame, trees: list[SimpleNamespace] | None) -> DataFrame:
    """doc_id, lang_pred, score for each row."""
    model = _broadcast(docs, trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            pred, score = predict_texts(texts(batch), model and [b.value for b in model])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(pred, pa.string()), pa.array(score, pa.float64())],
                names=["doc_id", "lang_pred", "score"],
            )

    return id_text(docs).mapInArrow(run, "doc_id long, lang_pred string, score double")


def reject_unknown(docs: DataFrame, trees: list[SimpleNamespace] | None) -> DataFrame:
    """The rows, all columns kept, whose text has a language."""
    model = _broadcast(docs, trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            pred, _ = predict_texts(texts(batch), model and [b.value for b in model])
            yield batch.filter(pa.array([p != UND for p in pred]))

    return docs.mapInArrow(run, docs.schema)


def language_id(spark: SparkSession, docs: DataFrame, rules: TrainRules = TrainRules()) -> DataFrame:
    """op6: doc_id, held_out, lang_pred, score."""
    out = predict(docs, train(docs, rules))
    held_out = F.coalesce(fold("doc_id", 4) == 2, F.lit(False))
    return out.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return reject_unknown(docs, train(docs))
