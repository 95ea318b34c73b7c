"""Language model scoring by cross-entropy difference.

Two bigram models over words share one vocabulary, the words of all documents: the target
model counts the documents labelled as good (quality 1 and not toxic), the background
model counts all documents.  Both are smoothed alike: p(w | h) = (c(h w) + ALPHA) /
(c(h) + ALPHA V), with V the number of words in the vocabulary and a start symbol before
the first word.  A document's own words are taken out of both models' counts before it is
scored, so no document is scored on itself.  Its score is the mean loss per word under
the target model less that under the background model: lower is closer to the target.

The documents are dealt to batches.  A batch sends each shard of the n-gram hashes its
different n-grams, with how often all its documents and its good ones have them; the shard
sends back what the other batches have of them.  The batch then
scores its documents.  What is sent is a few bytes for each different n-gram of a batch,
however many documents or shards there are.  Nothing is capped: the model is as large as
the corpus' n-grams, spread over shards whose number follows the input.

N-grams are compared by hashes of 44 bits or more, 13 more than the number of bytes has.
V is the number of different word hashes (64 bits) of the corpus, by a distributed distinct.

Defined results: null and empty texts have n_tokens 0 and losses 0; rows equal in id and
text are one document whose n_tokens is their sum; an id without a label is background
only, and of several labels of an id the best counts; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threatlens.llm.common import input_bytes, partitions_for, table, text_slices, texts
from threatlens.llm.neardup import _GOLD, _mix
from threatlens.llm.suffixdedup import _pack, _rows_by_shard, _shard_of, _unpack

ALPHA = 0.1
#: Different word hashes that a task gathers before it sends them.
SKETCH = 1 << 16
#: Text of a batch.
SLICE = 8 << 20
#: Text whose n-grams one shard holds.
SHARD_BYTES = 14 << 20
#: Labelled ids that are broadcast; more of them are joined by a shuffle of the texts.
BROADCAST_IDS = 1_000_000
_START = np.uint64(0x51A27)
MESSAGE = "to long, sender long, keys binary, own binary, liked binary"
_FIELDS = pa.schema([("to", pa.int64()), ("sender", pa.int64())] + [(n, pa.binary()) for n in ("keys", "own", "liked")])
SUMS = "doc_id long, uid long, n long, target double, background double"


def _small(x: np.ndarray) -> bytes:
    """Whole numbers with a byte each; those of 255 and more follow in full."""
    low = np.minimum(x, 255).astype(np.uint8)
    return np.int64(len(x)).tobytes() + low.tobytes() + x[x >= 255].astype(np.int64).tobytes()


def _large(data: bytes) -> np.ndarray:
    n = int(np.frombuffer(data, dtype=np.int64, count=1)[0])
    x = np.frombuffer(data, dtype=np.uint8, offset=8, count=n).astype(np.int64)
    x[x == 255] = np.frombuffer(data[8 + n :], dtype=np.int64)
    return x


def word_hashes(rows: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words (runs without white space, small letters), and each row's number
    of words."""
    words = [t.lower().split() for t in rows]
    flat = [w for ws in words for w in ws]
    hashes = pd.util.hash_array(np.array(flat, dtype=object), categorize=False) if flat else np.zeros(0, dtype=np.uint64)
    return hashes, np.array([len(ws) for ws in words], dtype=np.int64)


def ngrams(hashes: np.ndarray, sizes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of each position's history and bigram: the lowest bit tells them apart."""
    top = np.uint64(64 - bits)
    first = np.zeros(len(hashes), dtype=bool)
    first[(np.cumsum(sizes) - sizes)[sizes > 0]] = True
    history = np.where(first, _START, np.roll(hashes, 1))
    one = _mix(history * _GOLD + np.uint64(1)) >> top
    two = _mix(_mix(history) * _GOLD + hashes) >> top
    return one & ~np.uint64(1), two | np.uint64(1)


class Batch:
    """The different n-grams of a batch's documents, as entries in order of n-gram."""

    def __init__(self, docs: pa.Table, bits: int):
        hashes, sizes = word_hashes(texts(docs))
        self.good = docs.column("good").to_numpy(zero_copy_only=False).astype(bool)
        doc = np.repeat(np.arange(len(sizes)), sizes)
        keys, docs_of = np.concatenate(ngrams(hashes, sizes, bits)), np.concatenate([doc, doc])
        order = np.argsort(keys, kind="stable")  # documents stay in order within a key
        keys, docs_of = keys[order], docs_of[order]
        heads = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]) | (docs_of[1:] != docs_of[:-1])])) if len(keys) else order
        #: of each entry: its document, how often it has the n-gram, and the n-gram's place
        self.doc, self.own = docs_of[heads], np.diff(np.append(heads, len(keys)))
        keys = keys[heads]
        new = np.concatenate([[True], keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, dtype=bool)
        self.place = np.cumsum(new) - 1
        self.keys = keys[new]
        self.liked = self.own * self.good[self.doc]

    def sums(self, mine: np.ndarray) -> np.ndarray:
        return np.bincount(self.place, weights=mine, minlength=len(self.keys)).astype(np.int64)


def _ask(shards: int, bits: int):
    def run(key, docs):
        batch = Batch(docs, bits)
        own, liked = batch.sums(batch.own), batch.sums(batch.liked)
        rows = []
        for s, part in _rows_by_shard(_shard_of(batch.keys, bits, shards)):
            sent = {"keys": _pack(batch.keys[part]), "own": _small(own[part]), "liked": _small(liked[part])}
            rows.append({"to": s, "sender": key[0].as_py(), **sent})
        return pa.Table.from_pylist(rows, schema=_FIELDS)

    return run


def _answer(key, mail):
    """What the other batches have of the n-grams that a batch asked for, in its order: mostly nothing."""
    keys = [_unpack(x) for x in mail.column("keys").to_pylist()]
    value, place = np.unique(np.concatenate(keys), return_inverse=True)
    rows = [{"to": sender, "sender": key[0].as_py()} for sender in mail.column("sender").to_pylist()]
    for c in ("own", "liked"):
        mine = [_large(x) for x in mail.column(c).to_pylist()]
        total = np.bincount(place, weights=np.concatenate(mine), minlength=len(value)).astype(np.int64)
        at = 0
        for row, x in zip(rows, mine, strict=True):
            row[c] = _small(total[place[at : at + len(x)]] - x)
            at += len(x)
    return pa.Table.from_pylist(rows, schema=_FIELDS)


def _losses(vocabulary: float, bits: int):
    def run(key, docs, mail):
        batch = Batch(docs, bits)
        n = docs.num_rows
        sums = np.zeros((3, n))
        if len(batch.keys):
            history = (batch.keys[batch.place] & np.uint64(1)) == 0
            prior = np.where(history, ALPHA * vocabulary, ALPHA)
            sign = np.where(history, batch.own, -batch.own)  # the loss is log(history) - log(bigram)
            sums[0] = np.bincount(batch.doc, weights=batch.own * history, minlength=n)
            # shards are ranges of keys, so their answers in order are those of the keys in order
            order = np.argsort(mail.column("sender").to_numpy())
            for row, c, mine in ((1, "liked", batch.liked), (2, "own", batch.own)):
                answers = mail.column(c).to_pylist()
                others = np.concatenate([_large(answers[i]) for i in order.tolist()])
                total = (others + batch.sums(mine))[batch.place]
                sums[row] = np.bincount(batch.doc, weights=sign * np.log(np.maximum(total - mine, 0) + prior), minlength=n)
        words = sums[0] > 0
        ids = [docs.column(c).to_numpy()[words] for c in ("key_id", "uid")]
        columns = [*ids, sums[0][words].astype(np.int64), sums[1][words], sums[2][words]]
        return pa.Table.from_arrays([pa.array(x) for x in columns], names=["doc_id", "uid", "n", "target", "background"])

    return run


def _different(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = np.zeros(0, dtype=np.uint64)
    for batch in text_slices(batches, "text", SLICE):
        held = np.union1d(held, word_hashes(texts(batch))[0])
        if len(held) >= SKETCH:
            yield pa.RecordBatch.from_arrays([pa.array(held.view(np.int64))], names=["h"])
            held = held[:0]
    yield pa.RecordBatch.from_arrays([pa.array(held.view(np.int64))], names=["h"])


def vocabulary_size(docs: DataFrame) -> float:
    """Number of different words."""
    return float(docs.select("text").mapInArrow(_different, "h long").distinct().count())


def cross_entropy_difference(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """op7: doc_id, n_tokens, target_loss, background_loss, score for each document."""
    spark = docs.sparkSession
    # a null id has no label and is told apart by a key of its own
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    best = labels.select(F.col("doc_id").cast("long").alias("doc_id"), ((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)).alias("good"))
    best = best.filter("good").select("doc_id", "good").distinct()
    if best.count() <= BROADCAST_IDS:
        best = F.broadcast(best)
    null_id = -(1 << 63)
    total = input_bytes(rows)
    shards = max(1, -(-total // SHARD_BYTES))
    bits = min(60, max(44, total.bit_length() + 13))
    vocabulary = vocabulary_size(rows)
    marked = rows.join(best, "doc_id", "left").select(
        F.coalesce("doc_id", F.lit(null_id)).alias("key_id"), F.xxhash64("text").alias("uid"), F.coalesce("good", F.lit(False)).alias("good"), "text"
    )
    batch = F.pmod(F.xxhash64("key_id", "uid"), F.lit(partitions_for(spark, total, SLICE))).alias("batch")
    dealt = marked.select(batch, "key_id", "uid", "good", "text").groupBy("batch")
    answered = dealt.applyInArrow(_ask(shards, bits), MESSAGE).groupBy("to").applyInArrow(_answer, MESSAGE)
    sums = dealt.cogroup(answered.groupBy("to")).applyInArrow(_losses(vocabulary, bits), SUMS)
    scored = sums.groupBy("doc_id", "uid").agg(*[F.sum(c).alias(c) for c in ("n", "target", "background")])
    # Python's white space: Java's and U+001C to U+001F
    empty = rows.filter(~F.col("text").rlike(r"(?U)[^\s\x1c-\x1f]")).distinct()
    n = F.col("n")
    return scored.select(
        F.when(F.col("doc_id") != null_id, F.col("doc_id")).alias("doc_id"),
        n.alias("n_tokens"),
        (F.col("target") / n).alias("target_loss"),
        (F.col("background") / n).alias("background_loss"),
        ((F.col("target") - F.col("background")) / n).alias("score"),
    ).union(empty.select("doc_id", F.lit(0).cast("long"), *[F.lit(0.0)] * 3))


def lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_entropy_difference(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
