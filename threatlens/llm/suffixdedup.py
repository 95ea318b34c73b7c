"""Repeated byte strings by a hash-compared suffix sort.

Every byte covered by a string of ``LENGTH`` bytes that also starts in a document with a
smaller doc_id is removed.

Only suffixes that can match are sorted.  A string's anchor is the ``GRAM``-byte gram in
it with the smallest hash (the leftmost of equals), so equal strings have equal anchors
at equal places.  Neighbouring strings mostly share their anchor: a run is a maximal row
of string starts with one anchor, about one for 18 bytes.

1.  Copies of a text are one text, that of the smallest doc_id; the others go whole.  The
    texts are dealt to batches by doc_id.
2.  Each batch sends its different anchor hashes to shards by hash; a shard answers which
    of them other batches have too.
3.  Each batch sends the bytes of the runs whose anchor is shared to the anchor's shard,
    each different run once, with its smallest doc_id: a line that a third of all
    documents have is one run a batch.
4.  A shard sorts the suffixes at the string starts of its runs, in buckets of equal
    anchor and place, each different string once; strings whose hash no other document has
    are left out.  It is a mergesort; two suffixes are compared by prefix polynomial
    hashes, their common extension found by binary search over its length.  Neighbours
    that agree over ``LENGTH`` bytes are verified byte by byte; strings with a smaller
    doc_id in their class are reported back to the batch.
5.  Each batch joins the reports to intervals and cuts them out.

Batches and shards hold a bounded share of the bytes, and their number follows the input.
The texts are shuffled once; steps 2, 3 and 5 read the same exchange.

Defined results: null is the empty text; texts shorter than ``LENGTH`` bytes lose
nothing; a null doc_id is not smaller than any, and its row stays as it is; of rows that
share a doc_id none is smaller than another; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threatlens.llm.common import id_text, input_bytes, partitions_for
from threatlens.llm.neardup import _GOLD, _mix

LENGTH = 50
GRAM = 16
GRAMS = LENGTH - GRAM + 1
BATCH_BYTES = 4 << 20
SHARD_BYTES = 2 << 20
_PIECE = 1 << 19  # string starts of a piece of a long text
_POSITION = np.uint64((1 << 20) - 1)
_BASE = 0xD6E8FEB86659FD93
_INVERSE = pow(_BASE, -1, 1 << 64)
MESSAGE = "to long, sender long, kind int, doc_id long, ids binary, keys binary, sizes binary, data binary"
_FIELDS = pa.schema(
    [("to", pa.int64()), ("sender", pa.int64()), ("kind", pa.int32()), ("doc_id", pa.int64())]
    + [(n, pa.binary()) for n in ("ids", "keys", "sizes", "data")]
)
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
KEEPER, SHARED, COVERED = 0, 1, 2


def _bytes_table() -> np.ndarray:
    return _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class PrefixHashes:
    """Polynomial hashes, modulo 2**64, of any substring of some bytes in constant time."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.data = data
        self.inverse = _powers(_INVERSE, n + 1)
        self.prefix = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_bytes_table()[data] * _powers(_BASE, n + 1)[:n], out=self.prefix[1:])

    def of(self, start: np.ndarray, length) -> np.ndarray:
        return (self.prefix[start + length] - self.prefix[start]) * self.inverse[start]


def compare(h: PrefixHashes, a: np.ndarray, b: np.ndarray, whole: np.ndarray, at: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """-1, 0 or 1 for the suffixes at a and b, over ``LENGTH`` bytes.  ``whole`` are the
    hashes of the whole strings, ``at`` the places of a and b in it."""
    out = np.zeros(len(a), dtype=np.int8)
    differ = np.flatnonzero(whole[at[0]] != whole[at[1]])
    if len(differ):
        x, y = a[differ], b[differ]
        low, high = np.zeros(len(differ), dtype=np.int64), np.full(len(differ), LENGTH - 1, dtype=np.int64)
        while (low < high).any():  # the longest common extension
            middle = (low + high + 1) // 2
            same = h.of(x, middle) == h.of(y, middle)
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        out[differ] = np.sign(h.data[x + low].astype(np.int16) - h.data[y + low].astype(np.int16))
    return out


def _alike(h: PrefixHashes, start: np.ndarray, bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The entries in order of bucket and string hash, and where a new string begins in it."""
    whole = h.of(start, LENGTH)
    order = np.lexsort((whole, bucket))
    b, w = bucket[order], whole[order]
    return order, np.concatenate([[True], (b[1:] != b[:-1]) | (w[1:] != w[:-1])]) if len(order) else np.zeros(0, dtype=bool)


def suffix_mergesort(h: PrefixHashes, start: np.ndarray, bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes by bucket, in a bucket by their first ``LENGTH`` bytes; and
    for each place in the order whether it has the same bytes as the one before.

    Strings of one hash are sorted as one, so the work follows the different strings and
    not how often they come."""
    grouped, new = _alike(h, start, bucket)
    heads = np.flatnonzero(new)
    sizes = np.diff(np.append(heads, len(grouped)))
    first = grouped[heads]
    ranked = _sorted_strings(h, start[first], bucket[first])
    # each string's entries follow each other in its place
    length = sizes[ranked]
    begin = np.cumsum(length) - length
    order = grouped[np.repeat(heads[ranked] - begin, length) + np.arange(len(grouped))]
    maybe = np.ones(len(order), dtype=bool)
    maybe[begin] = False
    same = np.zeros(len(order), dtype=bool)
    at = np.flatnonzero(maybe)
    for k in range(0, len(at), 20_000):  # byte by byte: a collision of hashes is no match
        part = at[k : k + 20_000]
        window = np.arange(LENGTH)
        same[part] = (h.data[start[order[part]][:, None] + window] == h.data[start[order[part - 1]][:, None] + window]).all(axis=1)
    return order, same


def _sorted_strings(h: PrefixHashes, start: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    """Order of different strings by bucket, in a bucket by their bytes; buckets come in order.

    A bottom-up mergesort of all buckets side by side: in each round a suffix's new place
    is its place in its own block plus its rank in the sibling block, found by binary
    search."""
    n = len(start)
    order = np.arange(n)
    whole = h.of(start, LENGTH)
    heads = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if n else np.zeros(0, dtype=np.int64)
    sizes = np.diff(np.append(heads, n))
    base, size = np.repeat(heads, sizes), np.repeat(sizes, sizes)
    width = 1
    while n and width < sizes.max():
        place = np.flatnonzero(size > width)
        own, end = base[place], base[place] + size[place]
        block = (place - own) // width
        sibling = own + (block ^ 1) * width
        has = sibling < end
        place, own, end, block, sibling = place[has], own[has], end[has], block[has], sibling[has]
        low, high = sibling.copy(), np.minimum(sibling + width, end)
        right = block % 2 == 1
        me = order[place]
        open_ = np.flatnonzero(low < high)
        while len(open_):
            middle = (low[open_] + high[open_]) // 2
            other = order[middle]
            sign = compare(h, start[other], start[me[open_]], whole, (other, me[open_]))
            before = (sign < 0) | ((sign == 0) & right[open_])  # stable: equals of the left block come first
            low[open_] = np.where(before, middle + 1, low[open_])
            high[open_] = np.where(before, high[open_], middle)
            open_ = open_[low[open_] < high[open_]]
        target = own + (block // 2) * 2 * width + (place - own - block * width) + (low - sibling)
        new = order.copy()
        new[target] = me
        order = new
        width *= 2
    return order


def runs(texts: list[bytes]) -> dict[str, np.ndarray]:
    """The runs of the texts: ``text`` (its place in the list), ``start``, ``count`` of
    string starts, ``rel`` (the anchor's distance from the start) and the anchor's
    ``key``, a 64-bit hash."""
    table = _bytes_table()
    size = (1 << 20) + LENGTH
    power, inverse = _powers(_BASE, size), _powers(_INVERSE, size)
    found: dict[str, list[np.ndarray]] = {k: [] for k in ("text", "start", "count", "rel", "key")}

    def flush(pieces: list[tuple[int, int, bytes]]) -> None:
        data = np.frombuffer(b"".join(p for _, _, p in pieces), dtype=np.uint8)
        n = len(data)
        prefix = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(table[data] * power[:n], out=prefix[1:])
        gram = _mix((prefix[GRAM:] - prefix[:-GRAM]) * inverse[: n - GRAM + 1])
        low = (gram & ~_POSITION) | np.arange(len(gram), dtype=np.uint64)
        width = 1
        while 2 * width <= GRAMS:
            low = np.minimum(low[:-width], low[width:])
            width *= 2
        if width < GRAMS:
            low = np.minimum(low[: len(low) - (GRAMS - width)], low[GRAMS - width :])
        anchor = (low & _POSITION).astype(np.int64)
        valid = np.zeros(len(anchor) + 1, dtype=bool)
        begins, begin = [], 0
        for _, _, p in pieces:
            valid[begin : begin + len(p) - LENGTH + 1] = True
            begins.append(begin)
            begin += len(p)
        moved = np.concatenate([[True], anchor[1:] != anchor[:-1], [True]])
        head = np.flatnonzero(valid[:-1] & (moved[:-1] | ~np.concatenate([[False], valid[:-2]])))
        tail = np.flatnonzero(valid[:-1] & (moved[1:] | ~valid[1:]))
        piece = np.searchsorted(begins, head, side="right") - 1
        found["text"].append(np.array([t for t, _, _ in pieces])[piece])
        found["start"].append(head - np.array(begins)[piece] + np.array([o for _, o, _ in pieces])[piece])
        found["count"].append(tail - head + 1)
        found["rel"].append(anchor[head] - head)
        found["key"].append(_mix(gram[anchor[head]]))  # minima are small: spread them again

    pieces: list[tuple[int, int, bytes]] = []
    total = 0
    for i, text in enumerate(texts):
        for offset in range(0, len(text) - LENGTH + 1, _PIECE):
            part = text[offset : offset + _PIECE + LENGTH - 1]
            if len(part) < LENGTH:
                continue
            if total + len(part) > 1 << 20:
                flush(pieces)
                pieces, total = [], 0
            pieces.append((i, offset, part))
            total += len(part)
    if pieces:
        flush(pieces)
    kinds = {"key": np.uint64}
    return {k: np.concatenate(v) if v else np.zeros(0, dtype=kinds.get(k, np.int64)) for k, v in found.items()}


def _pack(keys: np.ndarray) -> bytes:
    """Sorted keys as differences, of four bytes each where they fit."""
    steps = np.diff(keys, prepend=np.uint64(0))
    return b"\x00" + keys[:1].tobytes() + steps[1:].astype(np.uint32).tobytes() if len(keys) and steps[1:].max(initial=0) < 1 << 32 else b"\x01" + keys.tobytes()


def _unpack(data: bytes) -> np.ndarray:
    if data[:1] == b"\x01":
        return np.frombuffer(data, dtype=np.uint64, offset=1)
    keys = np.empty((len(data) - 9) // 4 + 1, dtype=np.uint64)
    keys[0] = np.frombuffer(data, dtype=np.uint64, offset=1, count=1)[0]
    keys[1:] = np.frombuffer(data, dtype=np.uint32, offset=9)
    return np.cumsum(keys, dtype=np.uint64)


def _messages(rows: list[dict]) -> pa.Table:
    return pa.Table.from_pylist(rows, schema=_FIELDS)


class Batch:
    """The texts of a batch that are kept as one of their copies, by (doc_id, hash)."""

    def __init__(self, docs: pa.Table, mail: pa.Table):
        self.ids = docs.column("doc_id").to_pylist()
        self.classes = docs.column("class").to_pylist()
        self.raw = [t or b"" for t in docs.column("text").cast(pa.binary()).to_pylist()]
        kind = np.array(mail.column("kind").to_pylist(), dtype=np.int64)
        self.mail = {k: mail.filter(pa.array(kind == k)) for k in (KEEPER, SHARED, COVERED)}
        keepers = set(zip(self.mail[KEEPER].column("doc_id").to_pylist(), self.mail[KEEPER].column("ids").to_pylist(), strict=True))
        first: dict[tuple, bytes] = {}
        for doc, cls, text in zip(self.ids, self.classes, self.raw, strict=True):
            if (doc, cls) in keepers:
                first.setdefault((doc, cls), text)
        self.kept = sorted(first)
        self.place = {k: i for i, k in enumerate(self.kept)}
        self.texts = [first[k] for k in self.kept]
        self.doc = np.array([doc for doc, _ in self.kept], dtype=np.int64)
        self.runs = runs(self.texts)

    def shared_keys(self) -> np.ndarray:
        parts = [_unpack(x) for x in self.mail[SHARED].column("keys").to_pylist()]
        return np.sort(np.concatenate(parts)) if parts else np.zeros(0, dtype=np.uint64)

    def matching(self, bits: int) -> tuple[list[int], list[int], list[bytes], np.ndarray]:
        """Runs whose anchor another text has: (run, number of its content) pairs, the
        contents in order of their first text, and which of them the shards must see."""
        r, shared = self.runs, self.shared_keys()
        short = r["key"] >> np.uint64(64 - bits)
        far = np.zeros(len(short), dtype=bool)
        if len(shared) and len(short):
            far = shared[np.minimum(np.searchsorted(shared, short), len(shared) - 1)] == short
        order = np.lexsort((r["text"], r["key"]))
        key, doc = r["key"][order], self.doc[r["text"][order]] if len(order) else np.zeros(0, dtype=np.int64)
        new_key = np.concatenate([[True], key[1:] != key[:-1]]) if len(key) else np.zeros(0, dtype=bool)
        group = np.cumsum(new_key) - 1
        other = np.zeros(len(key), dtype=bool)
        if len(key):
            heads = np.flatnonzero(new_key)
            other = (np.minimum.reduceat(doc, heads) != np.maximum.reduceat(doc, heads))[group]
        near = np.zeros(len(key), dtype=bool)
        near[order] = other
        chosen = np.flatnonzero(far | near)
        number: dict[bytes, int] = {}
        contents: list[bytes] = []
        of = []
        texts = self.texts
        for t, s, c in zip(r["text"][chosen].tolist(), r["start"][chosen].tolist(), r["count"][chosen].tolist(), strict=True):
            content = texts[t][s : s + c + LENGTH - 1]
            i = number.get(content)
            if i is None:
                i = number[content] = len(contents)
                contents.append(content)
            of.append(i)
        of_array = np.array(of, dtype=np.int64)
        _, head = np.unique(of_array, return_index=True)
        content_key = r["key"][chosen][head]
        _, back, several = np.unique(content_key, return_inverse=True, return_counts=True)
        send = far[chosen][head] | (several[back] > 1)
        return chosen, of_array, contents, send


def _rows_by_shard(shard: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    if not len(shard):
        return
    order = np.argsort(shard, kind="stable")
    values, heads = np.unique(shard[order], return_index=True)
    for value, part in zip(values.tolist(), np.split(order, heads[1:]), strict=True):
        yield value, part


def _shard_of(short: np.ndarray, bits: int, shards: int) -> np.ndarray:
    """Shards are ranges of the shortened keys, so that a message's keys lie close."""
    return np.minimum((short.astype(np.float64) * (shards / 2.0**bits)).astype(np.int64), shards - 1)


def _ask(bits: int, shards: int):
    def run(key, docs, mail):
        batch = Batch(docs, mail)
        short = np.unique(batch.runs["key"] >> np.uint64(64 - bits))
        return _messages([{"to": s, "sender": key[0].as_py(), "kind": SHARED, "keys": _pack(short[i])} for s, i in _rows_by_shard(_shard_of(short, bits, shards))])

    return run


def _answer(key, mail):
    """Which keys of each batch another batch has too."""
    keys = [_unpack(x) for x in mail.column("keys").to_pylist()]
    value, n = np.unique(np.concatenate(keys), return_counts=True)
    value = value[n > 1]
    out = []
    for sender, k in zip(mail.column("sender").to_pylist(), keys, strict=True):
        if len(value):
            both = k[value[np.minimum(np.searchsorted(value, k), len(value) - 1)] == k]
            if len(both):
                out.append({"to": sender, "sender": key[0].as_py(), "kind": SHARED, "keys": _pack(both)})
    return _messages(out)


def _send(bits: int, shards: int):
    def run(key, docs, mail):
        batch = Batch(docs, mail)
        chosen, of, contents, send = batch.matching(bits)
        if not len(chosen):
            return _messages([])
        _, head = np.unique(of, return_index=True)
        at = chosen[head]
        r = batch.runs
        sent = np.flatnonzero(send)
        short = r["key"][at[sent]] >> np.uint64(64 - bits)
        out = []
        for shard, i in _rows_by_shard(_shard_of(short, bits, shards)):
            part = sent[i]
            run_ = at[part]
            out.append(
                {
                    "to": shard,
                    "sender": key[0].as_py(),
                    "kind": COVERED,
                    "ids": np.concatenate([part, batch.doc[r["text"][run_]]]).astype(np.int64).tobytes(),
                    "keys": r["key"][run_].tobytes(),
                    "sizes": np.concatenate([r["count"][run_], r["rel"][run_]]).astype(np.uint8).tobytes(),
                    "data": b"".join([contents[j] for j in part.tolist()]),
                }
            )
        return _messages(out)

    return run


def _meeting(group: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """The entries of the groups that hold several documents; only these need sorting."""
    if not len(group):
        return np.zeros(0, dtype=np.int64)
    order = np.argsort(group, kind="stable")
    heads = np.flatnonzero(np.concatenate([[True], np.diff(group[order]) != 0]))
    doc = doc[order]
    several = np.minimum.reduceat(doc, heads) < np.maximum.reduceat(doc, heads)
    return order[np.repeat(several, np.diff(np.append(heads, len(order))))]


def _sort(key, mail):
    """The strings of each run that a smaller doc_id has too, as a bit for each start."""
    ids = [np.frombuffer(x, dtype=np.int64).reshape(2, -1) for x in mail.column("ids").to_pylist()]
    sizes = [np.frombuffer(x, dtype=np.uint8).reshape(2, -1).astype(np.int64) for x in mail.column("sizes").to_pylist()]
    anchor = np.concatenate([np.frombuffer(x, dtype=np.uint64) for x in mail.column("keys").to_pylist()])
    data = np.frombuffer(b"".join(mail.column("data").to_pylist()), dtype=np.uint8)
    doc = np.concatenate([x[1] for x in ids])
    count, rel = np.concatenate([x[0] for x in sizes]), np.concatenate([x[1] for x in sizes])
    begin = np.concatenate([[0], np.cumsum(count + LENGTH - 1)[:-1]])
    run_of = np.repeat(np.arange(len(count)), count)
    step = np.arange(len(run_of)) - np.repeat(np.cumsum(count) - count, count)
    start = begin[run_of] + step
    bucket = _mix(anchor[run_of] + (rel[run_of] - step).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    bit = np.zeros(len(run_of), dtype=np.uint64)
    met = _meeting(bucket, doc[run_of])
    if len(met):
        # of these, the strings whose hash another document's string has in the bucket
        hashes = PrefixHashes(data)
        string = _mix(bucket[met] + hashes.of(start[met], LENGTH) * _GOLD)
        met = met[_meeting(string, doc[run_of[met]])]
    if len(met):
        order, same = suffix_mergesort(hashes, start[met], bucket[met])
        order = met[order]
        smallest = doc[run_of[order]]
        heads = np.flatnonzero(~same)
        smallest = np.repeat(np.minimum.reduceat(smallest, heads), np.diff(np.append(heads, len(order))))
        bit[order] = smallest < doc[run_of[order]]
    masks = np.add.reduceat(bit << step.astype(np.uint64), np.cumsum(count) - count)
    out, at = [], 0
    for sender, x in zip(mail.column("sender").to_pylist(), ids, strict=True):
        mask = masks[at : at + x.shape[1]]
        at += x.shape[1]
        hit = mask > 0
        if hit.any():
            out.append({"to": sender, "sender": key[0].as_py(), "kind": COVERED, "ids": x[0][hit].tobytes(), "data": mask[hit].tobytes()})
    return _messages(out)


def _cut(bits: int):
    def run(key, docs, mail):
        batch = Batch(docs, mail)
        chosen, of, contents, _ = batch.matching(bits)
        mask = np.zeros(len(contents), dtype=np.uint64)
        for ids, data in zip(batch.mail[COVERED].column("ids").to_pylist(), batch.mail[COVERED].column("data").to_pylist(), strict=True):
            mask[np.frombuffer(ids, dtype=np.int64)] |= np.frombuffer(data, dtype=np.uint64)
        r, results = batch.runs, []
        if len(chosen):
            _, head = np.unique(of, return_index=True)
            doc = batch.doc[r["text"][chosen]]
            # a run whose content a smaller doc_id of the batch has is covered whole
            own = np.where(doc > doc[head][of], np.uint64((1 << GRAMS) - 1), mask[of])
        by_text: dict[int, list[int]] = {}
        for i, t in enumerate(r["text"][chosen].tolist() if len(chosen) else []):
            if own[i]:
                by_text.setdefault(t, []).append(i)
        for t, text in enumerate(batch.texts):
            results.append(_cut_text(text, [(int(r["start"][chosen[i]]), int(r["count"][chosen[i]]), int(own[i])) for i in by_text.get(t, ())]))
        rows = []
        for doc, cls, text in zip(batch.ids, batch.classes, batch.raw, strict=True):
            place = batch.place.get((doc, cls))
            if place is not None:
                rows.append((doc, len(text), *results[place]))
            elif doc is not None and len(text) >= LENGTH:  # a copy of a text with a smaller doc_id
                rows.append((doc, len(text), len(text), 1, sha256(b"").hexdigest()))
            else:
                rows.append((doc, len(text), 0, 0, sha256(text).hexdigest()))
        kinds = [pa.int64()] * 4 + [pa.string()]
        columns = list(zip(*rows, strict=True)) if rows else [()] * 5
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return run


def _cut_text(text: bytes, covered: list[tuple[int, int, int]]) -> tuple[int, int, str]:
    """n_removed, n_spans and the hash of the rest; ``covered`` are runs with a bit for
    each string start that is covered."""
    if not covered:
        return 0, 0, sha256(text).hexdigest()
    starts = np.zeros(len(text) + LENGTH + 1, dtype=np.int32)
    for start, count, mask in covered:
        if mask & ((1 << count) - 1) == (1 << count) - 1:
            starts[start : start + count] = 1
        else:
            for j in range(count):
                if mask >> j & 1:
                    starts[start + j] = 1
    total = np.concatenate([np.zeros(LENGTH, dtype=np.int32), np.cumsum(starts[: len(text)], dtype=np.int32)])
    gone = total[LENGTH:] > total[:-LENGTH]
    spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
    return int(gone.sum()), spans, sha256(np.frombuffer(text, dtype=np.uint8)[~gone].tobytes()).hexdigest()


def remove_repeats(docs: DataFrame) -> DataFrame:
    """op10: doc_id, n_bytes, n_removed, n_spans, kept_sha256 for each row."""
    spark = docs.sparkSession
    source = id_text(docs)
    total = input_bytes(source)
    batches, shards = partitions_for(spark, total, BATCH_BYTES), partitions_for(spark, total, SHARD_BYTES)
    bits = min(62, max(40, total.bit_length() + 10))
    hashed = source.withColumn("class", F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)))
    batch = F.pmod(F.xxhash64("doc_id"), F.lit(batches)).alias("batch")
    dealt = hashed.select(batch, "doc_id", "class", "text")
    none = [F.lit(None).cast("binary").alias(c) for c in ("keys", "sizes", "data")]
    keepers = hashed.filter("doc_id is not null").groupBy("class").agg(F.min("doc_id").alias("doc_id"))
    keepers = keepers.select(batch.alias("to"), F.lit(-1).cast("long").alias("sender"), F.lit(KEEPER).alias("kind"), "doc_id", F.col("class").alias("ids"), *none)

    def at_batches(mail: DataFrame, step, schema: str) -> DataFrame:
        return dealt.groupBy("batch").cogroup(mail.groupBy("to")).applyInArrow(step, schema)

    asked = at_batches(keepers, _ask(bits, shards), MESSAGE)
    answered = keepers.union(asked.groupBy("to").applyInArrow(_answer, MESSAGE))
    sent = at_batches(answered, _send(bits, shards), MESSAGE)
    reported = answered.union(sent.groupBy("to").applyInArrow(_sort, MESSAGE))
    return at_batches(reported, _cut(bits), RESULT)


def suffix_dedup(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return remove_repeats(docs)
