"""SentencePiece encoding and decoding by a streaming Viterbi search.

The text gets a leading blank and every blank becomes the meta symbol U+2581.  The best
segmentation into vocabulary pieces (largest sum of piece scores) is found from left to
right.  A piece has at most ``longest`` characters, so only the last ``longest``
positions can still be extended: they are the surviving paths.  Whenever all their
backpointers lead through one boundary, everything before it is decided and its ids are
committed, so the search holds a short window and not the text.

A character without a piece, and the meta symbol itself where the text has it, costs
``fallback_score`` and becomes its UTF-8 bytes as byte pieces, so decoding gives back
exactly the text.

If no piece has the meta symbol after another character (found when the vocabulary is
loaded), every path has a boundary before each run of meta symbols: the search commits
there, and equal words have equal ids.  Then the words of a slice of texts are searched
side by side, and a bounded memo keeps their ids.

Ties take the segmentation whose last piece is the longest.  Null and empty texts have no ids and decode to the empty text.
Rows are encoded one by one: repeated rows give repeated results, an empty table gives an
empty one.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from threatlens.llm.common import id_text, text_slices, texts

META = "▁"
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Words kept in a task's memo; it starts anew when full.
MEMO_WORDS = 400_000
_WORD = re.compile(f"{META}*[^{META}]+|{META}+")
#: Stands for a meta symbol of the text itself while it is encoded: not a character.
_OWN_META = "\udc81"


def load_vocabulary(model_file: str = MODEL) -> SimpleNamespace:
    """Pieces, scores and byte pieces of a model file, read on the driver; its size is
    that of the vocabulary, so it can be broadcast."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
    ids, pieces, byte_ids = {}, [], [0] * 256
    for i in range(sp.get_piece_size()):
        piece = sp.id_to_piece(i)
        pieces.append(piece)
        if sp.is_byte(i):
            byte_ids[int(piece[3:5], 16)] = i
        elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
            ids[piece] = (i, sp.get_score(i))
    return vocabulary(pieces, ids, byte_ids)


def vocabulary(pieces: list[str], ids: dict[str, tuple[int, float]], byte_ids: list[int]) -> SimpleNamespace:
    piece_bytes = np.empty(len(pieces), dtype=object)
    piece_bytes[:] = [p.replace(META, " ").encode() for p in pieces]
    for b, i in enumerate(byte_ids):
        piece_bytes[i] = bytes([b])
    by_word = not any(re.search(f"[^{META}]{META}", p) for p in ids)
    return SimpleNamespace(
        pieces=pieces,
        ids=ids,
        byte_ids=byte_ids,
        piece_bytes=piece_bytes,
        longest=max(map(len, ids), default=1),
        fallback_score=min((s for _, s in ids.values()), default=0.0) - 10.0,
        by_word=by_word,
    )


def matcher(v: SimpleNamespace):
    """Finds all pieces in a text, by their last character (an Aho-Corasick automaton);
    built once per task from the broadcast vocabulary."""
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for piece, (_, score) in v.ids.items():
        automaton.add_word(piece, (len(piece), score))
    automaton.make_automaton()
    return automaton


def viterbi_stream(chars: str, v: SimpleNamespace, automaton) -> Iterator[list[int]]:
    """Lists of ids in order, each committed as soon as no surviving path can change it."""
    fallback, full = v.fallback_score, 4 * v.longest
    base, score, back = 0, [0.0], [0]  # position 0 is the last committed boundary
    for last, (length, gain) in automaton.iter(chars) if v.ids else ():
        end = last + 1 - base
        while len(score) <= end:  # a new position; the ones before it are final
            if len(score) > full:
                # the last ``longest`` positions can still be extended; where do all their
                # backpointers meet?
                alive = set(range(len(score) - v.longest, len(score)))
                while len(alive) > 1:
                    alive.add(_step(alive, back))
                at = alive.pop()
                if at:
                    yield _ids_between(chars, base, at, back, v)
                    base, end = base + at, end - at
                    score, back = score[at:], [max(x - at, 0) for x in back[at:]]
                full = len(score) + 4 * v.longest
            score.append(score[-1] + fallback)
            back.append(len(back) - 1)
        found = score[end - length] + gain
        if found > score[end]:
            score[end], back[end] = found, end - length
    while len(score) <= len(chars) - base:
        back.append(len(score) - 1)
        score.append(score[-1] + fallback)
    yield _ids_between(chars, base, len(score) - 1, back, v)


def _step(alive: set[int], back: list[int]) -> int:
    """Take the last position out of the set; where its path comes from."""
    last = max(alive)
    alive.discard(last)
    return back[last]


def _ids_between(chars: str, base: int, end: int, back: list[int], v: SimpleNamespace) -> list[int]:
    out: list[int] = []
    ids = v.ids
    while end > 0:
        begin = back[end]
        piece = chars[base + begin : base + end]
        known = ids.get(piece)
        if known is not None:
            out.append(known[0])
        else:
            raw = (META if piece == _OWN_META else piece).encode("utf-8", "surrogatepass")
            out += [v.byte_ids[b] for b in reversed(raw)]
        end = begin
    return out[::-1]


_HASH = 0x9E3779B97F4A7C15 | 1
_SLOT_BITS = 20


def piece_table(v: SimpleNamespace) -> SimpleNamespace:
    """Pieces by the polynomial hash of their characters, for array look-ups: a slot
    table by the hash's upper bits, and a second one for pieces whose slot is taken."""
    with np.errstate(over="ignore"):
        first = SimpleNamespace(key=np.zeros(1 << _SLOT_BITS, np.uint64), id=np.full(1 << _SLOT_BITS, -1, np.int32))
        gain, of = [], []
        for piece, (i, score) in v.ids.items():
            h = 0
            for ch in piece:
                h = (h * _HASH + ord(ch) + 1) & 0xFFFFFFFFFFFFFFFF
            of.append((h, i))
            gain.append(score)
    rest: dict[int, int] = {}
    score = np.zeros(len(v.pieces), dtype=np.float64)
    for (h, i), g in zip(of, gain, strict=True):
        score[i] = g
        slot = (h * _HASH & 0xFFFFFFFFFFFFFFFF) >> (64 - _SLOT_BITS)
        if first.id[slot] < 0:
            first.key[slot], first.id[slot] = h, i
        else:
            rest[h] = i
    keys = np.array(sorted(rest), dtype=np.uint64)
    return SimpleNamespace(
        key=first.key, id=first.id, rest=keys, rest_id=np.array([rest[int(k)] for k in keys], dtype=np.int32), score=score
    )


def _look_up(h: np.ndarray, t: SimpleNamespace) -> np.ndarray:
    """Piece ids of hashes, -1 where there is none."""
    slot = (h * np.uint64(_HASH)) >> np.uint64(64 - _SLOT_BITS)
    found = np.where(t.key[slot] == h, t.id[slot], -1)
    other = np.flatnonzero((found < 0) & (t.id[slot] >= 0))
    if len(other) and len(t.rest):
        at = np.minimum(np.searchsorted(t.rest, h[other]), len(t.rest) - 1)
        found[other] = np.where(t.rest[at] == h[other], t.rest_id[at], -1)
    return found


def encode_words(words: list[str], v: SimpleNamespace, t: SimpleNamespace, automaton) -> list[bytes]:
    """Packed ids of each word.  Words of one length go through the same search side by
    side, with arrays over the words; a word's end is a boundary of all its paths.  Long
    words, and those with a character that has no piece, take the stream one by one."""
    out: list[bytes] = [b""] * len(words)
    by_length: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        by_length.setdefault(len(w) if len(w) <= 2 * v.longest else 0, []).append(i)
    slow = by_length.pop(0, [])
    for n, group in by_length.items():
        for start in range(0, len(group), 20_000):
            part = group[start : start + 20_000]
            chars = np.frombuffer("".join([words[i] for i in part]).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
            codes = chars.reshape(len(part), n).T.astype(np.uint64) + np.uint64(1)
            prefix = np.zeros((n + 1, len(part)), dtype=np.uint64)
            for i in range(n):
                prefix[i + 1] = prefix[i] * np.uint64(_HASH) + codes[i]
            score = np.full((n + 1, len(part)), -np.inf)
            score[0] = 0.0
            length = np.zeros((n + 1, len(part)), dtype=np.int32)
            piece = np.zeros((n + 1, len(part)), dtype=np.int32)
            for end in range(1, n + 1):
                power = 1
                shifts = []
                for k in range(1, min(end, v.longest) + 1):
                    power = power * _HASH & 0xFFFFFFFFFFFFFFFF
                    shifts.append(power)
                for k in range(len(shifts), 0, -1):  # longest first: it wins a tie
                    found = _look_up(prefix[end] - prefix[end - k] * np.uint64(shifts[k - 1]), t)
                    total = score[end - k] + t.score[found]
                    better = np.flatnonzero((found >= 0) & (total > score[end]))
                    score[end, better] = total[better]
                    length[end, better] = k
                    piece[end, better] = found[better]
            whole = np.isfinite(score[n])
            # backwards along the best path of all words at once
            at = np.where(whole, n, 0)
            steps = []
            column = np.arange(len(part))
            while at.any():
                steps.append(np.where(at > 0, piece[at, column], -1))
                at = at - np.where(at > 0, length[at, column], 0)
            ids = np.array(steps[::-1], dtype=np.int32).T if steps else np.zeros((len(part), 0), np.int32)
            flat, n_of = ids[ids >= 0].tobytes(), (ids >= 0).sum(axis=1)
            ends = (np.cumsum(n_of) * 4).tolist()
            begin = 0
            for i, end, ok in zip(part, ends, whole.tolist(), strict=True):
                if ok:
                    out[i] = flat[begin:end]
                else:
                    slow.append(i)
                begin = end
    for i in slow:
        out[i] = array("i", [x for ids in viterbi_stream(words[i], v, automaton) for x in ids]).tobytes()
    return out


class Encoder:
    """A task's encoder: the broadcast vocabulary, its look-up tables and a bounded memo."""

    def __init__(self, v: SimpleNamespace):
        self.v, self.table, self.automaton, self.memo = v, piece_table(v), matcher(v), {}

    def encode(self, rows: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        split = []
        for text in rows:
            if META in text:
                text = text.replace(META, _OWN_META)
            chars = META + text.replace(" ", META) if text else ""
            split.append(_WORD.findall(chars) if self.v.by_word else [chars])
        if len(self.memo) > MEMO_WORDS:
            self.memo = {}
        memo = self.memo
        new = list({w for parts in split for w in parts if w not in memo})
        memo.update(zip(new, encode_words(new, self.v, self.table, self.automaton), strict=True))
        out = [np.frombuffer(b"".join([memo[w] for w in parts]), dtype=np.int32) for parts in split]
        for w in new:
            if len(w) > 64:
                del memo[w]
        return out


def decode(ids: np.ndarray, v: SimpleNamespace) -> str:
    """The text of the ids: the bytes of their pieces, without the leading blank."""
    return b"".join(v.piece_bytes[ids].tolist()).decode("utf-8", "surrogatepass")[1:]


def encode_documents(docs: DataFrame, model_file: str = MODEL) -> DataFrame:
    """doc_id, n_ids, ids, round_trip (decoding the ids gives the text) for each row."""
    model = docs.sparkSession.sparkContext.broadcast(load_vocabulary(model_file))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = model.value
        encoder = Encoder(v)
        for batch in text_slices(batches, "text", 2 << 20):
            rows = texts(batch)
            ids = encoder.encode(rows)
            ends = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
            flat = np.concatenate(ids) if ids else np.zeros(0, dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(np.diff(ends).astype(np.int64)),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                    pa.array([decode(x, v) == t for x, t in zip(ids, rows, strict=True)], pa.bool_()),
                ],
                names=["doc_id", "n_ids", "ids", "round_trip"],
            )

    return id_text(docs).mapInArrow(run, "doc_id long, n_ids long, ids array<int>, round_trip boolean")


def decode_documents(encoded: DataFrame, model_file: str = MODEL) -> DataFrame:
    """doc_id, text from doc_id, ids."""
    model = encoded.sparkSession.sparkContext.broadcast(load_vocabulary(model_file))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [decode(np.array(x or [], dtype=np.int32), model.value) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def sentencepiece_ids(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """op9."""
    return encode_documents(docs)


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encode_documents(docs)
