"""Secret scan by a linear-chain conditional random field (CRF).

Base spans are those of three fixed patterns.  The CRF adds spans: it tags tokens as
begin, inside or outside of a secret from the token's shape, its neighbouring words and
features of the file, decoded by Viterbi.

A text is cut into stretches of suspicious chunks (chunks of characters without white
space that have a digit or one of ``_ + / =``, are long, or follow a secret-like word);
every other chunk is a plain word whose label is fixed to outside, so the chain between
stretches is constant and each stretch is decoded alone, with outside before and after
it.  A stretch is decoded whole whatever its length.

The CRF is trained on stretches of a bounded sample of documents (``max_docs``,
``max_train_chars``, ``max_stretches``), whose tokens inside base spans count as secret.  The features have none of the base patterns,
so the model carries over to secrets that the patterns miss.  A span of the CRF that
touches a base span is dropped: the base one stands.

Positions are code points, the end exclusive.  Spans are ordered by start, then by kind
(assign, access, hex, crf).  Defined results: null is the empty text, which has no spans;
rows are scanned one by one, so repeated rows give repeated results; with no document to
learn from the base spans alone are returned; an empty table gives an empty one.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threatlens.llm.common import id_text, text_slices, texts
from threatlens.session import ensure_checkpoint_dir

# The base patterns (kind, pattern, group that must be long, its length).
BASE = (
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 8),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 16),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 32),
)
CRF = "crf"
KINDS = (*(k for k, *_ in BASE), CRF)

_KEYWORD = "password|passwd|pwd|secret|token|api_?key|access_?key|credential|bearer|auth"
#: A cheap test that every suspicious chunk passes.
_HINT = re.compile(rf"[0-9_+/=]|\S{{25}}|(?:{_KEYWORD})\W", re.I)
_KEYWORD_RE = re.compile(_KEYWORD, re.I)
_CHUNK = re.compile(r"\S+")
_TOKEN = re.compile(r"[\w+/.=-]*[\w+/-]|[^\s]")
_HEX = re.compile(r"[0-9a-fA-F]+")
BEGIN, INSIDE, OUTSIDE = 0, 1, 2
FEATURES = 1 << 12


@dataclass(frozen=True)
class CrfRules:
    #: bound of the training sample: documents with a base span, and as many without one
    max_docs: int = 1500
    epochs: int = 60
    rate: float = 0.2
    decay: float = 1e-3
    #: stretches longer than this teach nothing (they are still decoded)
    max_train_tokens: int = 64
    #: texts of so many characters and more teach nothing (they are still scanned)
    max_train_chars: int = 50_000
    #: bound of the stretches that teach, those with a secret first
    max_stretches: int = 20_000


#: A text without a match has no base span; only for the draw of the training documents.
LIKELY = (
    r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9+/_.=-]{8}|AKIA[A-Z0-9]{12}|[0-9a-f]{32}"
)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base patterns, in order."""
    out = []
    for kind, (_, pattern, group, least) in enumerate(BASE):
        for m in pattern.finditer(text):
            if m.end(group) - m.start(group) >= least:
                out.append((m.start(), kind, m.end()))
    return sorted(out)


def _secret_parts(text: str) -> list[tuple[int, int]]:
    """Where the secrets themselves stand inside the base spans."""
    return [
        m.span(group) for _, pattern, group, least in BASE for m in pattern.finditer(text) if m.end(group) - m.start(group) >= least
    ]


def stretches(text: str) -> list[tuple[list[tuple[int, int]], list[str]]]:
    """The suspicious stretches: their tokens' spans, and the three chunks before each.

    Chunks of one stretch follow each other; a chunk after a secret-like word is
    suspicious up to the third, symbols alone are so only between others."""
    if not _HINT.search(text):
        return []
    out, run, hot, last = [], [], 0, ["", "", ""]
    before: list[str] = last

    def close() -> None:
        if run:
            out.append(([m.span() for s, e in run for m in _TOKEN.finditer(text, s, e)], before))

    for m in _CHUNK.finditer(text):
        chunk = m.group()
        keyword = _KEYWORD_RE.search(chunk) is not None
        suspicious = hot > 0 or len(chunk) >= 25 or not (chunk.isalpha() or _HINT.search(chunk) is None)
        if suspicious:
            if not run:
                before = last
            run.append(m.span())
        else:
            close()
            run = []
        hot = 3 if keyword else hot - 1
        last = [*last[1:], chunk[:40]]
    close()
    return out


def _shape(token: str) -> tuple[str, ...]:
    n = len(token)
    kinds = "".join(
        k
        for k, hit in (
            ("a", any("a" <= c <= "z" for c in token)),
            ("A", any("A" <= c <= "Z" for c in token)),
            ("0", any(c.isdigit() for c in token)),
            ("+", any(c in "+/=" for c in token)),
            ("_", any(c in "_.-" for c in token)),
            ("u", not token.isascii()),
        )
        if hit
    )
    size = 1 if n == 1 else 2 if n < 5 else 3 if n < 8 else 4 if n < 12 else 5 if n < 16 else 6 if n < 24 else 7 if n < 32 else 8
    changes = sum(a.isdigit() != b.isdigit() for a, b in zip(token[:64], token[1:64], strict=False))
    mixed = 0 if changes < 2 else 1 if changes < 5 else 2
    return f"{kinds}|{size}", f"{kinds}|{mixed}", f"x{bool(_HEX.fullmatch(token))}|{size}", f"m{mixed}|{size}"


def _number(name: str) -> int:
    """A feature's number: a stable hash of its name."""
    h = 2166136261
    for c in name.encode("utf-8", "surrogatepass"):
        h = ((h ^ c) * 16777619) & 0xFFFFFFFF
    return (h ^ (h >> 15)) % FEATURES


def file_kind(text: str) -> str:
    """The file features of a text: how much of it is code signs, and whether it has many lines."""
    share = sum(text.count(c) for c in "={};") / (len(text) + 1)
    return f"file{0 if share < 0.001 else 1 if share < 0.01 else 2}|{'lines' if text.count(chr(10)) > 20 else 'few'}"


def features(text: str, kind: str, spans: list[tuple[int, int]], before: list[str], memo: dict[str, int]) -> list[list[int]]:
    """Feature numbers of each token of a stretch of a text of that ``file_kind``."""
    tokens = [text[s:e] for s, e in spans]
    words = [w for chunk in before for w in re.findall(r"\w+", chunk.lower())][-3:]
    lower = [*([""] * (3 - len(words))), *words, *[t.lower()[:40] for t in tokens], "", ""]
    out = []
    for i, token in enumerate(tokens):
        near = lower[i : i + 3]
        named = any(_KEYWORD_RE.search(w) for w in near)
        shape = _shape(token[:200])
        names = [
            *shape, f"k{named}|{shape[0]}", f"p1={near[2][:12]}", f"p2={near[1][:12]}", f"n1={lower[i + 4][:12]}",
            f"assigned{named and any(c in ('=', ':') for c in near)}", f"{kind}|{shape[0]}", f"self={token.lower()[:12]}" if len(token) < 12 else "long",
        ]
        ids = []
        for name in names:
            number = memo.get(name)
            if number is None:
                if len(memo) > 200_000:
                    memo.clear()
                number = memo[name] = _number(name)
            ids.append(number)
        out.append(ids)
    return out


def viterbi(emit: np.ndarray, move: np.ndarray) -> list[int]:
    """Best labels of one stretch; outside stands before and after it."""
    score = emit[0] + move[OUTSIDE]
    back = []
    for row in emit[1:]:
        step = score[:, None] + move
        back.append(step.argmax(axis=0))
        score = step.max(axis=0) + row
    label = int((score + move[:, OUTSIDE]).argmax())
    out = [label]
    for b in reversed(back):
        label = int(b[label])
        out.append(label)
    return out[::-1]


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + np.squeeze(top, axis)


def fit(examples: list[tuple[list[list[int]], list[int]]], rules: CrfRules) -> SimpleNamespace:
    """Weights by gradient ascent (Adagrad) on the likelihood: all sequences go side by
    side through the forward and backward sums."""
    n, longest = len(examples), max(len(y) for _, y in examples)
    width = len(examples[0][0][0])
    x = np.zeros((n, longest, width), dtype=np.int64)
    y = np.full((n, longest), OUTSIDE)
    size = np.array([len(labels) for _, labels in examples])
    for i, (f, labels) in enumerate(examples):
        x[i, : len(labels)] = f
        y[i, : len(labels)] = labels
    live = np.arange(longest)[None, :] < size[:, None]
    # the same stretch of features and labels counts as often as it comes
    emit_w, move = np.zeros((FEATURES, 3)), np.zeros((3, 3))
    square_e, square_m = np.full_like(emit_w, 1e-8), np.full_like(move, 1e-8)
    gold_e, gold_m = np.zeros_like(emit_w), np.zeros_like(move)
    one = np.eye(3)[y] * live[..., None]
    for k in range(width):
        np.add.at(gold_e, x[:, :, k].ravel(), one.reshape(-1, 3))
    previous = np.concatenate([np.full((n, 1), OUTSIDE), y[:, :-1]], axis=1)
    np.add.at(gold_m, (previous[live], y[live]), 1)
    np.add.at(gold_m, (y[np.arange(n), size - 1], np.full(n, OUTSIDE)), 1)
    for _ in range(rules.epochs):
        emit = emit_w[x].sum(axis=2)
        alpha = np.zeros((n, longest, 3))
        alpha[:, 0] = emit[:, 0] + move[OUTSIDE]
        for t in range(1, longest):
            new = _log_sum(alpha[:, t - 1, :, None] + move[None], 1) + emit[:, t]
            alpha[:, t] = np.where(live[:, t, None], new, alpha[:, t - 1])
        total = _log_sum(alpha[:, -1] + move[:, OUTSIDE], 1)
        beta = np.zeros((n, longest, 3))
        beta[:, -1] = move[:, OUTSIDE]
        expect_m = np.zeros((3, 3))
        for t in range(longest - 1, 0, -1):
            inner = move[None] + (emit[:, t] + beta[:, t])[:, None, :]
            pair = np.exp(alpha[:, t - 1, :, None] + inner - total[:, None, None]) * live[:, t, None, None]
            expect_m += pair.sum(axis=0)
            beta[:, t - 1] = np.where(live[:, t, None], _log_sum(inner, 2), beta[:, t])
        marginal = np.exp(alpha + beta - total[:, None, None]) * live[..., None]
        expect_m[OUTSIDE] += marginal[:, 0].sum(axis=0)
        expect_m[:, OUTSIDE] += marginal[np.arange(n), size - 1].sum(axis=0)
        expect_e = np.zeros_like(emit_w)
        flat = marginal.reshape(-1, 3)
        for k in range(width):
            at = x[:, :, k].ravel()
            for c in range(3):
                expect_e[:, c] += np.bincount(at, weights=flat[:, c], minlength=FEATURES)
        grad_e, grad_m = (gold_e - expect_e) / n - rules.decay * emit_w, (gold_m - expect_m) / n - rules.decay * move
        square_e += grad_e**2
        square_m += grad_m**2
        emit_w += rules.rate * grad_e / np.sqrt(square_e)
        move += rules.rate * grad_m / np.sqrt(square_m)
    return SimpleNamespace(emit=emit_w, move=move)


def train(docs: DataFrame, rules: CrfRules = CrfRules()) -> SimpleNamespace | None:
    """Learn from a sample of documents by a hash of their text; the documents with a
    base span and those with other suspicious stretches in equal numbers at most.  Without a
    base span in the whole table there is no model (``None``)."""
    ensure_checkpoint_dir(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            kind = [2 if base_spans(t) else 1 if stretches(t) else 0 for t in texts(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("text"), pa.array(kind, pa.int32())], names=["text", "kind"])

    text = F.col("text")
    rows = id_text(docs).filter((F.length(text) > 0) & (F.length(text) < rules.max_train_chars)).select("text")
    based = text.rlike(LIKELY)
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(based).alias("based")).first()
    # draws by hash, so that the search for training documents ends at a bounded number
    # however large the table is and however rare the secrets are in it
    place = F.pmod(F.xxhash64("text", F.lit(1)), F.lit(1 << 30))
    bound = lambda docs, of: int(min(1.0, docs / max(of, 1)) * (1 << 30))
    limit = F.when(based, bound(2 * rules.max_docs, size["based"])).otherwise(bound(16 * rules.max_docs, size["n"] - size["based"]))
    kinds = rows.filter(place < limit).mapInArrow(run, "text string, kind int").filter("kind > 0").checkpoint()
    order = F.xxhash64("text", F.lit(2))
    found = [kinds.filter(F.col("kind") == k).orderBy(order, "text").limit(rules.max_docs).select("text").toArrow().column(0).to_pylist() for k in (1, 2)]
    examples, memo = [], {}
    for text in [t for part in found for t in part]:
        secrets, kind = _secret_parts(text), file_kind(text)
        for spans, before in stretches(text):
            if spans and len(spans) <= rules.max_train_tokens:
                labels, open_span = [], None
                for s, e in spans:
                    inside = next((p for p in secrets if s < p[1] and e > p[0]), None)
                    labels.append(OUTSIDE if inside is None else INSIDE if inside == open_span else BEGIN)
                    open_span = inside
                examples.append((features(text, kind, spans, before, memo), labels))
    examples = sorted(examples, key=lambda x: BEGIN not in x[1])[: rules.max_stretches]
    weights = Counter(label for _, labels in examples for label in labels)
    return fit(examples, rules) if weights[BEGIN] else None


def scan(text: str, model: SimpleNamespace | None, memo: dict[str, int]) -> list[tuple[int, int, int]]:
    """All spans of a text: the base ones and those that the CRF adds."""
    base = base_spans(text)
    if model is None:
        return base
    added = []
    kind = file_kind(text)
    for spans, before in stretches(text):
        if not spans:
            continue
        emit = model.emit[np.array(features(text, kind, spans, before, memo))].sum(axis=1)
        labels = viterbi(emit, model.move)
        start = None
        for (s, e), label in zip([*spans, (0, 0)], [*labels, OUTSIDE], strict=True):
            if start is not None and label != INSIDE:
                added.append((start, len(BASE), end))
                start = None
            if label == BEGIN or (label == INSIDE and start is None):
                start = s
            end = e
    return sorted(base + _apart(added, base))


def _apart(added: list[tuple[int, int, int]], base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The added spans, in order, that overlap no base span: both are walked once.  The base
    spans' ends need not ascend, so the furthest end so far counts."""
    out, at, reach = [], 0, 0
    for x in added:
        while at < len(base) and base[at][0] < x[2]:
            reach = max(reach, base[at][2])
            at += 1
        if reach <= x[0]:
            out.append(x)
    return out


def span_text(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def scan_documents(docs: DataFrame, model: SimpleNamespace | None) -> DataFrame:
    """doc_id, counts of the base kinds, base_sha256, spans, n_crf for each row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[str, int] = {}
        for batch in text_slices(batches, "text"):
            rows = [scan(t, shared.value, memo) for t in texts(batch)]
            counts = [Counter(kind for _, kind, _ in r) for r in rows]
            base = [span_text([x for x in r if x[1] < len(BASE)]) for r in rows]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    *[pa.array([c[k] for c in counts], pa.int64()) for k in range(len(BASE))],
                    pa.array([sha256(b.encode()).hexdigest() for b in base], pa.string()),
                    pa.array([span_text(r) for r in rows], pa.string()),
                    pa.array([c[len(BASE)] for c in counts], pa.int64()),
                ],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_crf"],
            )

    schema = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_crf long"
    return id_text(docs).mapInArrow(run, schema)


def secrets(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """op4."""
    return scan_documents(docs, train(docs))
