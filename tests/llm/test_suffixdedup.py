from collections import defaultdict
from hashlib import sha256

import numpy as np

from threatlens.llm import suffixdedup as S


def brute(rows):
    raw = [(i, (t or "").encode()) for i, t in rows]
    first = {}
    for i, b in raw:
        if i is None:
            continue
        for p in range(len(b) - S.LENGTH + 1):
            w = b[p : p + S.LENGTH]
            first[w] = min(i, first.get(w, i))
    out = []
    for i, b in raw:
        gone = np.zeros(len(b), dtype=bool)
        for p in range(len(b) - S.LENGTH + 1):
            if i is not None and first[b[p : p + S.LENGTH]] < i:
                gone[p : p + S.LENGTH] = True
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        rest = np.frombuffer(b, dtype=np.uint8)[~gone].tobytes()
        out.append((i, len(b), int(gone.sum()), spans, sha256(rest).hexdigest()))
    return out


def result(df):
    return [tuple(r) for r in S.remove_repeats(df).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()]


key = lambda r: tuple((x is not None, x) for x in r)


def test_equals_brute_force(docs, pairs):
    want = brute(pairs)
    assert sum(r[2] > 0 for r in want) > 20
    assert sorted(result(docs), key=key) == sorted(want, key=key)


def test_ties_nulls_and_short_texts(frame):
    same = "x" * 60 + "the very same passage of some sixty bytes stands in both of them"
    rows = [(5, same), (5, "before " + same), (None, same), (7, same[10:]), (8, "q" * 49), (9, "q" * 49), (10, "ab" * 400), (11, "ab" * 30 + "c")]
    assert sorted(result(frame(rows)), key=key) == sorted(brute(rows), key=key)


def test_many_batches_and_shards(frame, more_docs, monkeypatch):

    monkeypatch.setattr(S, "BATCH_BYTES", 1 << 11)
    monkeypatch.setattr(S, "SHARD_BYTES", 1 << 11)
    rows = more_docs
    assert sorted(result(frame(rows)), key=key) == sorted(brute(rows), key=key)


def test_empty_table(frame):
    assert result(frame([(1, "a")]).filter("doc_id > 1")) == []


def test_mergesort_orders_suffixes_and_verifies_equals():
    rng = np.random.default_rng(5)
    data = rng.integers(97, 99, 4000).astype(np.uint8)
    data[2000:3000] = data[500:1500]
    start = np.arange(len(data) - S.LENGTH)
    bucket = (start % 3).astype(np.uint64)
    order, same = S.suffix_mergesort(S.PrefixHashes(data), start, bucket)
    text = data.tobytes()
    rows = [(int(bucket[i]), text[start[i] : start[i] + S.LENGTH]) for i in order]
    assert rows == sorted(rows)
    assert [bool(x) for x in same] == [k > 0 and rows[k] == rows[k - 1] for k in range(len(rows))]


def test_runs_cover_each_start_once_and_agree_on_anchors():
    rng = np.random.default_rng(1)
    texts = [rng.integers(97, 101, n).astype(np.uint8).tobytes() for n in (49, 50, 51, 700, 3000)]
    texts.append(texts[3][100:600])
    r = S.runs(texts)
    starts = defaultdict(list)
    anchors = {}
    for t, s, c, rel, k in zip(*[r[x].tolist() for x in ("text", "start", "count", "rel", "key")], strict=True):
        starts[t] += range(s, s + c)
        for j in range(c):
            w = texts[t][s + j : s + j + S.LENGTH]
            assert anchors.setdefault(w, (k, rel - j)) == (k, rel - j)
    assert {t: sorted(x) for t, x in starts.items()} == {t: list(range(len(x) - S.LENGTH + 1)) for t, x in enumerate(texts) if len(x) >= S.LENGTH}


def test_packed_keys_round_trip():
    for keys in ([], [5], [1, 2, 1 << 40], [0, 1 << 33, 1 << 62]):
        k = np.array(keys, dtype=np.uint64)
        assert (S._unpack(S._pack(k)) == k).all()


def test_only_different_strings_of_several_documents_are_sorted(monkeypatch):
    """Many copies of a few strings in one bucket, and many strings that one document has alone."""
    rng = np.random.default_rng(3)
    texts = [rng.integers(97, 123, S.LENGTH).astype(np.uint8).tobytes() for _ in range(40)]
    strings = [(t, d) for t in texts[:5] for d in range(30)] + [(t, 100 + i) for i, t in enumerate(texts[5:])]
    sorted_ = []
    inner = S._sorted_strings
    monkeypatch.setattr(S, "_sorted_strings", lambda h, start, bucket: sorted_.append(len(start)) or inner(h, start, bucket))
    n = len(strings)
    mail = S._messages(
        [
            {
                "to": 0, "sender": 1, "kind": S.COVERED, "ids": np.concatenate([np.arange(n), [d for _, d in strings]]).astype(np.int64).tobytes(),
                "keys": np.full(n, 7, dtype=np.uint64).tobytes(), "sizes": np.array([1] * n + [0] * n, dtype=np.uint8).tobytes(),
                "data": b"".join(t for t, _ in strings),
            }
        ]
    )
    out = S._sort([S.pa.scalar(0)], mail).to_pylist()
    assert sorted(np.frombuffer(out[0]["ids"], dtype=np.int64).tolist()) == [i for i, (_, d) in enumerate(strings) if 0 < d < 100]
    assert sorted_ == [5]
