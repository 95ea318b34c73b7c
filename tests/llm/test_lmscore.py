import math
import random
from collections import Counter

import pytest

from threatlens.llm import lmscore as M


def brute(rows, good):
    texts = [(i, (t or "").lower().split()) for i, t in rows]
    grams = [Counter(w for pair in zip(["<s>", *ws[:-1]], ws, strict=False) for w in (pair, pair[0])) for _, ws in texts]
    vocabulary = len({w for _, ws in texts for w in ws})
    total = sum(grams, Counter())
    target = sum((g for (i, _), g in zip(texts, grams, strict=True) if i in good), Counter())
    out = {}
    for (i, ws), own in zip(texts, grams, strict=True):
        loss = []
        for model in (target if i not in good else target - own, total - own):
            loss.append(
                sum(
                    math.log(model[h] + M.ALPHA * vocabulary) - math.log(model[(h, w)] + M.ALPHA)
                    for h, w in zip(["<s>", *ws[:-1]], ws, strict=False)
                )
                / max(len(ws), 1)
            )
        out[i] = (len(ws), *loss)
    return out


@pytest.fixture(scope="module")
def corpus(spark, frame, more_docs):
    rng = random.Random(1)
    rows = more_docs + [(2000, None), (2001, ""), (2002, " \n "), (2003, "only"), (2004, "gate " * 3000)]
    good = {i for i, _ in more_docs if rng.random() < 0.4}
    labels = [(i, int(i in good), 0) for i, _ in more_docs if i % 2 == 0 or i in good] + [(2003, 1, 1), (None, 1, 0), (6, None, None)]
    labels += [(next(iter(good)), 0, 0)]
    return frame(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), rows, good


def test_equals_brute_force(corpus):
    docs, labels, rows, good = corpus
    want = brute(rows, good)
    out = M.cross_entropy_difference(docs, labels).collect()
    assert len(out) == len(rows)
    for r in out:
        n, target, background = want[r["doc_id"]]
        assert r["n_tokens"] == n
        assert r["target_loss"] == pytest.approx(target) and r["background_loss"] == pytest.approx(background)
        assert r["score"] == pytest.approx(target - background, abs=1e-9)


def test_slices_and_shards_change_nothing(corpus, monkeypatch):
    docs, labels, rows, good = corpus
    monkeypatch.setattr(M, "SLICE", 3000)
    monkeypatch.setattr(M, "SHARD_BYTES", 1000)
    want = brute(rows, good)
    for r in M.cross_entropy_difference(docs.repartition(7), labels).collect():
        assert r["target_loss"] == pytest.approx(want[r["doc_id"]][1])


def test_edge_cases(spark, frame, corpus):
    labels = corpus[1]
    out = M.cross_entropy_difference(frame([(None, "a b"), (None, "c"), (1, "a b"), (1, "a b")]), labels).collect()
    assert sorted((r["doc_id"] is None, r["n_tokens"]) for r in out) == [(False, 4), (True, 1), (True, 2)]
    assert M.cross_entropy_difference(frame([(1, "a")]).filter("doc_id > 1"), labels).collect() == []
    assert M.cross_entropy_difference(frame([(1, "a b")]), labels.filter("doc_id < 0")).count() == 1


def test_vocabulary_sketch(frame, monkeypatch):
    df = frame([(i, " ".join(f"w{j}" for j in range(i, i + 40))) for i in range(500)])
    assert M.vocabulary_size(df) == 539
    monkeypatch.setattr(M, "SKETCH", 128)
    assert abs(M.vocabulary_size(df) - 539) < 150


def test_no_row_is_lost_and_vocabulary_is_exact(spark, frame):
    spaces = [chr(c) for c in range(0x3001) if chr(c).isspace() or not chr(c).split()]
    rows = [(i, f"{c}{c} {c}") for i, c in enumerate(spaces)] + [(500, "a few words"), (501, "a\u200b"), (502, "\u200b"), (503, "\x1b")]
    labels = spark.createDataFrame([(500, 1, 0)], "doc_id long, quality int, toxic int")
    out = {r["doc_id"]: r["n_tokens"] for r in M.cross_entropy_difference(frame(rows), labels).collect()}
    assert out == {**{i: 0 for i in range(len(spaces))}, 500: 3, 501: 1, 502: 1, 503: 1}
    many = frame([(i, " ".join(f"w{k}" for k in range(i * 9000, i * 9000 + 10000))) for i in range(9)])
    assert M.vocabulary_size(many) == 82000


def test_messages_follow_the_different_ngrams_and_not_the_documents():
    """Many documents of the same words and many shards: a few bytes for each n-gram, one row a document back."""
    rng = random.Random(4)
    words = [f"w{k}" for k in range(60)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(200))) for i in range(300)]
    good = {i for i, _ in rows if i % 3 == 0}
    bits, shards = 44, 40
    docs = M.pa.table({"key_id": [i for i, _ in rows], "uid": [0] * 300, "good": [i in good for i, _ in rows], "text": [t for _, t in rows]})
    asked = M._ask(shards, bits)([M.pa.scalar(5)], docs)
    kinds = len(M.Batch(docs, bits).keys)
    size = sum(len(r[c]) for r in asked.to_pylist() for c in ("keys", "own", "liked"))
    assert kinds <= 60 * 61 + 61 and asked.num_rows == shards and size <= 12 * kinds + 20 * shards
    mail = M.pa.concat_tables([M._answer([M.pa.scalar(r["to"])], M.pa.Table.from_pylist([r], schema=M._FIELDS)) for r in reversed(asked.to_pylist())])
    out = M._losses(60.0, bits)([M.pa.scalar(5)], docs, mail).to_pylist()
    assert len(out) == len(rows)
    want = brute(rows, good)
    for r in out:
        n, target, background = want[r["doc_id"]]
        assert r["n"] == n and r["target"] / n == pytest.approx(target) and r["background"] / n == pytest.approx(background)


def test_sums_of_any_size_are_packed():
    import numpy as np

    for most in (0, 255, 256, 1 << 20, 1 << 33):
        x = np.array([0, most], dtype=np.int64)
        assert M._large(M._small(x)).tolist() == [0, most]
