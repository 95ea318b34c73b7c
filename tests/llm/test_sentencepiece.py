import random

import numpy as np
import pytest

from threatlens.llm import sentencepiece as S


def whole_viterbi(chars, v):
    """The best segmentation over the whole text, all backpointers kept."""
    score, back = [0.0], [0]
    for end in range(1, len(chars) + 1):
        best, start_of = score[end - 1] + v.fallback_score, end - 1
        for start in range(max(0, end - v.longest), end):
            known = v.ids.get(chars[start:end])
            if known is not None and score[start] + known[1] > best:
                best, start_of = score[start] + known[1], start
        score.append(best)
        back.append(start_of)
    out, end = [], len(chars)
    while end:
        piece = chars[back[end] : end]
        out.append([v.ids[piece][0]] if piece in v.ids else [v.byte_ids[b] for b in piece.replace(S._OWN_META, S.META).encode()])
        end = back[end]
    return [i for ids in reversed(out) for i in ids]


@pytest.fixture(scope="module")
def toy():
    """A vocabulary whose pieces cross blanks, so that the stream sees the whole text."""
    rng = random.Random(3)
    pieces, ids = [f"<0x{b:02X}>" for b in range(256)], {}
    words = {"".join(rng.choice("ab" + S.META) for _ in range(rng.randint(1, 6))) for _ in range(60)} | {"a", "b", S.META, "b" + S.META + "a"}
    for w in sorted(words):
        ids[w] = (len(pieces), -rng.random() * 9)
        pieces.append(w)
    return S.vocabulary(pieces, ids, list(range(256)))


@pytest.fixture(scope="module")
def model():
    return S.load_vocabulary()


def test_stream_equals_whole_search_with_a_short_window(toy):
    assert not toy.by_word
    rng = random.Random(4)
    matcher = S.matcher(toy)
    for n in (0, 1, 5, 40, 400, 3000):
        chars = "".join(rng.choice("aab c".replace(" ", S.META)) for _ in range(n))
        commits = list(S.viterbi_stream(chars, toy, matcher))
        assert [i for ids in commits for i in ids] == whole_viterbi(chars, toy)
        assert n < 400 or max(map(len, commits)) < n / 2  # committed on the way


def test_words_side_by_side_equal_the_stream(model):
    rng = random.Random(5)
    words = [S.META + "".join(rng.choice("aeinrstTüé7.%\n漢") for _ in range(rng.randint(0, 50))) for _ in range(400)]
    encoder = S.Encoder(model)
    packed = S.encode_words(words, model, encoder.table, encoder.automaton)
    assert [np.frombuffer(p, dtype=np.int32).tolist() for p in packed] == [whole_viterbi(w, model) for w in words]


def test_round_trip(model, pairs):
    texts = [t or "" for _, t in pairs] + ["  two  spaces ", "▁▁ meta▁", "tab\tnew\nline\r\x00", "日本語 😀", " ", "\n"]
    ids = S.Encoder(model).encode(texts)
    assert [S.decode(i, model) for i in ids] == texts


def test_query(spark, docs, pairs):
    out = S.encode_documents(docs)
    rows = out.collect()
    assert len(rows) == len(pairs) and all(r["round_trip"] for r in rows)
    assert all(r["n_ids"] == len(r["ids"]) for r in rows)
    text = {r["doc_id"]: r["text"] for r in S.decode_documents(out).collect()}
    assert text == {i: t or "" for i, t in pairs}
    assert S.encode_documents(docs.filter("doc_id < 0")).collect() == []
