import itertools
import random
import re
from hashlib import sha256

import numpy as np
import pytest

from threatlens.llm import secrets as X


def brute(text):
    """The base spans, character by character from the left."""
    out = []
    for kind, pattern, least, group in (
        ("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?[ ]*[:=][ ]*["']?([A-Za-z0-9+/_.=-]+)""", 8, 1),
        ("access", r"AKIA([A-Z0-9]+)", 12, 1),
        ("hex", r"([0-9a-f]+)", 32, 1),
    ):
        at = 0
        while at < len(text):
            m = re.compile(pattern, re.A).match(text, at)
            if m is None:
                at += 1
                continue
            if len(m[group]) >= least:
                out.append((m.start(), kind, m.end()))
            at = m.end()
    order = ["assign", "access", "hex"]
    return sorted(out, key=lambda s: (s[0], order.index(s[1])))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrst") for _ in range(rng.randint(2, 8)))
    code = lambda n, a="0123456789abcdef": "".join(rng.choice(a) for _ in range(n))
    make = [
        lambda: f'token = "{code(40)}"',
        lambda: f"PassWord: {code(12, 'abcXYZ019+/_')}",
        lambda: f"api_key={code(20)} APIKEY='{code(7)}'",
        lambda: f"AKIA{code(16, 'ABCXYZ0189')}",
        lambda: code(40),
        lambda: f"call +1 (603) 555-{rng.randint(1000, 9999)} or {rng.randint(1, 255)}.194.127.198",
        lambda: f"{word()}.{rng.randint(1, 99)}@mail3.example.com, {rng.randint(10**15, 10**16 - 1)}",
        lambda: "the token of the secret password is lost",
    ]
    out = []
    for i in range(300):
        parts = [" ".join(word() for _ in range(rng.randint(3, 30)))]
        if i % 2:
            parts += [rng.choice(make)(), " ".join(word() for _ in range(10))]
        out.append((i, " ".join(parts)))
    out += [(900, None), (901, ""), (902, "é" * 50 + ' toKen="' + "ab1" * 9 + '"'), (903, "paſſword=abcdefgh1"), (904, "f" * 100_000), (905, "token=short"), (906, "1 " * 5000), (None, "secret: " + "q1" * 8), out[1]]
    return out


def test_base_spans_equal_brute_force(rows):
    for _, text in rows:
        if len(text or "") < 50_000:
            assert [(s, X.KINDS[k], e) for s, k, e in X.base_spans(text or "")] == brute(text or "")


def test_query(spark, frame, rows):
    docs = frame(rows)
    out = X.secrets(spark, docs).collect()
    assert len(out) == len(rows)
    text = dict(rows)
    crf = 0
    for r in out:
        t = text[r["doc_id"]] or ""
        spans = [(int(s), k, int(e)) for k, s, e in (x.split(":") for x in r["spans"].split(",") if x)]
        base = [x for x in spans if x[1] != X.CRF]
        if len(t) < 50_000:
            assert base == brute(t)
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(x[1] == k for x in base) for k in ("assign", "access", "hex"))
        assert r["base_sha256"] == sha256(",".join(f"{k}:{s}:{e}" for s, k, e in base).encode()).hexdigest()
        assert spans == sorted(spans, key=lambda x: (x[0], X.KINDS.index(x[1])))
        crf += sum(x[1] == X.CRF for x in spans)
    assert crf < len(rows) / 10  # it leaves ordinary numbers and addresses alone


def test_crf_finds_a_secret_that_the_patterns_miss(spark, frame, rows):
    model = X.train(frame(rows))
    text = 'the words before token "' + "9f3ac07d51b2e8d4a6c1" + '" and the words after'
    assert X.base_spans(text) == []
    (start, kind, end), = X.scan(text, model, {})
    assert X.KINDS[kind] == X.CRF and "9f3ac07d51b2e8d4a6c1" in text[start:end]
    plain = "they met on 12.05.2021 at 10:30 in room 17, floor 3 (see page 1024)"
    assert X.scan(plain, model, {}) == []


def test_viterbi_equals_enumeration():
    rng = np.random.default_rng(3)
    for n in (1, 2, 5):
        emit, move = rng.normal(size=(n, 3)), rng.normal(size=(3, 3))

        def score(y):
            z = [X.OUTSIDE, *y, X.OUTSIDE]
            return sum(emit[i, c] for i, c in enumerate(y)) + sum(move[a, b] for a, b in zip(z, z[1:], strict=False))

        assert tuple(X.viterbi(emit, move)) == max(itertools.product(range(3), repeat=n), key=score)


def test_gradient_fits_the_training_labels():
    examples = [([[1, 7], [2, 8], [3, 9]], [0, 1, 2]), ([[4, 7], [3, 8]], [2, 2])] * 20
    model = X.fit(examples, X.CrfRules(epochs=100))
    for f, y in examples[:2]:
        assert X.viterbi(model.emit[np.array(f)].sum(axis=1), model.move) == y


def test_nothing_to_learn_from(spark, frame):
    out = X.secrets(spark, frame([(1, "plain words only"), (2, None)])).collect()
    assert [r["spans"] for r in out] == ["", ""]
    assert X.secrets(spark, frame([(1, "a")]).filter("doc_id > 1")).collect() == []


def test_spans_apart_equal_all_pairs():
    rng = random.Random(2)
    for _ in range(300):
        spans = lambda: sorted((s, rng.randrange(3), s + rng.randint(1, 12)) for s in (rng.randrange(80) for _ in range(rng.randint(0, 8))))
        added, base = [], spans()
        for x in spans():
            if not added or x[0] >= added[-1][2]:
                added.append(x)
        assert X._apart(added, base) == [x for x in added if not any(x[0] < b[2] and x[2] > b[0] for b in base)]


def test_long_texts_take_linear_time(spark, frame, rows):
    """Many stretches and base spans in one text: four times the text, some four times the time."""
    import time

    model = X.train(frame(rows))
    line = "the words of line password=hunter12345 and id 9f3ac07d51b2 by host-12 of 10.0.0.1\n"
    took = []
    for n in (2_500, 10_000):
        began = time.process_time()
        assert len([x for x in X.scan(line * n, model, {}) if x[1] == 0]) == n
        took.append(time.process_time() - began)
    assert took[1] < 8 * took[0]


def test_a_secret_word_in_a_long_chunk_counts(spark):
    chunk = '{"a":"' + "x" * 400 + '","password":'
    (spans, _), = X.stretches(f"plain words {chunk} hunter two")
    assert spans[-1][1] == len(f"plain words {chunk} hunter two")  # the words after it are looked at


def test_rare_secrets_still_teach(spark, frame):
    rng = random.Random(5)
    rows = [(i, f"plain words of text number {i} and {rng.random()}") for i in range(4000)]
    rows[777] = (777, 'config: token = "9f3ac07d51b2e8d4a6c1" end')
    assert X.train(frame(rows), X.CrfRules(max_docs=5)) is not None
