import hashlib
import random
import re
import time

import numpy as np
import pytest

from threatlens.llm import pii

COLUMNS = ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(d) * (1 + k % 2) for k, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def brute_base(text):
    out = []
    for no, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or "", re.ASCII):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": lambda: True,
                "ip": lambda: all(int(x) <= 255 for x in m[0].split(".")),
                "card": lambda: 14 <= len(digits) <= 19 and luhn(digits),
                "phone": lambda: 10 <= len(digits) <= 15,
            }[kind]()
            if good:
                out.append((m.start(), no, m.end()))
    return [f"{pii.KINDS[no]}:{a}:{b}" for a, no, b in sorted(out)]


def check(df, rows):
    """The counts and digests are those of the plain patterns; spans hold all base spans. Returns the added ones."""
    assert df.columns == COLUMNS
    got = sorted((tuple(r) for r in df.collect()), key=repr)
    want = []
    for doc_id, text in rows:
        base = brute_base(text)
        counts = [sum(b.startswith(k) for b in base) for k in pii.KINDS]
        want.append(((doc_id, *counts, hashlib.sha256(",".join(base).encode()).hexdigest()), base))
    assert sorted((w for w, _ in want), key=repr) == sorted((r[:-1] for r in got), key=repr)
    bases = {w: set(b) for w, b in want}
    texts = {}
    for doc_id, text in rows:
        texts.setdefault(doc_id, []).append(text or "")
    added = []
    for r in got:
        spans = r[-1].split(",") if r[-1] else []
        keys = [(int(s.split(":")[1]), pii.KINDS.index(s.split(":")[0])) for s in spans]
        assert keys == sorted(keys) and len(set(spans)) == len(spans) and bases[r[:-1]] <= set(spans)
        for s in set(spans) - bases[r[:-1]]:
            kind, a, b = s.split(":")
            added.append((r[0], kind, [t[int(a) : int(b)] for t in texts[r[0]]]))
            assert not any(int(x.split(":")[1]) < int(b) and int(a) < int(x.split(":")[2]) for x in bases[r[:-1]])
    return added


def test_hand_made_spans(frame):
    rows = [
        (1, "Mail a.b+c@x-y.co.uk, d@e.f_g@h.i.j and k@l, @m.n o@p.q.@r.s t@u.v@w.x"),
        (2, "1.2.3.4 256.1.1.1 1.2.3.4.5.6.7.8 01.002.0003.255 1.2.3. 99999999999999999999.1.1.1"),
        (3, "4111 1111 1111 1111, 4111-1111-1111-1112, 4111  1111 1111 1111, 378282246310005 6 4 4111111111111111 4111111111111111"),
        (4, "+1 (017) 555-7713 +123 +1-----2 ++44 20 7946 0958. +1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 +49(0)30.12345-67 8"),
        (5, None),
        (6, ""),
        (None, "nul@l.id 😀 10.0.0.1 é +1 (017) 555-7713"),
        (7, "😀😀 x@y.z"),
        (7, "😀😀 x@y.z"),
    ]
    check(pii.personal_data(None, frame(rows).repartition(3)), rows)


def test_random_texts(frame):
    rng = random.Random(4)
    pieces = ["a", "b.c", "@", ".", "1", "22", "255", "256", "+", "+1", " ", "  ", "-", "(", ")", "_", "%", "é", "😀", "\n", "4111111111111111", "4111 1111 1111 1111", "x@y.zz", "1.2.3.4", "+1 (017) 555-7713"]
    rows = [(i, "".join(rng.choice(pieces) for _ in range(rng.randint(0, 60)))) for i in range(600)]
    rows += [(1000 + i, "".join(rng.choice("1234567890 -.+@a") for _ in range(60))) for i in range(600)]
    check(pii.personal_data(None, frame(rows).repartition(4)), rows)


def test_no_documents_and_no_candidates(frame):
    assert pii.personal_data(None, frame([(1, "x")]).filter("false")).collect() == []
    assert check(pii.personal_data(None, frame([(1, "x"), (2, None)])), [(1, "x"), (2, None)]) == []


def test_long_texts_take_linear_time(frame):
    n = 400_000
    rows = [(1, "a" * n), (2, "1" * n), (3, "+" + " " * n), (4, "+1" * n), (5, "a@" * n), (6, "1." * n), (7, "a@b" + ".c" * n), (8, "1 " * n), (9, "1.2.3.4 " * 50_000), (10, "(at" * n)]
    began = time.time()
    got = {r[0]: r for r in pii.personal_data(None, frame(rows).repartition(4)).collect()}
    assert time.time() - began < 100
    assert got[9][2] == 50_000 and got[7][1] == 1 and got[6][2] == n // 4


def test_wider_patterns_are_learned(frame):
    """Other spellings of the same data are added; look-alikes that most labelers reject are not."""
    rng = random.Random(8)
    rows = []
    for i in range(150):
        card = next(c for c in iter(lambda: "4" + "".join(rng.choice("0123456789") for _ in range(15)), "") if luhn(c))
        spaced = " ".join(card[k : k + 4] for k in range(0, 16, 4))
        bad = card[:-1] + str((int(card[-1]) + 1) % 10)
        rows.append((10 * i, f"Contact: user{i}@mail.example.com or call +1 (415) 555-{1000 + i} from 10.1.2.{i}."))
        rows.append((10 * i + 1, f"Card {spaced}; order 8{bad[1:]} of version 300.400.{i}.2 x{bad}y"))
        if i % 10 == 0:
            rows.append((10 * i + 2, f"Pay by card {'/'.join(spaced.split())} or write to user{i} [at] example [dot] org"))
            rows.append((10 * i + 3, f"Serial {'/'.join((bad[:4], bad[4:8], bad[8:12], bad[12:]))}, host 10[.]1[.]2[.]{i} is the server"))
    added = check(pii.personal_data(None, frame(rows)), rows)
    found = {(d % 10, kind) for d, kind, _ in added}
    assert {(2, "card"), (2, "email"), (3, "ip")} <= found
    assert not any(d % 10 == 3 and kind == "card" for d, kind, _ in added)
    assert not any(d % 10 == 1 for d, _, _ in added)


def test_label_model_finds_reliabilities():
    """Votes drawn from known reliabilities: the estimates are near them."""
    rng = np.random.default_rng(2)
    right, n = [0.95, 0.9, 0.8, 0.7, 0.6, 0.55], 40_000
    truth = rng.random(n) < 0.3
    votes = np.stack([np.where(rng.random(n) < p, truth, ~truth) for p in right], axis=1) * 2 - 1
    counts = {}
    for v in map(tuple, votes.tolist()):
        counts[v] = counts.get(v, 0) + 1
    posterior, table, share = pii.estimate(counts, pii.Fit())
    assert abs(share - 0.3) < 0.02
    for k, p in enumerate(right):
        assert abs(table[k, 1, 2] - p) < 0.03 and abs(table[k, 0, 0] - p) < 0.03
    called = np.array([posterior[v] > 0.5 for v in map(tuple, votes.tolist())])
    assert (called == truth).mean() > 0.96


def test_logistic_weights():
    rows = [(0, 1000, 10.0), (1, 1000, 990.0), (2, 1000, 12.0), (3, 1000, 988.0)]
    w = pii.logistic(rows, pii.Fit())
    assert w[0] > 4 and abs(w[1]) < 1 and w[-1] < -3


def test_clashing_columns_are_ignored(spark):
    docs = spark.createDataFrame([(1, "x@y.zz", 5, "a", 2)], "doc_id long, text string, uid long, kind string, start long")
    assert [r["spans"] for r in pii.personal_data(spark, docs).collect()] == ["email:0:6"]


@pytest.mark.parametrize("value,want", [("4111111111111111", True), ("4111111111111112", False), ("0", True), ("79927398713", True)])
def test_luhn_column(spark, value, want):
    from pyspark.sql import functions as F

    assert spark.range(1).select(pii._luhn(F.lit(value))).first()[0] is want
