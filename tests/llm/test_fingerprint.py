from hashlib import sha256

from pyspark.sql import functions as F

from threatlens.llm import fingerprint as P


def collected(df):
    return [r.asDict() for r in P.document_fingerprints(df).collect()]


def test_edited_texts_equal_brute_force(docs, pairs):
    rows = sorted(((i, t or "") for i, t in pairs))
    want = []
    for (i, t), (_, after) in zip(rows, rows[1:] + rows[:1], strict=True):
        half = len(t) // 2
        want.append((i, len(t), sha256((t[: len(t) - half] + after[:half]).encode()).hexdigest()))
    assert sorted((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in collected(docs)) == sorted(want)


def test_equal_texts_have_equal_fingerprints(docs, pairs):
    of = {}
    text = dict(pairs)
    for r in collected(docs):
        of.setdefault(text[r["doc_id"]] or "", set()).add(r["fingerprint"])
    assert all(len(x) == 1 for x in of.values())
    assert len({next(iter(x)) for x in of.values()}) == len(of)


def test_likeness(docs):
    rows = collected(docs)
    assert all(0.0 <= r[c] <= 1.0 for r in rows for c in ("near_edited", "near_next"))
    long = [r for r in rows if r["n_chars"] > 300]
    assert sum(r["near_edited"] for r in long) / len(long) > sum(r["near_next"] for r in long) / len(long) + 0.2


def test_order_of_paragraphs_insertion_and_deletion(frame):
    df = frame([(1, "one two\nthree\nthree"), (2, "three\none two\nthree"), (3, "one two\nthree"), (4, "three")])
    rows = {r["doc_id"]: r["lanes"] for r in P.with_lanes(df.select("doc_id", "text"), "text", "lanes").collect()}
    assert rows[1] == rows[2] != rows[3]
    pair = P.with_lanes(df.filter("doc_id in (1, 3, 4)").select("doc_id", "text"), "text", "lanes").groupBy().pivot("doc_id", [1, 3, 4]).agg(F.first("lanes"))
    out = pair.select(P.insert(F.col("3"), F.col("4")).alias("plus"), P.delete(F.col("1"), F.col("4")).alias("minus")).first()
    assert out["plus"] == rows[1] and out["minus"] == rows[3]


def test_small_tables(frame):
    one = collected(frame([(1, "abcd")]))
    assert [(r["edited_sha256"], r["near_next"]) for r in one] == [(sha256(b"abab").hexdigest(), 1.0)]
    assert collected(frame([(1, "a")]).filter("doc_id > 1")) == []
    null = collected(frame([(None, None), (None, "xy"), (3, "q")]))
    assert sorted((r["n_chars"], r["edited_sha256"]) for r in null) == sorted(
        [(0, sha256(b"").hexdigest()), (2, sha256(b"xq").hexdigest()), (1, sha256(b"q").hexdigest())]
    )
