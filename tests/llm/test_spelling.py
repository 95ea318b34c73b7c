import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from threatlens.llm import spelling

COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def brute(rows, min_length=6, min_count=5, ratio=5, every=199):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    v = {w: n for w, n in counts.items() if len(w) >= min_length and n >= min_count}
    letters = sorted({c for w in v for c in w})
    near = {}
    for w in v:
        edits = {w[:i] + w[i + 1 :] for i in range(len(w))}
        edits |= {w[:i] + c + w[i + 1 :] for i in range(len(w)) for c in letters}
        edits |= {w[:i] + c + w[i:] for i in range(len(w) + 1) for c in letters}
        near[w] = (edits - {w}) & set(v)
    form = {}
    for w, n in v.items():
        if near[w]:
            best = min(near[w], key=lambda x: (-v[x], x))
            if v[best] >= ratio * n:
                form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {(w, form.get(w), root(w), n, len(near[w]), v[form[w]] if w in form else None) for w, n in v.items()}


def result(df):
    assert df.columns == COLUMNS
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


ROWS = [
    (1, "banana " * 700 + "Banana bananaa " * 40 + "bananaaa " * 4),
    (2, "bananá " * 30 + "bÀnana " * 6 + "bànana " * 7 + "baœnana naïveté naïvete×"),
    (3, None),
    (4, ""),
    (5, "short word here " * 50 + "bananaaa " * 3),
    (None, "bonana " * 5 + "bonona " * 5 + "12bonana34 " + "binana\n" * 5 + "banana"),
    (6, "aaaaaaa " * 9 + "aaaaaa " * 60 + "aaaaaaaa " * 5 + "ÿÿÿÿÿÿ ÿÿÿÿÿÿÿ " * 6),
    (6, "aaaaaaa " * 9 + "x" * 4000 + " " + "x" * 3999 + "y"),
    (7, ("x" * 4000 + " ") * 5 + ("x" * 3999 + "y ") * 30),
]


def test_hand_made_words(frame):
    want = brute(ROWS)
    got = result(spelling.spelling_variants(frame(ROWS).repartition(3)))
    assert got == want
    forms = {r[0]: r[1:3] for r in got}
    assert forms["bananaaa"] == ("bananaa", "banana")  # a chain of two links
    assert forms["x" * 4000][0] == "x" * 3999 + "y"


@pytest.mark.parametrize("every", [2, 3])
def test_equals_brute_force(frame, pairs, more_docs, every):
    rows = [(i, " ".join(w + w for w in (t or "").split()) if i != 1001 else None) for i, t in pairs + more_docs]
    want = brute(rows, 4, 2, 2, every)
    assert len(want) > 100 and any(r[1] for r in want)
    assert result(spelling.spelling_variants(frame(rows).repartition(4), 4, 2, 2, every)) == want


def test_shards_in_several_passes(frame, more_docs):
    rows = [(i, " ".join(w + w for w in t.split())) for i, t in more_docs]
    whole = result(spelling.spelling_variants(frame(rows), 4, 2, 2, 3))
    assert result(spelling.spelling_variants(frame(rows), 4, 2, 2, 3, broadcast_bytes=100, shard_words=7)) == whole == brute(rows, 4, 2, 2, 3)


def test_no_words(spark, frame):
    for rows in ([], [(1, None), (2, ""), (None, "12 %$ 中文")], [(1, "lonely words here")]):
        assert result(spelling.spelling_variants(frame(rows) if rows else frame([(0, "")]).filter("false"))) == set()


def test_bloom_filter_holds_all_and_little_else():
    rng = np.random.default_rng(1)
    hashes, other = (rng.integers(0, 1 << 64, n, dtype=np.uint64) for n in (5000, 20000))
    cells = spelling.bloom_filter(hashes)
    assert len(cells) * 64 <= 5000 * spelling.BITS_PER_WORD + spelling.BLOCK_BITS
    assert len(spelling.bloom_holds(cells, spelling._mix(hashes))) == 5000
    assert len(spelling.bloom_holds(cells, spelling._mix(other))) < 400


def test_sql_gives_the_same(spark):
    import duckdb

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    con = duckdb.connect()
    con.sql("create view documents as select * from '/root/testdata/sf0.001/documents.parquet'")
    want = con.sql(spelling.SQL).fetchall()
    assert result(spelling.spelling_groups(spark, docs)) == set(want) and len(set(want)) == len(want) > 0
