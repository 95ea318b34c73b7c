import random
import re
from collections import Counter, defaultdict

import numpy as np

from threatlens.llm import divergence

SCHEMA = "text string, lang string, source string, doc_id long, n long, rank string, chunk double"


def frame_of(spark, rows):
    return spark.createDataFrame([(t, lang, s, i, 1, "r", 0.5) for i, (t, lang, s) in enumerate(rows)], SCHEMA)


def brute(rows, min_docs=30, top=50):
    docs, counts, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        terms = [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
        docs[lang].update(set(terms))
        counts[lang, source].update(terms)
        groups[lang].add(source)
    out = set()
    for lang, sources in groups.items():
        kept = sorted(t for t, n in docs[lang].items() if n >= min_docs)
        whole = sum((counts[lang, s] for s in sources), Counter())
        p = lambda c: {t: 1 + 10**9 * (c[t] + 5) // (sum(c[x] for x in kept) + 5 * len(kept)) for t in kept}
        shares, q = {s: p(counts[lang, s]) for s in sources}, p(whole)
        for s in sources:
            far = [(sum(abs(shares[s][t] - shares[o][t]) for t in kept), o) for o in sources - {s}]
            loud = [(shares[s][t] - q[t], t) for t in kept if counts[lang, s][t] and shares[s][t] > q[t]]
            for part, found, most in (("pair", far, len(far)), ("term", loud, top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out |= {(lang, s, part, item, value, k) for k, (value, item) in enumerate(found[:most], 1)}
    return out


def result(df):
    assert df.columns == ["lang", "source", "part", "item", "value", "rank"]
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def make_rows(seed=5, n=400):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdéß中") for _ in range(rng.randint(1, 4))) for _ in range(150)]
    rows = []
    for i in range(n):
        k = rng.choice([0, 1, 1, 2, 5])
        text = " ".join(rng.choice(words[10 * k : 10 * k + 70]) for _ in range(rng.randint(0, 60)))
        rows.append((text.title() if i % 3 else text.replace(" ", "-1_"), rng.choice(["en", "en", "en", "de", None]), "src%d" % (k * 7 + i % 7)))
    return rows


def test_equals_brute_force(spark):
    rows = make_rows() + [(None, "en", "only null"), (None, None, None), ("", "fr", "empty"), ("x y", "fr", ""), ("a " * 5000, "en", "src0")]
    rows += [rows[3]] * 40  # repeated rows
    docs = frame_of(spark, rows).repartition(5)
    for least in (1, 12, 30, 1000):
        want = brute(rows, least, 7)
        # small blocks and chunks: several of each
        assert result(divergence.divergence_audit(docs, least, 7, block_terms=9, chunk=3)) == want
    assert {r[2] for r in brute(rows, 12, 7)} == {"pair", "term"}


def test_ties_and_equal_sources(spark):
    rows = [("a b c", "en", s) for s in ("z", "y", "x")] * 10
    got = result(divergence.divergence_audit(frame_of(spark, rows)))
    assert got == brute(rows) and {(r[3], r[4], r[5]) for r in got if r[1] == "z"} == {("x", 0, 1), ("y", 0, 2)}


def test_empty_table(spark):
    assert result(divergence.divergence_audit(frame_of(spark, [("a", "b", "c")]).filter("false"))) == set()


def test_very_large_counts_are_exact(spark):
    counts = np.array([0, 3, 10**15, 7 * 10**17])
    assert divergence.shares(counts, 10**18, 4).tolist() == [1 + 10**9 * (int(c) + 5) // (10**18 + 20) for c in counts]
    row = spark.range(1).selectExpr("7 * 100000000000000000L as n", "1000000000000000000L as total", "4L as terms")
    assert row.select(divergence._share(*[row[c] for c in ("n", "total", "terms")])).first()[0] == 1 + 10**9 * (7 * 10**17 + 5) // (10**18 + 20)


def test_equal_subtrees_are_one_node():
    leaves = np.array([[1, 2, 1, 2, 0, 0, 0, 0], [0, 0, 0, 0, 1, 2, 1, 2]])
    roots, levels, values = divergence.consed_trees(leaves)
    assert values.tolist() == [0, 1, 2] and roots[0] != roots[1]
    assert [len(left) for left, _ in levels] == [2, 2, 2]  # two roots, two of four leaves, two of two


def test_terms_of_long_texts_are_whole():
    text = "word%d Ärger " * 10 % tuple(range(10)) + "é" * 3_000_000 + " end"
    pieces = [t.decode() for part in divergence.text_terms(text) for t in part]
    assert pieces == re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))


def test_sql_gives_the_same(spark):
    import duckdb

    path = "/root/testdata/sf0.001/documents.parquet"
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{path}'")
    want = con.sql(divergence.SQL).fetchall()
    assert result(divergence.source_divergence(spark, spark.read.parquet(path))) == set(want) and want
