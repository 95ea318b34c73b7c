import re

import numpy as np

from threatlens.llm import neardup as N


def shingles(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1)) or frozenset([tuple(words)])


def brute(rows, k, percent=80):
    sets = [shingles(t, k) for _, t in rows]
    label = list(range(len(rows)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * len(sets[i] | sets[j]) or rows[i][0] == rows[j][0]:
                label[find(i)] = find(j)
    low = {}
    for i, (doc, _) in enumerate(rows):
        low[find(i)] = min(doc, low.get(find(i), doc))
    return sorted((doc, len(sets[i]), low[find(i)], low[find(i)] == doc) for i, (doc, _) in enumerate(rows))


def result(df, k):
    return sorted(tuple(r) for r in N.link_documents(df, k=k).select("doc_id", "n_shingles", "component_id", "kept").collect())


def test_equals_brute_force(docs, pairs):
    for k in (2, 5):
        want = brute(pairs, k)
        assert sum(not kept for *_, kept in want) > 10
        assert result(docs, k) == want


def test_chains_and_edge_sets(frame):
    words = [f"w{i}" for i in range(40)]
    chain = [(100 - i, " ".join(words[i : i + 30])) for i in range(8)]  # each is near its neighbours only
    rows = chain + [(1, "ONE two"), (2, "one TWO"), (3, "one"), (4, "One"), (5, ""), (6, None), (7, "two\tone"), (8, "\x0bone\x0ctwo\r")]
    assert result(frame(rows), 2) == brute(rows, 2)


def test_null_id_and_empty_table(frame):
    assert [tuple(r) for r in N.link_documents(frame([(None, "a b")])).collect()] == [(None, 1, None, False)]
    assert result(frame([(1, "a")]).filter("doc_id > 1"), 2) == []


def test_stage_keeps_one_of_each_group_and_all_columns(spark, docs, pairs):
    out = N.stage(spark, docs, "")
    assert out.columns == docs.columns
    want = {doc for doc, _, _, kept in brute(pairs, 5) if kept}
    assert {r["doc_id"] for r in out.select("doc_id").collect()} == want


def test_sketch_merges_and_estimates():
    rng = np.random.default_rng(2)
    pool = rng.integers(0, 1 << 63, 6000).astype(np.uint64)
    a, b = np.unique(pool[:4000]), np.unique(pool[400:4400])  # similarity 3600 / 4400
    sk = N.sketches([a, b, np.union1d(a, b)])
    assert (np.maximum(sk[0], sk[1]) == sk[2]).all()
    j = N.estimate(sk[:1], sk[1:2], np.array([4000.0]), np.array([4000.0]))[0]
    assert abs(j - 3600 / 4400) < 0.08
    assert N.estimate(sk[:1], sk[:1], np.array([4000.0]), np.array([4000.0]))[0] > 0.99


def test_register_collisions_follow_similarity():
    rng = np.random.default_rng(4)
    same = []
    for _ in range(60):
        pool = rng.integers(0, 1 << 63, 110).astype(np.uint64)
        sk = N.sketches([np.unique(pool[:100]), np.unique(pool[10:])])
        same.append((sk[0] == sk[1]).mean())
    assert abs(np.mean(same) - 90 / 110) < 0.05


def near_copies(n=90, words=60, seed=11):
    """A group around one text, with more or fewer changed words, ids mixed, some repeated."""
    import random

    rng = random.Random(seed)
    base = [f"b{i}" for i in range(words)]
    rows = []
    for i in range(n):
        text = list(base)
        for _ in range(rng.randint(0, 5)):
            text[rng.randrange(words)] = f"x{rng.randrange(40)}"
        rows.append((rng.randrange(10_000), " ".join(text)))
    return rows + [(rows[0][0], "quite another text of its own"), (rows[1][0], rows[2][1])]


def test_a_group_of_near_copies_equals_brute_force(frame):
    rows = near_copies()
    for k in (2, 5):
        want = brute(rows, k)
        assert 1 < len({c for _, _, c, _ in want}) < 90
        assert result(frame(rows).repartition(6), k) == want


def test_blocks_verify_the_same_links(spark, frame, monkeypatch):
    """Any block size, several sets of one node, and pairs without a link."""
    rows = near_copies(40)
    sets = frame(rows).select("doc_id", "text").mapInArrow(N._set_rows(2), "doc_id long, registers binary, shingles binary")
    ids = sorted({i for i, _ in rows})
    pairs = spark.createDataFrame([(a, b) for a in ids for b in ids if a < b], "a long, b long")
    want = sorted(map(tuple, N.verified(pairs, sets, 80).collect()))
    assert 10 < len(want) < len(ids) ** 2 / 2
    for size in (1, 20_000, 4 << 20):
        monkeypatch.setattr(N, "BLOCK_BYTES", size)
        monkeypatch.setattr(N, "PAIRS", 37)
        assert sorted(map(tuple, N.verified_in_blocks(pairs, sets, 80).collect())) == want


def test_stage_takes_any_column_names(spark, pairs):
    rows = [(i, t, "x", "y", "z") for i, t in pairs]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `_gone` string, row string, `a.b` string")
    out = N.stage(spark, docs, "")
    assert out.columns == docs.columns
    assert {r["doc_id"] for r in out.select("doc_id").collect()} == {doc for doc, _, _, kept in brute(pairs, 5) if kept}


def test_new_links_merge_components_so_far(spark):
    frame = lambda rows, names: spark.createDataFrame(rows, names)
    label = frame([(1, 1), (2, 1), (5, 5), (6, 5), (9, 9), (10, 9)], "node long, label long")
    links = frame([(6, 2), (20, 10), (30, 31), (5, 6)], "a long, b long")
    got = {r["node"]: r["label"] for r in N.merged(label, links).collect()}
    assert got == {1: 1, 2: 1, 5: 1, 6: 1, 9: 9, 10: 9, 20: 9, 30: 30, 31: 30}
    assert N.merged(label, frame([(5, 6)], "a long, b long")) is label


def loose_family(n=160, words=60, most=12, seed=5):
    """Copies of one text with up to ``most`` edits each: many of them lie just below the limit."""
    import random

    rng = random.Random(seed)
    base = [f"b{i}" for i in range(words)]
    rows = []
    for i in range(n):
        text = list(base)
        for _ in range(rng.randint(0, most)):
            at = rng.randrange(len(text))
            kind = rng.random()
            text[at : at + 1] = [] if kind < 0.1 else [text[at], f"y{rng.randrange(50)}"] if kind < 0.2 else [f"x{i}_{at}" if kind < 0.8 else f"y{rng.randrange(50)}"]
        rows.append((i, " ".join(text)))
    return rows


def test_a_loose_family_is_not_compared_in_full(frame, monkeypatch):
    rows = loose_family()
    compared = []

    def counted(f):
        def run(pairs, *args):
            compared.append(pairs.count())
            return f(pairs, *args)

        return run

    for name in ("verified", "verified_in_blocks"):
        monkeypatch.setattr(N, name, counted(getattr(N, name)))
    want = brute(rows, 2)
    assert 20 < len({c for _, _, c, _ in want}) < 140
    assert result(frame(rows).repartition(6), 2) == want
    assert sum(compared) < 5 * len(rows)  # all pairs would be 12,720


def test_families_keep_each_link(spark):
    """Any family, even with a pivot that fits nobody, gives all links between components."""
    rng = np.random.default_rng(8)
    for seed, most in ((1, 6), (2, 9)):
        texts = [t for _, t in loose_family(70, 40, most, seed)] + [t.replace("b", "c") for _, t in loose_family(30, 30, most, seed + 10)]
        sets = N.shingle_sets(texts, 2)
        node = rng.permutation(len(sets)).tolist()
        node[5] = node[4]  # a node of two sets
        family = [(f, x) for x in set(node) for f in (1, 2) if f == 1 or x % 3]
        of = spark.createDataFrame(family, "family long, node long")
        frame = spark.createDataFrame([(x, i, s.tobytes()) for i, (x, s) in enumerate(zip(node, sets, strict=True))], "doc_id long, unit long, shingles binary")
        units = N.weighed(of, frame, 80)
        links = {
            tuple(sorted((x, y)))
            for x, s in zip(node, sets, strict=True)
            for y, t in zip(node, sets, strict=True)
            if x != y and 100 * len(np.intersect1d(s, t)) >= 80 * len(np.union1d(s, t))
        }
        central = {tuple(sorted(r)) for r in N.central_links(units).collect()}
        assert central and central <= links
        label = N.merged(spark.createDataFrame([], "node long, label long"), N.central_links(units))
        of_node = {r["node"]: r["label"] for r in label.collect()}
        found = {tuple(r) for r in N.sharing_pairs(units, label, 80).collect()}
        across = {(a, b) for a, b in links if of_node.get(a, a) != of_node.get(b, b)}
        assert across and across <= found


def test_the_least_of_another_label(spark):
    rng = np.random.default_rng(3)
    rows = [(k, int(rng.integers(0, k + 1)), int(rng.integers(-4, 5))) for k in range(6) for _ in range(3 * k)] + [(9, 1, 2), (9, 1, 3)]  # the last key has one label
    out = N._with_others(spark.createDataFrame(rows, "key long, label long, w long"), ["key"], "w", "other")
    assert out.columns == ["key", "label", "w", "other"]
    want = []
    for k, label, w in rows:
        others = [x for key, at, x in rows if key == k and at != label]
        want += [(k, label, w, min(others))] if others else []
    assert 10 < len(want) < len(rows)
    assert sorted(tuple(r) for r in out.collect()) == sorted(want)


def test_no_step_of_a_family_holds_many_sorters(spark, monkeypatch):
    """Each sorter of a task holds a page of memory at least: one plan of all steps had 58 of them."""
    sets = N.shingle_sets([t for _, t in loose_family(60, 40, 9, 2)], 2)
    of = spark.createDataFrame([(1, x) for x in range(len(sets))], "family long, node long")
    frame = spark.createDataFrame([(i, i, s.tobytes()) for i, s in enumerate(sets)], "doc_id long, unit long, shingles binary")
    units = N.weighed(of, frame, 80)
    label = N.merged(spark.createDataFrame([], "node long, label long"), N.central_links(units))
    sorts = lambda df: df._jdf.queryExecution().executedPlan().toString().count("Sort [")
    seen, kind = [], type(units)
    stored = kind.checkpoint
    monkeypatch.setattr(kind, "checkpoint", lambda df, *args: (seen.append(sorts(df)), stored(df, *args))[1])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        seen.append(sorts(N.sharing_pairs(units, label, 80)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert max(seen) <= 12
