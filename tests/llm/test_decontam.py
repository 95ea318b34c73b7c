import random

import numpy as np

from threatlens.llm import decontam as D


def brute_tiles(item, doc, least):
    """Greedy string tiling without any index."""
    used_i, used_d, covered = set(), set(), 0
    while True:
        best = (0, 0, 0)
        for s in range(len(doc)):
            for i in range(len(item)):
                k = 0
                while i + k < len(item) and s + k < len(doc) and item[i + k] == doc[s + k] and i + k not in used_i and s + k not in used_d:
                    k += 1
                if k > best[0]:
                    best = (k, i, s)
        k, i, s = best
        if k < least:
            return covered
        used_i.update(range(i, i + k))
        used_d.update(range(s, s + k))
        covered += k


def test_tiling_equals_brute_force():
    rng = random.Random(1)
    for _ in range(150):
        item = [rng.choice("abc") for _ in range(rng.randint(5, 25))]
        doc = [rng.choice("abcd") for _ in range(rng.randint(0, 40))]
        cut = rng.randint(0, len(item))
        doc += item[cut:] + [rng.choice("abcd")] + item[:cut]
        block = D.build_block([(7, " ".join(item))], D.TilingRules(threshold=0.0001))
        found = D.tile_text(" ".join(doc), block, D.TilingRules(threshold=0.0001))
        want = brute_tiles(item, doc, 5)
        assert [x[2] for x in found] == ([want] if want else [])


def test_finds_planted_and_reordered_passages(spark, frame):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    items = [(i, " ".join(word() for _ in range(30))) for i in range(20)]
    bench = spark.createDataFrame(items + [(90, "too short"), (91, None), (92, "")], "item_id long, text string")
    rows = [(i, " ".join(word() for _ in range(200))) for i in range(10)]
    filler = " ".join(word() for _ in range(50))
    a, b = items[3][1].split(), items[4][1].split()
    rows += [
        (100, filler + " " + items[0][1].upper().replace(" ", ", ")),
        (101, " ".join(a[15:]) + " " + filler + " " + " ".join(a[:15])),  # reordered
        (102, " ".join(b[:8]) + " " + filler),  # too little of it
        (103, items[5][1] + "\n" + items[6][1]),
        (104, None),
        (105, ""),
        (103, items[5][1] + "\n" + items[6][1]),
    ]
    want = [(100, 0, 1), (101, 3, 2), (103, 5, 1), (103, 5, 1), (103, 6, 1), (103, 6, 1)]
    for rules in (D.TilingRules(), D.TilingRules(block_bytes=1500)):
        out = D.contaminated(frame(rows), bench, rules)
        assert sorted((r["doc_id"], r["item_id"], r["n_tiles"]) for r in out.collect()) == want
        clean = D.clean_documents(frame(rows), bench, rules)
        assert clean.columns == frame(rows).columns
        assert sorted(r["doc_id"] for r in clean.collect()) == [*range(10), 102, 104, 105]


def test_short_items_and_scripts_without_blanks(spark, frame):
    items = [(1, "What is seven?"), (2, "中国的首都是哪一座城市，它有多少人口？"), (3, "เมืองหลวงของประเทศไทยคือเมืองใด"), (4, "東京は"), (5, "!?"), (6, "Rare")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = [
        (1, "He asked: what is, SEVEN and went. What is seven?"),
        (2, "what is six, seven is what"),
        (3, "前面还有别的话：中国的首都是哪一座城市，它有多少人口？后面也有"),
        (4, "中国的首都很大，人口也多"),
        (5, "ถาม " + items[2][1] + "ครับ"),
        (6, "今日の東京は晴れ"),
        (7, "東京"),
        (8, "it is rare"),
        (9, ""),
    ]
    out = D.contaminated(frame(rows), bench).collect()
    assert sorted((r["doc_id"], r["item_id"], r["n_tiles"]) for r in out if r["doc_id"] != 3) == [(1, 1, 1), (5, 3, 1), (6, 4, 1), (8, 6, 1)]
    assert [(r["item_id"], r["coverage"]) for r in out if r["doc_id"] == 3] == [(2, 1.0)]
    assert sorted(r["doc_id"] for r in D.clean_documents(frame(rows), bench).collect()) == [2, 4, 7, 9]


def test_empty_tables(spark, frame):
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.contaminated(frame([(1, "a b c d e f")]), none).collect() == []
    assert D.clean_documents(frame([(1, "a b c d e f")]), none).count() == 1
    some = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert D.contaminated(frame([(1, "x")]).filter("doc_id > 1"), some).collect() == []


def test_rolling_hash_of_windows():
    ids = np.array([1, 2, 3, 1, 2, 3, 4])
    h = D._rolling(ids, 3)
    assert h[0] == h[3] and len(set(h.tolist())) == 4
