import random
import zlib

import pytest
from pyspark.sql import functions as F

from threatlens.llm import quality as Q


@pytest.fixture(scope="module")
def corpus(spark, frame):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghijklmno") for _ in range(rng.randint(2, 8)))
    rows, labels = [], []
    for i in range(400):
        words = [word() for _ in range(rng.randint(20, 120))]
        good = i % 3 > 0
        rows.append((i, " ".join(words) + "." if good else " | ".join(w + rng.choice(["###", "$$$", ""]) for w in words)))
        labels.append((i, int(good), 0))
    rows += [(1000, None), (1001, ""), (1002, "x" * 300_000), (None, "a b"), rows[0]]
    labels += [(5, None, 0), (7, 1, 0), (7, 1, 0), (None, 1, 0)]
    return frame(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), rows


def test_held_out_accuracy_and_defined_rows(corpus):
    docs, labels, rows = corpus
    out = Q.classify(docs, Q.train(docs, labels)).collect()
    assert len(out) == len(rows)
    for r in out:
        assert 0.0 <= r["score"] <= 1.0 and r["predicted"] == int(r["score"] >= 0.3)
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
    held = [r for r in out if r["held_out"] and r["doc_id"] < 400]
    assert len(held) > 50 and sum(r["predicted"] == (r["doc_id"] % 3 > 0) for r in held) / len(held) > 0.95


def test_held_out_labels_are_not_read(corpus):
    docs, labels, _ = corpus
    flipped = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert Q.train(docs, labels) == Q.train(docs, flipped)


def test_rules_compile_to_the_same_scores(corpus):
    docs, labels, _ = corpus
    model = Q.train(docs, labels)
    assert model.weights
    import math

    for r in Q.with_statistics(docs).withColumn("score", model.score()).collect():
        margin = model.intercept + sum(w for rule, w in model.weights if all((r[s] > at) == above for s, above, at in rule))
        assert abs(r["score"] - 1 / (1 + math.exp(-margin))) < 1e-9


def test_few_labels_and_empty_tables(spark, corpus):
    docs, labels, _ = corpus
    none = labels.filter("doc_id < 0")
    assert {r["score"] for r in Q.classify(docs, Q.train(docs, none)).collect()} == {0.5}
    assert {r["predicted"] for r in Q.classify(docs, Q.train(docs, labels.filter("quality = 1"))).collect()} == {1}
    assert {r["predicted"] for r in Q.classify(docs, Q.train(docs, labels.filter("quality = 0"))).collect()} == {0}
    assert Q.classify(docs.filter("doc_id < 0"), Q.RuleModel(0.0, ())).collect() == []
