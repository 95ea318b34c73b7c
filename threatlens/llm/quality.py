"""Quality classifier: a sparse rule ensemble.

Statistics of the whole text are computed for each document (counts of character classes,
word and line statistics, repetition).  A small random forest is fitted on a bounded
sample of labelled documents; each path from a root to a node of it is a rule, a
conjunction of thresholds.  A logistic regression with lasso penalty over the rules keeps
a sparse weighted set, and these rules are compiled into one Spark Column expression that
scores all documents.

Training reads at most ``max_labels`` labelled documents, chosen by a hash of the id;
labels, lang, source and doc_id are no inputs of a score.

Defined results: null counts as the empty text, whose statistics are zeros, and is scored
like any other; a label that is null teaches nothing, and of repeated labels of an id the
smallest counts; with no labels, or of one class only, the score is the constant 0.5, or
that class; repeated rows are scored one by one; an empty table gives an empty one.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threatlens.llm.common import fold, id_text, table, text_slices, texts
from threatlens.session import ensure_checkpoint_dir

STATS = (
    "log_bytes", "log_words", "log_lines", "letters", "digits", "capitals", "blanks", "stops", "symbols", "controls", "high_bytes",
    "word_length", "word_length_sd", "distinct_words", "top_word", "repeated_words", "symbol_words", "lone_symbols", "line_words",
    "distinct_lines", "entropy",
)


@dataclass(frozen=True)
class RuleFitRules:
    #: bound of the labelled sample
    max_labels: int = 20_000
    trees: int = 20
    depth: int = 3
    #: lasso penalty
    penalty: float = 0.002
    threshold: float = 0.3


_CLASS = np.full(256, 5, dtype=np.int64)  # symbols
_CLASS[[*range(65, 91), *range(97, 123)]] = 0
_CLASS[48:58] = 1
_CLASS[[32, 10, 9, 13]] = 2
_CLASS[[ord(c) for c in ".,;:!?'\"()-"]] = 3
_CLASS[[*range(9), 11, 12, *range(14, 32), 127]] = 4
_CLASS[128:] = 6


def statistics(text: str) -> tuple[float, ...]:
    """The values of ``STATS`` for one text."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    n = len(raw)
    by_byte = np.bincount(raw, minlength=256)
    share = np.bincount(_CLASS, weights=by_byte, minlength=7) / max(n, 1)
    p = by_byte[by_byte > 0] / max(n, 1)
    words = text.split()
    w = len(words)
    counts = Counter(words)
    sizes = np.fromiter(map(len, words), dtype=np.float64, count=w)
    lines = text.split("\n")
    with_symbol = sum(c for x, c in counts.items() if not x.isalnum() and not x.strip(".,;:!?'\"()-").isalnum())
    lone = sum(c for x, c in counts.items() if len(x) == 1 and not x.isalnum())
    m = max(w, 1)
    return (
        math.log1p(n), math.log1p(w), math.log1p(len(lines)), share[0], share[1], float(by_byte[65:91].sum()) / max(n, 1), share[2],
        share[3], share[5], share[4], share[6], float(sizes.mean()) if w else 0.0, float(sizes.std()) if w else 0.0, len(counts) / m,
        max(counts.values(), default=0) / m, sum(map(eq, words, words[1:])) / m, with_symbol / m, lone / m, w / len(lines),
        len(set(lines)) / len(lines), float(-(p * np.log2(p)).sum()),
    )


def _stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_slices(batches, "text"):
        rows = np.array([statistics(t) for t in texts(batch)], dtype=np.float64)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(c) for c in rows.T]], names=["doc_id", *STATS])


def with_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the statistics of each row."""
    return id_text(docs).mapInArrow(_stats, "doc_id long, " + ", ".join(f"{s} double" for s in STATS))


def paths(node, conditions: tuple = ()) -> Iterator[tuple]:
    """Rules of a fitted tree: (statistic, is above, threshold) conjunctions, one for each
    node below the root."""
    if conditions:
        yield tuple(sorted(set(conditions)))
    if node.subtreeDepth() > 0:
        split = node.split()
        stat, at = STATS[split.featureIndex()], float(split.threshold())
        yield from paths(node.leftChild(), (*conditions, (stat, False, at)))
        yield from paths(node.rightChild(), (*conditions, (stat, True, at)))


def rule_column(rule: tuple) -> Column:
    """1.0 where all conditions of the rule hold, else 0.0."""
    out = F.lit(True)
    for stat, above, at in rule:
        out = out & ((F.col(stat) > at) if above else (F.col(stat) <= at))
    return out.cast("double")


@dataclass(frozen=True)
class RuleModel:
    intercept: float
    weights: tuple[tuple[tuple, float], ...]  # (rule, weight)

    def score(self) -> Column:
        """The compiled ensemble over the statistics' columns."""
        margin = F.lit(self.intercept)
        for rule, weight in self.weights:
            margin = margin + F.lit(weight) * rule_column(rule)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))


def train(docs: DataFrame, labels: DataFrame, rules: RuleFitRules = RuleFitRules()) -> RuleModel:
    """Learn from the labelled documents outside fold 0 of 5."""
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("label"))
        .filter(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & (fold("doc_id", 5) != 0))
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"))
    )
    n = known.count()
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    sample = known.filter(draw < min(1.0, 1.05 * rules.max_labels / max(n, 1)) * (1 << 30)).orderBy(draw, "doc_id").limit(rules.max_labels)
    ensure_checkpoint_dir(docs.sparkSession)
    # at most max_labels ids and labels: a proven bound for the broadcast
    chosen = id_text(docs).join(F.broadcast(sample.select("doc_id")), "doc_id")
    rows = with_statistics(chosen).join(F.broadcast(sample), "doc_id").repartition(8).sortWithinPartitions("doc_id").checkpoint()
    classes = [r["label"] for r in rows.select("label").distinct().collect()]
    if len(classes) < 2:
        return RuleModel(0.0 if not classes else 20.0 * (2 * classes[0] - 1), ())
    vectors = VectorAssembler(inputCols=list(STATS), outputCol="_stats", handleInvalid="keep").transform(rows)
    forest = RandomForestClassifier(
        featuresCol="_stats", labelCol="label", numTrees=rules.trees, maxDepth=rules.depth, seed=7, subsamplingRate=0.7
    ).fit(vectors)
    found = sorted({rule for tree in forest.trees for rule in paths(tree._java_obj.rootNode())})
    names = [f"_rule{i}" for i in range(len(found))]
    fired = rows.select("label", *[rule_column(r).alias(c) for r, c in zip(found, names, strict=True)])
    fired = VectorAssembler(inputCols=names, outputCol="_rules").transform(fired).select("label", "_rules").cache()
    lasso = LogisticRegression(
        featuresCol="_rules", labelCol="label", elasticNetParam=1.0, regParam=rules.penalty, maxIter=60, standardization=False
    ).fit(fired)
    fired.unpersist()
    weights = tuple((r, float(w)) for r, w in zip(found, lasso.coefficients.toArray(), strict=True) if w != 0.0)
    return RuleModel(float(lasso.intercept), weights)


def classify(docs: DataFrame, model: RuleModel, rules: RuleFitRules = RuleFitRules()) -> DataFrame:
    """doc_id, held_out, score, predicted for each row."""
    return (
        with_statistics(docs)
        .select("doc_id", F.coalesce(fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"), model.score().alias("score"))
        .withColumn("predicted", (F.col("score") >= rules.threshold).cast("int"))
    )


def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op3."""
    docs = table(spark, sf_dir, "documents")
    return classify(docs, train(docs, table(spark, sf_dir, "labels")))
