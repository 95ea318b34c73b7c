"""Pages of any depth by rank selection."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from threatlens.functions import selection as SEL
from threatlens.operators import reports as R
from threatlens.operators.traffic import traffic_anomalies
from threatlens.sources import views as V

SMALL = "/root/testdata/sf0.001"
SCHEMA = "id long, score int, name string, at timestamp_ntz, flag boolean, ratio double"


def rows(n=3000, seed=2):
    rng = random.Random(seed)
    some = lambda v: None if rng.random() < 0.1 else v
    return [
        (i, some(rng.choice([10, 30, 50, 80, 100])), some("".join(rng.choice("abé") for _ in range(rng.randint(0, 3)))),
         some(dt.datetime(2024, 1, 1) + dt.timedelta(seconds=rng.randint(-50, 50))), some(rng.random() < 0.5), some(rng.randint(-5, 5) / 4))
        for i in range(n)
    ]


ORDERS = [
    [("score", True), ("name", False), ("id", False)],
    [("name", True), ("at", True), ("id", True)],
    [("flag", True), ("ratio", True), ("at", False), ("id", False)],
    [("id", True)],
]


@pytest.mark.parametrize("order", ORDERS)
def test_pages_equal_a_full_sort(spark, order):
    df = spark.createDataFrame(rows(), SCHEMA).repartition(5)
    whole = [r["id"] for r in df.orderBy(*[F.desc(c) if d else F.asc(c) for c, d in order]).collect()]
    for start, count in ((0, 10), (1495, 20), (2995, 10)):
        got = SEL.rows_between(df, order, start, count, range_rows=60, ranges=8, sample_rows=200)
        assert [r["id"] for r in got.collect()] == whole[start : start + count]
        assert got.columns == df.columns
    assert SEL.rows_between(df, order, 3000, 10, range_rows=60, ranges=8).collect() == []


def test_one_key_for_all_rows_and_empty_tables(spark):
    df = spark.range(500).select(F.lit(1).alias("k"), "id")
    assert SEL.rows_between(df, [("k", True)], 490, 20, range_rows=5, ranges=4).count() == 10
    assert SEL.rows_between(df.filter("false"), [("k", False)], 0, 5).collect() == []


def test_only_the_pages_range_is_sorted(spark, monkeypatch):
    """The rows that reach the sort are at most the bound, whatever the depth."""
    df = spark.range(20_000).select((F.col("id") * 7919 % 20_011).alias("id"))
    sorted_rows = []
    page = type(df).orderBy

    def counting(self, *cols, **kw):
        if len(cols) == 1 and isinstance(cols[0], str) and cols[0] == "_key":
            sorted_rows.append(self.count())
        return page(self, *cols, **kw)

    monkeypatch.setattr(type(df), "orderBy", counting)
    got = SEL.rows_between(df, [("id", False)], 15_000, 10, range_rows=300, ranges=16, sample_rows=500)
    want = sorted(i * 7919 % 20_011 for i in range(20_000))[15_000:15_010]
    assert [r["id"] for r in got.collect()] == want and max(sorted_rows) <= 300


def test_a_type_without_reverse_raises(spark):
    with pytest.raises(ValueError):
        SEL.rows_between(spark.range(3).select(F.array("id").alias("a")), [("a", True)], 0, 1)


@pytest.mark.parametrize("bad", [{"start": -1}, {"count": 0}, {"range_rows": 0}, {"ranges": 1}])
def test_arguments_are_validated(spark, bad):
    args = {"start": 0, "count": 1, "range_rows": 10, "ranges": 4} | bad
    with pytest.raises(ValueError):
        SEL.rows_between(spark.range(3), [("id", False)], **args)


def test_deep_report_page_is_the_top_k_page(spark, monkeypatch):
    monkeypatch.setattr(R, "SHALLOW_ROWS", 100)
    scored = traffic_anomalies(V.network_traffic(spark, SMALL))
    for page_no in (3, 400):
        assert R.table_page(scored, "suspicious_traffic", page_no).collect() == R.page(scored, R.order_of("suspicious_traffic"), page_no).collect()
    with pytest.raises(ValueError):
        R.table_page(scored, "suspicious_traffic", -1)


def test_candidates_are_found_by_comparisons(spark):
    """No binary search in a lambda for each row and round; repeated keys keep their ranks."""
    df = spark.range(12_000).select((F.col("id") % 3).alias("k"), F.when(F.col("id") % 7 > 0, F.col("id") % 50).alias("v"), "id")
    order = [("k", True), ("v", False), ("id", True)]
    got = SEL.rows_between(df, order, 7_000, 15, range_rows=100, sample_rows=1000)
    assert "lambda" not in got._jdf.queryExecution().optimizedPlan().toString()
    whole = df.orderBy(F.desc("k"), "v", F.desc("id")).collect()
    assert got.collect() == whole[7_000:7_015]
