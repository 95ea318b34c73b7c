"""Report queries: distributions, cards, bounds, filters, pages, ranges, text."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import at, collect
from threatlens.operators import reports as R
from threatlens.schemas import FAILED_LOGIN_METRICS


def failed(spark, scores):
    rows = [(f"u{i}", "1.2.3.4", 1, at(0), at(i), i, None, s) for i, s in enumerate(scores)]
    return spark.createDataFrame(rows, FAILED_LOGIN_METRICS)


def test_distribution_sums_to_rows(spark):
    df = failed(spark, [10, 10, 20, 30, 100, 80, 80])
    dist = {r["risk_score"]: r["count"] for r in collect(R.risk_distribution(df))}
    assert dist == {10: 2, 20: 1, 30: 1, 80: 2, 100: 1} and sum(dist.values()) == 7
    assert {r["risk_score"] for r in collect(R.risk_distribution(df, 20, 80))} == {20, 30, 80}


def test_bounds(spark):
    assert collect(R.risk_bounds(failed(spark, [10, 20])))[0] == {"slider_min": 0, "slider_max": 100}
    assert collect(R.risk_bounds(failed(spark, [])))[0] == {"slider_min": 0, "slider_max": 100}


def test_filters_and_pages(spark):
    df = failed(spark, [10, 20, 30, 50, 80, 100] * 5)
    assert R.filter_table(df, {"risk_score": (">=", 80)}).count() == 10
    assert R.filter_table(df, {"username": ("contains", "u1")}).count() == 11
    assert R.filter_table(df, {"risk_score": ("!=", 10), "time_span_seconds": ("<", 6)}).count() == 5
    with pytest.raises(ValueError):
        R.filter_table(df, {"risk_score": ("~", 1)})
    pages = [collect(R.page(df, R.order_of("failed_logins"), p, 10)) for p in range(4)]
    assert [len(p) for p in pages] == [10, 10, 10, 0]
    flat = [r["username"] for p in pages for r in p]
    assert len(set(flat)) == 30  # pages are disjoint and complete
    assert [r["risk_score"] for r in pages[0]][:5] == [100] * 5


def test_highlight(spark):
    got = {r["risk_score"]: r["highlight"] for r in collect(R.highlight(failed(spark, [79, 80]), "failed_logins"))}
    assert got == {79: None, 80: "high-risk"}


def test_priorities(spark):
    rows = [("CRITICAL",)] * 3 + [("HIGH",)] + [("LOW",)] * 4
    df = spark.createDataFrame(rows, "priority string").withColumn("alert_type", F.lit("t"))
    share = {r["priority"]: (r["count"], r["sort_order"], r["share"]) for r in collect(R.priority_share(df))}
    assert share == {"CRITICAL": (3, 0, 3 / 8), "HIGH": (1, 1, 1 / 8), "LOW": (4, 3, 4 / 8)}
    assert R.select_priorities(df, []).count() == 0
    assert R.priority_distribution(df, ["HIGH", "MEDIUM"]).count() == 1


def test_time_range(spark):
    rows = [(at(-86400 * d),) for d in (0, 0.5, 2, 10, 40)] + [(None,)]
    df = spark.createDataFrame(rows, "timestamp timestamp_ntz")
    as_of = at(0)
    counts = {k: R.time_range(df, "timestamp", as_of, k).count() for k in R.RANGES}
    assert counts == {"all": 6, "24h": 2, "7d": 3, "30d": 4}


def test_timestamps_as_text_and_back(spark):
    df = failed(spark, [10])
    text = R.timestamps_as_text(df)
    assert dict(text.dtypes)["first_attempt"] == "string"
    assert collect(text)[0]["first_attempt"] == "2024-01-01 12:00:00"
    back = R.parse_timestamps(text, ["first_attempt", "last_attempt", "missing"])
    assert collect(back)[0]["first_attempt"] == dt.datetime(2024, 1, 1, 12, 0, 0)


def test_preview_and_first_columns(spark):
    df = failed(spark, [10, 100, 30, 80])
    assert [r["risk_score"] for r in collect(R.preview(df, "failed_logins"))] == [100, 80, 30]
    assert R.first_columns(df).columns == ["username", "ip_address", "failed_attempt_count", "first_attempt", "last_attempt"]


def test_ipv4_helpers(spark):
    from threatlens.functions.network import in_cidr, ip_zone, ipv4_to_long

    rows = [("10.0.0.1",), ("10.0.0.255",), ("10.0.1.0",), ("256.1.1.1",), ("::1",), ("1.2.3",), (None,), ("0.0.0.0",)]
    df = spark.createDataFrame(rows, "ip string").select(
        "ip", ipv4_to_long(F.col("ip")).alias("v"), in_cidr(F.col("ip"), "10.0.0.0/24").alias("in"),
        ip_zone(F.col("ip")).alias("zone"),
    )
    got = {r["ip"]: (r["v"], r["in"], r["zone"]) for r in df.collect()}
    assert got["10.0.0.1"] == (167772161, True, "internal")
    assert got["10.0.0.255"][1] is True and got["10.0.1.0"][1] is False
    assert got["256.1.1.1"] == (None, False, "unknown") and got["::1"] == (None, False, "unknown")
    assert got["1.2.3"][0] is None and got[None] == (None, False, "unknown") and got["0.0.0.0"][0] == 0


def test_page_arguments(spark):
    with pytest.raises(ValueError):
        R.page(failed(spark, [10]), R.order_of("failed_logins"), -1)
    with pytest.raises(ValueError):
        R.page(failed(spark, [10]), R.order_of("failed_logins"), 0, 0)
