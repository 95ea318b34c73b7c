"""Detectors against brute force on small fixtures."""

from collections import defaultdict


from conftest import at, collect
from threatlens.config import Zones
from threatlens.operators.alerts import incident_steps, incident_timelines
from threatlens.operators.contracts import NETWORK_TRAFFIC_CONTRACT, contract_violations
from threatlens.operators.logins import brute_force_bursts, failures_by_zone, success_after_failures
from threatlens.operators.traffic import port_scans
from threatlens.schemas import LOGIN_ATTEMPTS, NETWORK_TRAFFIC, SECURITY_ALERTS

ATTEMPTS = [
    # (user, offset seconds, success)
    ("u1", 0, False), ("u1", 10, False), ("u1", 20, False), ("u1", 30, False), ("u1", 40, False),
    ("u1", 200, False), ("u1", 201, True), ("u1", 205, False),
    ("u2", 0, False), ("u2", 59, False), ("u2", 120, False), ("u2", 180, False), ("u2", 240, False),
    ("u2", 240.5, False), ("u2", 241, True),
    ("u3", 0, True), ("u3", 1, False), ("u3", 2, None), ("u3", 3, True),
]


def login_frame(spark, rows=ATTEMPTS, ip="10.0.0.5"):
    data = [(i, u, at(o), ip, s, "ua", "Tokyo, Japan") for i, (u, o, s) in enumerate(rows)]
    return spark.createDataFrame(data, LOGIN_ATTEMPTS)


def brute_bursts(rows, max_gap, min_attempts):
    by_user = defaultdict(list)
    for u, o, s in rows:
        if s is False:
            by_user[u].append(int(at(o).timestamp() // 1))
    out = []
    for u, secs in by_user.items():
        secs.sort()
        start, prev, n = secs[0], secs[0], 1
        for s in secs[1:]:
            if s - prev > max_gap:
                out.append((u, n)) if n >= min_attempts else None
                start, n = s, 0
            n += 1
            prev = s
        if n >= min_attempts:
            out.append((u, n))
    return sorted(out)


def test_brute_force_bursts(spark):
    for gap, k in [(60, 5), (10, 3), (59, 2), (1000, 1)]:
        df = brute_force_bursts(login_frame(spark), keys=("username",), max_gap_s=gap, min_attempts=k)
        got = sorted((r["username"], r["attempts"]) for r in collect(df))
        assert got == brute_bursts(ATTEMPTS, gap, k), (gap, k)


def test_bursts_cross_day_buckets(spark):
    # failures 30 s apart across a day boundary stay one burst
    rows = [("u", 86400 * 3 - 45 + 30 * k, False) for k in range(6)]
    df = brute_force_bursts(login_frame(spark, rows), keys=("username",), max_gap_s=60, min_attempts=5, bucket_s=3600)
    assert [r["attempts"] for r in collect(df)] == [6]


def brute_success_after(rows, look_back, min_failures):
    out = []
    by_user = defaultdict(list)
    for i, (u, o, s) in enumerate(rows):
        by_user[u].append((o, i, s))
    for u, seq in by_user.items():
        seq.sort()
        for j, (o, i, s) in enumerate(seq):
            if s is True:
                fails = sum(1 for _, _, x in seq[max(0, j - look_back):j] if x is False)
                if fails >= min_failures:
                    out.append((i, fails))
    return sorted(out)


def test_success_after_failures(spark):
    for lb, m in [(3, 2), (2, 2), (5, 3), (1, 1)]:
        df = success_after_failures(login_frame(spark), look_back=lb, min_failures=m)
        got = sorted((r["attempt_id"], r["recent_failures"]) for r in collect(df))
        assert got == brute_success_after(ATTEMPTS, lb, m), (lb, m)


def test_failures_by_zone(spark):
    rows = [(i, "u", at(i), ip, ok, "ua", "X") for i, (ip, ok) in enumerate(
        [("192.168.1.7", False), ("172.16.0.9", True), ("203.0.113.1", False), ("198.51.100.250", False),
         ("8.8.8.8", False), ("not-an-ip", True), (None, False), ("10.0.0.300", False)])]
    df = failures_by_zone(spark.createDataFrame(rows, LOGIN_ATTEMPTS), Zones())
    got = {r["zone"]: (r["attempts"], r["failures"]) for r in collect(df)}
    assert got == {"internal": (2, 1), "external": (2, 2), "unknown": (4, 3)}


def test_port_scans(spark):
    rows = [(i, "s", "d", "TCP", 20 + i, 60, at(i), False, 0) for i in range(7)]  # 7 ports in 7 s
    rows += [(100 + i, "t", "d", "TCP", 80, 60, at(i), False, 0) for i in range(9)]  # one port
    df = port_scans(spark.createDataFrame(rows, NETWORK_TRAFFIC), keys=("source_ip",), window="60 seconds", min_ports=5)
    got = collect(df)
    assert [(r["source_ip"], r["distinct_ports"], r["connections"]) for r in got] == [("s", 7, 7)]
    assert got[0]["window_start"].second == 0


def test_incidents(spark):
    types = ["Brute Force", "Malware Detected", "Brute Force", "Ransomware"]
    rows = [(i, t, "HIGH", at(60 * (4 - i)), "IDS-1", "d", "S", i == 0, {"incident_id": "INC-7"})
            for i, t in enumerate(types)]
    rows.append((9, "Phishing Attempt", "LOW", at(0), "IDS-1", "d", "S", False, {"ip_address": "x"}))
    df = spark.createDataFrame(rows, SECURITY_ALERTS)
    tl = collect(incident_timelines(df))
    assert len(tl) == 1
    r = tl[0]
    assert (r["steps"], r["unresolved_steps"], r["distinct_alert_types"]) == (4, 3, 3)
    assert (r["first_alert_type"], r["last_alert_type"], r["duration_seconds"]) == ("Ransomware", "Brute Force", 180)
    steps = [(x["alert_id"], x["step"]) for x in collect(incident_steps(df), "step")]
    assert steps == [(3, 1), (2, 2), (1, 3), (0, 4)]


def test_contract_violations(spark):
    rows = [(1, "a", "b", "TCP", 80, 1, at(0), False, 0), (1, "a", "b", "x" * 51, 80, 1, at(0), False, 1),
            (2, None, "b", "TCP", None, 1, at(0), None, 2)]
    df = contract_violations(spark.createDataFrame(rows, NETWORK_TRAFFIC), NETWORK_TRAFFIC_CONTRACT)
    got = {(r["rule"], r["columns"]): r["violations"] for r in collect(df)}
    assert got[("primary_key", "traffic_id")] == 2
    assert got[("not_null", "source_ip")] == 1 and got[("not_null", "port")] == 1
    assert got[("max_length_50", "protocol")] == 1 and got[("not_null", "timestamp")] == 0


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql.window import Window  # noqa: E402


def window_bursts(logins, keys, max_gap_s, min_attempts):
    """Direct definition: lag + running sum per key over every failure."""
    fails = logins.filter(~F.col("success") & F.col("timestamp").isNotNull()).withColumn(
        "_sec", F.unix_timestamp("timestamp"))
    w = Window.partitionBy(*keys).orderBy("_sec", "attempt_id")
    prev = F.lag("_sec").over(w)
    s = fails.withColumn("_b", F.sum(F.when(prev.isNull() | (F.col("_sec") - prev > max_gap_s), 1).otherwise(0))
                         .over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return s.groupBy(*keys, "_b").agg(F.count("*").alias("attempts"), F.min("timestamp").alias("burst_start"),
                                      F.max("timestamp").alias("burst_end")).filter(F.col("attempts") >= min_attempts)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    rows=st.lists(st.tuples(st.sampled_from(["a", "a", "a", "b", "c"]),
                            st.floats(min_value=0, max_value=4 * 86400).map(lambda x: round(x, 1)),
                            st.sampled_from([False, False, True, None])), min_size=1, max_size=80),
    gap=st.sampled_from([0, 5, 60, 3600, 86400]),
    k=st.integers(min_value=1, max_value=4),
    bucket=st.sampled_from([60, 3600, 86400]),
)
def test_bursts_equal_direct_sessionization(spark, rows, gap, k, bucket):
    df = login_frame(spark, rows)
    got = brute_force_bursts(df, keys=("username",), max_gap_s=gap, min_attempts=k, bucket_s=bucket)
    expect = window_bursts(df, ["username"], gap, k)
    cols = ["username", "attempts", "burst_start", "burst_end"]
    assert sorted(got.select(*cols).collect()) == sorted(expect.select(*cols).collect())


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    rows=st.lists(st.tuples(st.sampled_from(["s1", "s1", "s2", "s3"]),
                            st.integers(min_value=0, max_value=400),
                            st.sampled_from([22, 80, 443, 3389, 21, 53, 25])), min_size=1, max_size=60),
    k=st.integers(min_value=1, max_value=5),
)
def test_port_scans_equal_brute_force(spark, rows, k):
    data = [(i, src, "d", "TCP", port, 60, at(sec), False, 0) for i, (src, sec, port) in enumerate(rows)]
    got = port_scans(spark.createDataFrame(data, NETWORK_TRAFFIC), keys=("source_ip",), window="60 seconds", min_ports=k)
    import calendar

    def epoch(t):  # wall-clock value as UTC seconds, whatever the local zone
        return calendar.timegm(t.timetuple())

    base = epoch(at(0)) // 60 * 60
    expect = defaultdict(lambda: [set(), 0])
    for src, sec, port in rows:
        start = (epoch(at(sec)) // 60) * 60 - base
        expect[(src, start)][0].add(port)
        expect[(src, start)][1] += 1
    want = sorted((s, st_, len(p), n) for (s, st_), (p, n) in expect.items() if len(p) >= k)
    have = sorted((r["source_ip"], epoch(r["window_start"]) - base, r["distinct_ports"], r["connections"])
                  for r in got.collect())
    assert have == want


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=st.lists(st.tuples(st.sampled_from(["INC-1", "INC-1", "INC-2", None]),
                               st.integers(min_value=0, max_value=50),
                               st.sampled_from(["Ransomware", "Brute Force", "Phishing Attempt"]),
                               st.booleans()), min_size=1, max_size=40))
def test_incident_timelines_equal_brute_force(spark, rows):
    data = [(i, t, "HIGH", at(sec), "IDS-1", "d", "S", res, None if inc is None else {"incident_id": inc})
            for i, (inc, sec, t, res) in enumerate(rows)]
    got = {r["incident_id"]: r for r in collect(incident_timelines(spark.createDataFrame(data, SECURITY_ALERTS)))}
    groups = defaultdict(list)
    for i, (inc, sec, t, res) in enumerate(rows):
        if inc is not None:
            groups[inc].append((sec, i, t, res))
    assert set(got) == set(groups)
    for inc, items in groups.items():
        items.sort()
        r = got[inc]
        assert (r["steps"], r["unresolved_steps"]) == (len(items), sum(1 for x in items if not x[3]))
        assert (r["first_alert_type"], r["last_alert_type"]) == (items[0][2], items[-1][2])
        assert r["distinct_alert_types"] == len({x[2] for x in items})
        assert r["duration_seconds"] == items[-1][0] - items[0][0]


def test_detector_arguments(spark):
    import pytest

    df = login_frame(spark)
    with pytest.raises(ValueError):
        brute_force_bursts(df, max_gap_s=-1)
    with pytest.raises(ValueError):
        brute_force_bursts(df, bucket_s=0)
    with pytest.raises(ValueError):
        success_after_failures(df, look_back=0)
