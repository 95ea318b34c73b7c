"""Truth tables: one literal row per branch and boundary of the three scores."""

from conftest import at, collect

from threatlens.config import LoginRiskRules
from threatlens.operators.alerts import prioritize_alerts, unresolved
from threatlens.operators.logins import failed_login_metrics
from threatlens.operators.traffic import traffic_anomalies
from threatlens.schemas import LOGIN_ATTEMPTS, NETWORK_TRAFFIC, SECURITY_ALERTS


def logins(spark, groups):
    """groups: {username: [(offset_s, success), ...]} -> login rows, one ip."""
    rows, i = [], 0
    for user, attempts in groups.items():
        for off, ok in attempts:
            i += 1
            rows.append((i, user, None if off is None else at(off), "10.0.0.1", ok, "ua", "Tokyo, Japan"))
    return spark.createDataFrame(rows, LOGIN_ATTEMPTS)


def test_risk_bands_and_boundaries(spark):
    fails = lambda span, n=5: [(span * k / (n - 1), False) for k in range(n)]
    groups = {
        "s60": fails(60), "s61": fails(61), "s300": fails(300), "s301": fails(301),
        "s3600": fails(3600), "s3601": fails(3601),
        "c4": fails(10, 4), "c3": fails(10, 3), "c2": fails(10, 2),
        "one": [(0, False)],
        "mixed": [(0, False), (1, True), (2, None), (3, True)],
    }
    got = {r["username"]: r for r in collect(failed_login_metrics(logins(spark, groups)))}
    assert {u: got[u]["risk_score"] for u in got} == {
        "s60": 100, "s61": 80, "s300": 80, "s301": 50, "s3600": 50, "s3601": 30,
        "c4": 20, "c3": 20, "c2": 10, "one": 10, "mixed": 10,
    }
    assert got["one"]["time_span_seconds"] == 0 and got["one"]["attempts_per_minute"] is None
    assert got["mixed"]["failed_attempt_count"] == 1  # successes and null success dropped
    assert abs(got["s60"]["attempts_per_minute"] - 5.0) < 1e-12
    assert "ok" not in got


def test_whole_second_spans(spark):
    # 0.9 s -> 61.1 s spans 61 whole seconds by floor arithmetic, not 60.2
    groups = {"u": [(0.9, False)] * 4 + [(61.1, False)]}
    r = collect(failed_login_metrics(logins(spark, groups)))[0]
    assert r["time_span_seconds"] == 61 and r["risk_score"] == 80


def test_scaled_rules(spark):
    rules = LoginRiskRules(band_100_s=10, band_80_s=20, band_50_s=30)
    groups = {"a": [(k * 2.5, False) for k in range(5)], "b": [(k * 7.5, False) for k in range(5)]}
    got = {r["username"]: r["risk_score"] for r in collect(failed_login_metrics(logins(spark, groups), rules))}
    assert got == {"a": 100, "b": 50}


def traffic(spark, rows):
    """rows: (id, source_ip, offset_s, port, packet, suspicious)"""
    data = [
        (i, ip, "10.0.0.9", "TCP", port, size, None if off is None else at(off), sus, i)
        for i, ip, off, port, size, sus in rows
    ]
    return spark.createDataFrame(data, NETWORK_TRAFFIC)


def test_traffic_truth_table(spark):
    rows = [
        (1, "a", 0.0, 80, 100, False),  # first of source: not rapid -> 10
        (2, "a", 0.5, 22, 100, False),  # same second, ssh -> rapid & port -> 80
        (3, "a", 1.2, 80, 100, False),  # next second -> not rapid -> 10
        (4, "a", 1.9, 80, 1001, False),  # rapid -> 50 (rapid wins over large)
        (5, "a", 5.0, 21, 1001, False),  # port 21 not suspicious, large -> 30
        (6, "a", 9.0, 3389, 1000, False),  # port only -> 50; 1000 is not large
        (7, "a", 20.0, None, None, None),  # nulls -> false flags, falls through -> 10
        (8, "a", 30.0, 80, 100, True),  # suspicious -> 100
        (9, "b", 0.2, 80, 100, False),  # other source, same second as 1 -> not rapid
        (10, "a", None, 80, 100, False),  # null timestamp -> not rapid
    ]
    got = {r["traffic_id"]: r for r in collect(traffic_anomalies(traffic(spark, rows)))}
    assert {k: v["anomaly_score"] for k, v in got.items()} == {
        1: 10, 2: 80, 3: 10, 4: 50, 5: 30, 6: 50, 7: 10, 8: 100, 9: 10, 10: 10
    }
    assert got[7]["suspicious_port"] is False and got[7]["large_packet"] is False
    assert got[4]["rapid_connection"] and got[4]["large_packet"]
    assert list(traffic_anomalies(traffic(spark, rows)).columns) == [
        "traffic_id", "source_ip", "destination_ip", "protocol", "port", "timestamp", "packet_size",
        "is_suspicious", "rapid_connection", "suspicious_port", "large_packet", "anomaly_score",
    ]


def test_alert_priorities(spark):
    sev = ["HIGH", "MEDIUM", "LOW", "INFO", None, "high"]
    rows = [(i, "t", s, at(i), "IDS-1", "d", "S", i % 2 == 0, {"incident_id": "INC-1"}) for i, s in enumerate(sev)]
    rows.append((99, "t", "HIGH", at(0), "IDS-1", "d", "S", None, None))
    df = spark.createDataFrame(rows, SECURITY_ALERTS)
    got = {r["alert_id"]: r for r in collect(prioritize_alerts(df))}
    assert [(got[i]["severity_score"], got[i]["priority"]) for i in range(6)] == [
        (100, "CRITICAL"), (50, "HIGH"), (20, "MEDIUM"), (10, "LOW"), (10, "LOW"), (10, "LOW")
    ]
    # action: unresolved (odd ids) and score >= 50; null is_resolved -> no action
    assert [got[i]["action_required"] for i in range(6)] == [False, True, False, False, False, False]
    assert got[99]["action_required"] is False
    assert {r["alert_id"] for r in collect(unresolved(df))} == {1, 3, 5}


def test_every_port(spark):
    from threatlens.config import TRAFFIC_PORTS

    ports = list(TRAFFIC_PORTS) + [5432, None]
    rows = [(i, f"src{i}", 0.0, p, 100, False) for i, p in enumerate(ports)]  # one row per source
    got = {r["port"]: (r["suspicious_port"], r["anomaly_score"]) for r in collect(traffic_anomalies(traffic(spark, rows)))}
    for p in ports:
        flagged = p in (22, 3389, 445, 1433, 3306, 5432)
        assert got[p] == (flagged, 50 if flagged else 10), p
    assert got[21] == (False, 10)  # FTP is not in the suspicious set


def test_failed_logins_with_nulls(spark):
    rows = [(i, None, at(i), "10.0.0.1", False, None, None) for i in range(3)]  # null user
    rows += [(10 + i, "u", at(i), None, False, "ua", "X") for i in range(5)]  # null address
    rows += [(20 + i, "v", None, "10.0.0.2", False, "ua", "X") for i in range(5)]  # null times
    got = {(r["username"], r["ip_address"]): r for r in collect(failed_login_metrics(spark.createDataFrame(rows, LOGIN_ATTEMPTS)))}
    assert got[(None, "10.0.0.1")]["failed_attempt_count"] == 3 and got[(None, "10.0.0.1")]["risk_score"] == 20
    assert got[("u", None)]["risk_score"] == 100
    v = got[("v", "10.0.0.2")]
    assert v["time_span_seconds"] is None and v["attempts_per_minute"] is None and v["risk_score"] == 30


def test_traffic_without_tie_key(spark):
    rows = [(1, "a", 0.0, 22, 100, False), (2, "a", 0.5, 80, 100, False), (3, "b", 0.2, 80, 100, False)]
    df = traffic(spark, rows).drop("tie_key")
    got = {r["traffic_id"]: r["rapid_connection"] for r in collect(traffic_anomalies(df))}
    assert got == {1: False, 2: True, 3: False}
