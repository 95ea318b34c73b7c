"""Properties on the driver tables: partitioning and input order never change a
result; scores stay in their fixed sets; distributions sum to the row count."""

import pytest
from pyspark.sql import functions as F

from threatlens.operators import reports as R
from threatlens.operators.alerts import prioritize_alerts
from threatlens.operators.logins import brute_force_bursts, failed_login_metrics, success_after_failures
from threatlens.operators.traffic import traffic_anomalies
from threatlens.sources import views as V

SMALL = "/root/testdata/sf0.001"

OPS = {
    "failed_logins": (V.login_attempts, failed_login_metrics),
    "traffic": (V.network_traffic, traffic_anomalies),
    "alerts": (V.security_alerts, lambda a: prioritize_alerts(a).drop("detection_details")),
    "bursts": (V.login_attempts, lambda l: brute_force_bursts(l, keys=("username",), max_gap_s=86400, min_attempts=3)),
    "success_after": (V.login_attempts, success_after_failures),
}


@pytest.mark.parametrize("name", sorted(OPS))
def test_partitioning_and_order_do_not_matter(spark, name):
    view, op = OPS[name]
    src = view(spark, SMALL)
    expect = sorted(op(src).collect())
    for layout in (src.repartition(1), src.repartition(7), src.orderBy(F.rand(seed=3)).repartition(3)):
        assert sorted(op(layout).collect()) == expect


def test_scores_in_fixed_sets(spark):
    failed = failed_login_metrics(V.login_attempts(spark, SMALL))
    scored = traffic_anomalies(V.network_traffic(spark, SMALL))
    enriched = prioritize_alerts(V.security_alerts(spark, SMALL))
    assert {r[0] for r in failed.select("risk_score").distinct().collect()} <= {10, 20, 30, 50, 80, 100}
    assert {r[0] for r in scored.select("anomaly_score").distinct().collect()} <= {10, 30, 50, 80, 100}
    assert {tuple(r) for r in enriched.select("severity_score", "priority").distinct().collect()} <= {
        (100, "CRITICAL"), (50, "HIGH"), (20, "MEDIUM"), (10, "LOW")
    }


def test_distributions_sum_to_rows(spark):
    scored = traffic_anomalies(V.network_traffic(spark, SMALL))
    enriched = prioritize_alerts(V.security_alerts(spark, SMALL))
    assert R.anomaly_distribution(scored).agg(F.sum("count")).first()[0] == scored.count()
    assert R.priority_distribution(enriched).agg(F.sum("count")).first()[0] == enriched.count()
    assert abs(R.priority_share(enriched).agg(F.sum("share")).first()[0] - 1.0) < 1e-12


def test_every_operator_accepts_empty_input(spark):
    from threatlens.operators import alerts as A
    from threatlens.operators import logins as L
    from threatlens.operators import traffic as T
    from threatlens.operators.contracts import NETWORK_TRAFFIC_CONTRACT, contract_violations
    from threatlens.schemas import LOGIN_ATTEMPTS, NETWORK_TRAFFIC, SECURITY_ALERTS, empty

    logins, traffic, alerts = (empty(spark, s) for s in (LOGIN_ATTEMPTS, NETWORK_TRAFFIC, SECURITY_ALERTS))
    outputs = [
        L.failed_login_metrics(logins), L.brute_force_bursts(logins), L.failures_by_zone(logins),
        L.success_after_failures(logins), T.traffic_anomalies(traffic), T.connection_gaps(traffic),
        T.port_scans(traffic), A.prioritize_alerts(alerts), A.incident_timelines(alerts), A.incident_steps(alerts),
    ]
    assert [df.count() for df in outputs] == [0] * len(outputs)
    assert {r["violations"] for r in contract_violations(traffic, NETWORK_TRAFFIC_CONTRACT).collect()} == {0}
    assert R.risk_bounds(L.failed_login_metrics(logins)).first().asDict() == {"slider_min": 0, "slider_max": 100}
