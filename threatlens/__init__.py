"""threatlens: security-event analytics (login risk, traffic anomalies, alert
priority, attack-pattern detectors and reports) as Spark DataFrame plans.

    from threatlens import build_session, views, failed_login_metrics
    spark = build_session()
    failed = failed_login_metrics(views.login_attempts(spark, "/data/sf0.1"))
"""

from threatlens.config import AlertRules, LoginRiskRules, PipelineConfig, TrafficRules, Zones
from threatlens.operators.alerts import incident_steps, incident_timelines, prioritize_alerts, unresolved
from threatlens.operators.contracts import Contract, contract_violations
from threatlens.operators.logins import (
    brute_force_bursts,
    failed_login_metrics,
    failures_by_zone,
    success_after_failures,
)
from threatlens.operators.traffic import connection_gaps, port_scans, rapid_connections, traffic_anomalies
from threatlens.functions.sequence import with_previous, with_sequence
from threatlens.plans.etl import report_refresh, run_pipeline
from threatlens.schemas import conform
from threatlens.session import build_session, cluster_conf
from threatlens.sources import views

__version__ = "0.1.0"

__all__ = [
    "AlertRules",
    "Contract",
    "LoginRiskRules",
    "PipelineConfig",
    "TrafficRules",
    "Zones",
    "brute_force_bursts",
    "build_session",
    "cluster_conf",
    "conform",
    "connection_gaps",
    "contract_violations",
    "failed_login_metrics",
    "failures_by_zone",
    "incident_steps",
    "incident_timelines",
    "port_scans",
    "prioritize_alerts",
    "rapid_connections",
    "report_refresh",
    "run_pipeline",
    "success_after_failures",
    "traffic_anomalies",
    "unresolved",
    "views",
    "with_previous",
    "with_sequence",
]
