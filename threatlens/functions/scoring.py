"""Scoring rules as native Column expressions (no UDFs: they stay inside codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from threatlens.config import PRIORITY_ORDER, AlertRules, LoginRiskRules, TrafficRules
from threatlens.functions.columns import is_true


def unix_seconds(ts: Column) -> Column:
    """Whole epoch seconds (floor), the unit all gaps and spans are measured in."""
    return F.unix_timestamp(ts)


def risk_score(count: Column, span_s: Column, rules: LoginRiskRules = LoginRiskRules()) -> Column:
    """Risk of a failed-login group; inclusive bounds, first match wins."""
    burst = (
        F.when(span_s <= rules.band_100_s, 100)
        .when(span_s <= rules.band_80_s, 80)
        .when(span_s <= rules.band_50_s, 50)
        .otherwise(30)
    )
    return (
        F.when(count >= rules.burst_count, burst).when(count >= rules.repeat_count, 20).otherwise(10)
    )


def attempts_per_minute(count: Column, span_s: Column) -> Column:
    """count / (span / 60); null when the span is zero (a single failure or one second)."""
    return F.try_divide(count.cast("double"), span_s / F.lit(60))


def suspicious_port(port: Column, rules: TrafficRules = TrafficRules()) -> Column:
    return is_true(port.isin(*rules.suspicious_ports))


def large_packet(size: Column, rules: TrafficRules = TrafficRules()) -> Column:
    return is_true(size > rules.large_packet_bytes)


def anomaly_score(suspicious: Column, rapid: Column, port_flag: Column, large: Column) -> Column:
    """Traffic anomaly; a null ``is_suspicious`` falls through to the other rules."""
    return (
        F.when(is_true(suspicious), 100)
        .when(rapid & port_flag, 80)
        .when(rapid | port_flag, 50)
        .when(large, 30)
        .otherwise(10)
    )


def severity_score(severity: Column, rules: AlertRules = AlertRules()) -> Column:
    expr = None
    for name, score in rules.severity_scores:
        expr = F.when(severity == name, score) if expr is None else expr.when(severity == name, score)
    return expr.otherwise(rules.default_score)


def priority(score: Column, rules: AlertRules = AlertRules()) -> Column:
    expr = None
    for bound, name in rules.priority_bands:
        expr = F.when(score >= bound, name) if expr is None else expr.when(score >= bound, name)
    return expr.otherwise(rules.default_priority)


def action_required(resolved: Column, score: Column, rules: AlertRules = AlertRules()) -> Column:
    """Unresolved and at least the action score; a null ``is_resolved`` is no action."""
    return is_true(~resolved & (score >= rules.action_min_score))


def priority_rank(p: Column) -> Column:
    """Fixed report order CRITICAL, HIGH, MEDIUM, LOW (unknown values last)."""
    expr = None
    for i, name in enumerate(PRIORITY_ORDER):
        expr = F.when(p == name, i) if expr is None else expr.when(p == name, i)
    return expr.otherwise(len(PRIORITY_ORDER))
