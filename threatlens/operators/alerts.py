"""Alert operators: prioritization (C3), incident timelines and chains (D3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threatlens.config import AlertRules
from threatlens.functions.scoring import action_required, priority, severity_score, unix_seconds
from threatlens.functions.sequence import ordered_runs, with_sequence

ALERT_ORDER = ("timestamp", "alert_id")


def prioritize_alerts(alerts: DataFrame, rules: AlertRules = AlertRules()) -> DataFrame:
    """All alert columns plus severity_score, priority and action_required.
    A pure projection: no shuffle, fused into the scan's codegen stage."""
    scored = alerts.withColumn("severity_score", severity_score(F.col("severity"), rules))
    return scored.withColumns(
        {
            "priority": priority(F.col("severity_score"), rules),
            "action_required": action_required(
                F.col("is_resolved"), F.col("severity_score"), rules
            ),
        }
    )


def unresolved(alerts: DataFrame) -> DataFrame:
    """The extraction filter ``is_resolved = false`` (pushed into the scan)."""
    return alerts.filter(F.col("is_resolved") == F.lit(False))


def _incident(alerts: DataFrame) -> DataFrame:
    return alerts.withColumn("incident_id", F.col("detection_details").getItem("incident_id")).filter(
        F.col("incident_id").isNotNull()
    )


def incident_steps(alerts: DataFrame) -> DataFrame:
    """One row per alert of an incident with its step number (1-based, in time order,
    alert_id breaking ties).  The numbering is exact and skew-safe (``with_sequence``):
    a multi-million-alert incident is spread over many tasks."""
    seq = with_sequence(
        _incident(alerts).select(
            "incident_id", "alert_id", "timestamp", "alert_type", "severity", "is_resolved"
        ),
        keys=["incident_id"],
        order=list(ALERT_ORDER),
    )
    return seq.withColumnRenamed("seq", "step")


def incident_timelines(alerts: DataFrame, min_steps: int = 1) -> DataFrame:
    """Per incident: number of steps, first/last time, duration, unresolved steps,
    the first and last alert type and the number of distinct types.

    One ``groupBy`` with partial aggregation (``min_by``/``max_by`` on the time order,
    counts, a two-phase distinct count), so the shuffle is bounded whatever the
    incident size; the full ordered chain is the long table of ``incident_steps``,
    never one list per group.
    """
    order_key = F.struct(*[F.col(c) for c in ALERT_ORDER])
    grouped = _incident(alerts).groupBy("incident_id").agg(
        F.count(F.lit(1)).alias("steps"),
        F.min("timestamp").alias("first_seen"),
        F.max("timestamp").alias("last_seen"),
        F.count_if(F.col("is_resolved") == F.lit(False)).alias("unresolved_steps"),
        F.min_by("alert_type", order_key).alias("first_alert_type"),
        F.max_by("alert_type", order_key).alias("last_alert_type"),
        F.count_distinct("alert_type").alias("distinct_alert_types"),
    )
    return grouped.filter(F.col("steps") >= min_steps).withColumn(
        "duration_seconds", unix_seconds(F.col("last_seen")) - unix_seconds(F.col("first_seen"))
    )


def incident_chains(alerts: DataFrame, min_steps: int = 1) -> DataFrame:
    """Per incident: its steps and its alert types in time order (alert_id breaking ties)
    as one text, equal neighbours counted: ``Brute Force x3 > Ransomware``.

    The steps of an incident are folded where they are sorted, a piece for each range
    partition (``ordered_runs``), so an incident of millions of alerts is never one list."""
    steps = _incident(alerts).select("incident_id", "alert_id", "timestamp", "alert_type")
    chains = ordered_runs(steps, ["incident_id"], list(ALERT_ORDER), "alert_type")
    return chains.filter(F.col("rows") >= min_steps).select("incident_id", F.col("rows").alias("steps"), "runs", "chain")
