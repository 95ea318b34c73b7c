"""Named queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each query reads the driver's tables through the security views, so its work grows
with them.  Report queries run on the pipeline's results: failed-login metrics of all
logins, scores of all traffic, and the unresolved alerts (the extraction filter of
the pipeline).  Parameters are fixed per query; the matching DuckDB text lives in
``oracle.py`` under the same name.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threatlens.config import SCALED_LOGIN_RISK
from threatlens.operators import alerts as A
from threatlens.operators import contracts as C
from threatlens.operators import logins as L
from threatlens.operators import reports as R
from threatlens.operators import traffic as TR
from threatlens.plans import etl as P
from threatlens.schemas import SECURITY_ALERTS
from threatlens.session import scratch_path
from threatlens.sinks.clustering import write_clustered
from threatlens.sinks.writers import write_documents, write_snapshot
from threatlens.sources import documents as D
from threatlens.sources import snapshots as S
from threatlens.sources import variants as VR
from threatlens.plans.oracle import AS_OF_TRAFFIC
from threatlens.sources import views as V
from threatlens.streaming import incremental as ST
from threatlens.streaming import windows as W

Query = Callable[[SparkSession, str], DataFrame]

ALERT_COLUMNS = (
    "alert_id",
    "alert_type",
    "severity",
    "timestamp",
    "source",
    "description",
    "affected_system",
    "is_resolved",
    "incident_id",
    "severity_score",
    "priority",
    "action_required",
)


def alert_table(enriched: DataFrame) -> DataFrame:
    """Scalar alert columns (the detection map reduced to its incident id)."""
    return enriched.withColumn(
        "incident_id", F.col("detection_details").getItem("incident_id")
    ).select(*ALERT_COLUMNS)


def _failed(spark, d):
    return L.failed_login_metrics(V.login_attempts(spark, d))


def _scored(spark, d):
    return TR.traffic_anomalies(V.network_traffic(spark, d))


def _enriched(spark, d):
    return A.prioritize_alerts(A.unresolved(V.security_alerts(spark, d)))


def _all_alerts(spark, d):
    return A.prioritize_alerts(V.security_alerts(spark, d))


QUERIES: dict[str, Query] = {
    # composite scores
    "failed_login_metrics": _failed,
    "failed_login_metrics_scaled": lambda s, d: L.failed_login_metrics(
        V.login_attempts(s, d), SCALED_LOGIN_RISK
    ),
    "traffic_anomalies": _scored,
    "prioritized_alerts": lambda s, d: alert_table(_all_alerts(s, d)),
    "unresolved_alerts": lambda s, d: alert_table(_enriched(s, d)),
    # distributions and filters
    "risk_distribution": lambda s, d: R.risk_distribution(_failed(s, d)),
    "risk_distribution_range": lambda s, d: R.risk_distribution(_failed(s, d), 15, 50),
    "anomaly_distribution": lambda s, d: R.anomaly_distribution(_scored(s, d)),
    "high_anomalies": lambda s, d: _scored(s, d).filter(F.col("anomaly_score") > 50),
    "priority_distribution": lambda s, d: R.priority_distribution(_enriched(s, d)),
    "priority_share": lambda s, d: R.priority_share(_enriched(s, d)),
    "priority_selected": lambda s, d: R.priority_distribution(_enriched(s, d), ["HIGH", "LOW"]),
    "alert_type_distribution": lambda s, d: R.alert_type_distribution(
        _enriched(s, d), ["CRITICAL", "HIGH"]
    ),
    "action_summary": lambda s, d: R.action_summary(_enriched(s, d)),
    "urgent_alerts": lambda s, d: alert_table(
        _enriched(s, d).filter(F.col("priority").isin("CRITICAL", "HIGH"))
    ),
    # key figures
    "kpi_cards": lambda s, d: R.kpi_cards(_failed(s, d), _scored(s, d), _enriched(s, d)),
    "risk_bounds": lambda s, d: R.risk_bounds(_failed(s, d)),
    "run_summary": lambda s, d: R.run_summary_counts(
        V.login_attempts(s, d), _failed(s, d), _scored(s, d), _enriched(s, d)
    ),
    # table pages, highlight, time range, text
    "login_page": lambda s, d: R.page(
        R.filter_table(_failed(s, d), {"failed_attempt_count": (">=", 3)}),
        R.order_of("failed_logins"),
        page_no=1,
    ),
    "traffic_page": lambda s, d: R.page(
        R.filter_table(_scored(s, d), {"protocol": ("=", "SSH")}),
        R.order_of("suspicious_traffic"),
        page_no=2,
    ),
    "alert_page": lambda s, d: R.page(
        R.filter_table(alert_table(_enriched(s, d)), {"description": ("contains", "system 1")}),
        R.order_of("alerts_table"),
        page_no=0,
    ),
    "highlighted_logins": lambda s, d: R.highlight(
        L.failed_login_metrics(V.login_attempts(s, d), SCALED_LOGIN_RISK), "failed_logins"
    ),
    "recent_traffic": lambda s, d: R.recent_traffic(V.network_traffic(s, d), AS_OF_TRAFFIC, "30d"),
    "timestamps_as_text": lambda s, d: R.timestamps_as_text(_failed(s, d)),
    # explicit previous-connection gaps (the lag behind rapid_connection)
    "connection_gaps": lambda s, d: TR.connection_gaps(V.network_traffic(s, d)),
    # attack-pattern detectors
    "brute_force_bursts": lambda s, d: L.brute_force_bursts(
        V.login_attempts(s, d), keys=("username",), max_gap_s=86400, min_attempts=3
    ),
    "port_scans": lambda s, d: TR.port_scans(
        V.network_traffic(s, d), keys=("source_ip",), window="30 days", min_ports=5
    ),
    "incident_timelines": lambda s, d: A.incident_timelines(V.security_alerts(s, d), min_steps=4),
    "incident_steps": lambda s, d: A.incident_steps(V.security_alerts(s, d)),
    "sliding_port_scans": lambda s, d: TR.sliding_port_scans(
        V.network_traffic(s, d), keys=("source_ip",), window_s=30 * 86400, slide_s=10 * 86400, min_ports=8
    ),
    "refresh_charts": lambda s, d: R.refresh_charts(_failed(s, d), _scored(s, d), _enriched(s, d), (15, 50), ["CRITICAL", "HIGH"]),
    "incident_chains": lambda s, d: A.incident_chains(V.security_alerts(s, d), min_steps=2),
    "failures_by_zone": lambda s, d: L.failures_by_zone(V.login_attempts(s, d)),
    "success_after_failures": lambda s, d: L.success_after_failures(
        V.login_attempts(s, d), look_back=3, min_failures=2
    ),
    "key_violations": lambda s, d: C.key_violations(V.network_traffic(s, d), C.NETWORK_TRAFFIC_CONTRACT).unionByName(
        C.key_violations(V.login_attempts(s, d), C.LOGIN_ATTEMPTS_CONTRACT)
    ),
    "contract_violations": lambda s, d: C.contract_violations(
        V.network_traffic(s, d), C.NETWORK_TRAFFIC_CONTRACT
    ).unionByName(
        C.contract_violations(V.login_attempts(s, d), C.LOGIN_ATTEMPTS_CONTRACT)
    ).unionByName(
        C.contract_violations(_failed(s, d), C.FAILED_LOGIN_METRICS_CONTRACT)
    ).unionByName(
        C.contract_violations(_scored(s, d), C.SUSPICIOUS_TRAFFIC_CONTRACT)
    ),
}


def csv_snapshot_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failed-login metrics written as a CSV snapshot and read back (typed)."""
    root = scratch_path(spark, "snapshots")
    write_snapshot(_failed(spark, sf_dir), root, "failed_logins", "20240101_000000")
    return S.read_snapshot(spark, root, "failed_logins")


def documents_normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts exported as JSON-lines documents, read back with the fixed schema and
    the document query {"is_resolved": False}, then prioritized."""
    path = scratch_path(spark, "alert-documents")
    write_documents(V.security_alerts(spark, sf_dir), path)
    docs = D.read_documents(spark, path, query={"is_resolved": False})
    return alert_table(A.prioritize_alerts(docs))


def mixed_documents(alerts: DataFrame) -> DataFrame:
    """Alerts as JSON documents whose details differ in their fields and types, one in a
    column ``value``: steps of an incident, a port and protocol, or a port as text with the
    zone and hops that led to it."""
    details = F.col("detection_details")
    common = [F.col(c) for c in ("alert_id", "alert_type", "severity", "timestamp", "source", "description", "affected_system", "is_resolved")]
    port = F.pmod("alert_id", F.lit(60000)).cast("int")
    shapes = [
        F.struct(details["ip_address"].alias("ip_address"), details["username"].alias("username"), details["incident_id"].alias("incident_id"), (F.pmod("alert_id", F.lit(6)) + 1).alias("step")),
        F.struct(details["ip_address"].alias("ip_address"), port.alias("port"), F.lit("TCP").alias("protocol"), F.when(F.pmod("alert_id", F.lit(2)) == 0, details["username"]).alias("username")),
        F.struct(
            F.concat(F.lit("udp/"), port).alias("port"),
            F.struct(F.lit("dmz").alias("zone"), F.sequence(F.lit(1), (F.pmod("alert_id", F.lit(3)) + 1)).alias("hops")).alias("route"),
        ),
    ]
    text = [F.to_json(F.struct(*common, shape.alias("detection_details")), {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss"}) for shape in shapes]
    kind = F.pmod(F.floor(F.col("alert_id") / 2), F.lit(3))
    return alerts.select(F.when(kind == 0, text[0]).when(kind == 1, text[1]).otherwise(text[2]).alias("value"))


def _open_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "open-documents")
    mixed_documents(V.security_alerts(spark, sf_dir)).write.text(path)
    return VR.read_open_documents(spark, path)


def document_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alert documents of unknown shape: every path, its merged type and its documents."""
    return VR.field_profile(_open_documents(spark, sf_dir))


DETAIL_FIELDS = {
    "detail_port": ("detection_details.port", "int"),
    "port_text": ("detection_details.port", "string"),
    "protocol": ("detection_details.protocol", "string"),
    "step": ("detection_details.step", "int"),
    "zone": ("detection_details.route.zone", "string"),
    "last_hop": ("detection_details.route.hops", "array<int>"),
}


def alerts_from_open_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same documents typed: the declared columns, scored, and details that no schema
    declares; a port that is text is null as a number and kept as text."""
    docs = VR.typed_documents(_open_documents(spark, sf_dir), SECURITY_ALERTS)
    scored = A.prioritize_alerts(A.unresolved(docs))
    out = scored.select(
        "alert_id", "alert_type", "timestamp", F.col("detection_details")["incident_id"].alias("incident_id"), "severity_score", "priority",
        *VR.extract(F.col(VR.DOCUMENT), DETAIL_FIELDS),
    )
    return out.withColumn("last_hop", F.element_at("last_hop", -1))


def deep_traffic_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page 5,000 of the scored traffic, read from its snapshot."""
    root = scratch_path(spark, "deep-page")
    write_snapshot(_scored(spark, sf_dir), root, "suspicious_traffic", "20240101_000000", fmt="parquet")
    scored = S.read_snapshot(spark, root, "suspicious_traffic", "20240101_000000", fmt="parquet")
    return R.table_page(scored, "suspicious_traffic", 5000)


def clustered_traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored traffic in files clustered by score, source and time, and the rows of a filter on
    two of them, which skips the row groups elsewhere on the curve."""
    path = f"{scratch_path(spark, 'clustered')}/suspicious_traffic"
    root = scratch_path(spark, "clustered-source")
    write_snapshot(_scored(spark, sf_dir), root, "suspicious_traffic", "20240101_000000", fmt="parquet")
    scored = S.read_snapshot(spark, root, "suspicious_traffic", "20240101_000000", fmt="parquet")
    write_clustered(scored, path, ["anomaly_score", "source_ip", "timestamp"])
    recent = F.col("timestamp") >= F.lit("1998-01-01 00:00:00").cast("timestamp_ntz")
    return spark.read.parquet(path).filter((F.col("anomaly_score") >= 80) & recent)


#: Rows of a stream's source file, about: a task writes one and reads one.
STREAM_FILE_ROWS = 500_000


def _stream(spark: SparkSession, sf_dir: str, table: str, name: str, batches: int = 4) -> tuple[DataFrame, str, str]:
    """The table as a stream of files that are not in time order, a share of them for each
    micro-batch; and the folders for its results and its checkpoint."""
    root = scratch_path(spark, name)
    rows = V.table(spark, sf_dir, table)
    each = max(1, -(-rows.count() // (batches * STREAM_FILE_ROWS)))
    rows.repartition(batches * each, F.hash(*rows.columns)).write.parquet(f"{root}/source")
    return ST.read_stream(spark, f"{root}/source", max_files_per_trigger=each), f"{root}/out", f"{root}/checkpoint"


ONCE = ST.Trigger(available_now=True)


def stream_failed_logins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R1: events as a file stream, failed logins kept as partial results by batch."""
    events, out, ckpt = _stream(spark, sf_dir, "events", "stream-logins")
    ST.failed_logins_stream(V.login_attempts_from_events(events), out, ckpt, ONCE).awaitTermination()
    return ST.read_failed_logins(spark, out)


def stream_failed_logins_windowed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R1, windowed: hourly failed-login metrics of all rows."""
    events, out, ckpt = _stream(spark, sf_dir, "events", "stream-logins-windowed")
    ST.windowed_failed_logins_stream(V.login_attempts_from_events(events), out, ckpt, 3600, ONCE).awaitTermination()
    return ST.read_windowed_failed_logins(spark, out, 3600)


def stream_brute_force_bursts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1 on a stream: sessions of failed logins per user (gap: 1 day)."""
    events, out, ckpt = _stream(spark, sf_dir, "events", "stream-bursts")
    keys = ("username",)
    ST.brute_force_bursts_stream(V.login_attempts_from_events(events), out, ckpt, keys, 86400, ONCE).awaitTermination()
    return ST.read_bursts(spark, out, keys, 86400, min_attempts=3)


def stream_port_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D2 on a stream: distinct ports per source and 30-day window."""
    lineitem, out, ckpt = _stream(spark, sf_dir, "lineitem", "stream-scans")
    keys, window = ("source_ip",), 30 * 86400
    ST.port_scans_stream(V.network_traffic_from_lineitem(lineitem), out, ckpt, keys, window, ONCE).awaitTermination()
    return ST.read_port_scans(spark, out, keys, window, min_ports=5)


def stream_traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R2: lineitem as a file stream, scored per micro-batch; rows that come before stored
    ones included.  Each file spans the table's seven years, hence the long period."""
    lineitem, out, ckpt = _stream(spark, sf_dir, "lineitem", "stream-traffic")
    traffic = V.network_traffic_from_lineitem(lineitem)
    ST.score_traffic_stream(traffic, out, ckpt, trigger=ONCE, period_s=365 * 86400).awaitTermination()
    return ST.read_scored(spark, out)


def stream_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R3: orders as a file stream, unresolved alerts prioritized (stateless)."""
    orders, out, ckpt = _stream(spark, sf_dir, "orders", "stream-alerts")
    ST.score_alerts_stream(V.security_alerts_from_orders(orders), out, ckpt, trigger=ONCE).awaitTermination()
    return alert_table(spark.read.parquet(out))


def _timely_files(spark: SparkSession, sf_dir: str, name: str, late: bool) -> tuple[DataFrame, str, str]:
    """The logins as a stream of four or five files, eight days each in time order, read one
    a micro-batch; with ``late``, every seventh login comes one file later."""
    root = scratch_path(spark, name)
    logins = V.login_attempts(spark, sf_dir)
    behind = F.when(F.lit(late) & (F.pmod("attempt_id", F.lit(7)) == 0), 1).otherwise(0)
    numbered = logins.withColumn("_file", F.least(F.floor((F.dayofmonth("timestamp") - 1) / 8), F.lit(3)) + behind)
    for k in range(4 + late):  # one by one: the stream takes them by their time
        numbered.filter(F.col("_file") == k).drop("_file").coalesce(1).write.mode("append").parquet(f"{root}/source")
    stream = ST.read_stream(spark, f"{root}/source", schema=logins.schema, max_files_per_trigger=1)
    return stream, f"{root}/out", f"{root}/checkpoint"


def stream_finished_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R1 with a watermark of a day: hourly failed logins of the windows that are closed."""
    logins, out, ckpt = _timely_files(spark, sf_dir, "finished-windows", late=True)
    W.finished_windows_stream(logins, out, ckpt, "1 hour", "1 day", ONCE).awaitTermination()
    return W.read_finished_windows(spark, out)


def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows and late groups of each batch of that stream, from its progress."""
    logins, out, ckpt = _timely_files(spark, sf_dir, "late-rows", late=True)
    query = W.finished_windows_stream(logins, out, ckpt, "1 hour", "1 day", ONCE)
    query.awaitTermination()
    return spark.createDataFrame(W.late_groups(query), "batch long, input_rows long, late_groups long")


def stream_closed_bursts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1 as session windows: the bursts that no later failure can continue."""
    logins, out, ckpt = _timely_files(spark, sf_dir, "closed-bursts", late=False)
    W.closed_bursts_stream(logins, out, ckpt, ("username",), 86400, 3, trigger=ONCE).awaitTermination()
    return spark.read.parquet(out)


QUERIES.update(
    {
        "stream_failed_logins": stream_failed_logins,
        "stream_failed_logins_windowed": stream_failed_logins_windowed,
        "stream_brute_force_bursts": stream_brute_force_bursts,
        "stream_port_scans": stream_port_scans,
        "stream_finished_windows": stream_finished_windows,
        "stream_late_rows": stream_late_rows,
        "stream_closed_bursts": stream_closed_bursts,
        "stream_traffic": stream_traffic,
        "stream_alerts": stream_alerts,
        "csv_snapshot_roundtrip": csv_snapshot_roundtrip,
        "documents_normalized": documents_normalized,
        "document_fields": document_fields,
        "alerts_from_open_documents": alerts_from_open_documents,
        "deep_traffic_page": deep_traffic_page,
        "clustered_traffic": clustered_traffic,
        "etl_run_summary": P.etl_run_summary,
        "latest_snapshot": P.refreshed_priorities,
    }
)


def queries() -> dict[str, Query]:
    return dict(QUERIES)
