"""Independent DuckDB formulations of the registered queries.

Each string runs on the driver's tables (pre-registered views ``events``,
``lineitem``, ``orders`` ...).  The security views are defined again here in SQL, and
every operator is written the direct way (LAG windows, gaps-and-islands, ROW_NUMBER)
rather than the way the Spark plans compute it, so that agreement is evidence.

DuckDB notes: ``unix(t)`` below is an exact floor of epoch microseconds, ``x/0`` is
avoided with NULLIF, integer sums are cast back to BIGINT, ASC sorts are given NULLS
FIRST to match Spark.
"""

from __future__ import annotations

from threatlens.config import (
    ALERT_TYPES,
    LOCATIONS,
    LOGIN_ADDRESSES,
    PROTOCOLS,
    SCALED_LOGIN_RISK,
    SEVERITY_BY_ORDER_PRIORITY,
    TRAFFIC_PORTS,
    LoginRiskRules,
)


def _lit(v) -> str:
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return str(v)


def _pick(values, key: str) -> str:
    n = len(values)
    return f"[{', '.join(_lit(v) for v in values)}][((({key}) % {n}) + {n}) % {n} + 1]"


def _pmod(key: str, n: int) -> str:
    return f"((({key}) % {n}) + {n}) % {n}"


def unix(col: str) -> str:
    """Whole epoch seconds, floored, as BIGINT (Spark unix_timestamp)."""
    us = f"epoch_us({col})"
    return f"(({us} - ((({us}) % 1000000) + 1000000) % 1000000) // 1000000)"


SEVERITY_CASE = (
    "CASE o_orderpriority "
    + " ".join(f"WHEN {_lit(k)} THEN {_lit(v)}" for k, v in SEVERITY_BY_ORDER_PRIORITY)
    + " END"
)

VIEWS = f"""
login_attempts AS (
  SELECT event_id AS attempt_id,
         'user' || user_id AS username,
         ts AS "timestamp",
         {_pick(LOGIN_ADDRESSES, "event_id")} AS ip_address,
         event_type <> 'error' AS success,
         event_type AS user_agent,
         {_pick(LOCATIONS, "user_id")} AS location
  FROM events),
network_traffic AS (
  SELECT l_orderkey * 10 + l_linenumber AS traffic_id,
         '192.168.1.' || {_pmod("l_suppkey", 255)} AS source_ip,
         '10.0.0.' || {_pmod("l_partkey", 255)} AS destination_ip,
         {_pick(PROTOCOLS, "l_linenumber")} AS protocol,
         CAST({_pick(TRAFFIC_PORTS, "l_partkey")} AS INTEGER) AS port,
         CAST(trunc(l_quantity * 40) AS INTEGER) AS packet_size,
         l_shipdate AS "timestamp",
         l_returnflag = 'R' AND l_linestatus = 'F' AS is_suspicious,
         l_partkey AS tie_key
  FROM lineitem),
security_alerts AS (
  SELECT o_orderkey AS alert_id,
         {_pick(ALERT_TYPES, "o_custkey")} AS alert_type,
         {SEVERITY_CASE} AS severity,
         o_orderdate AS "timestamp",
         'IDS-' || ({_pmod("o_orderkey", 5)} + 1) AS source,
         'Security alert detected on system ' || {_pmod("o_orderkey", 20)} AS description,
         'Server-' || ({_pmod("o_custkey", 10)} + 1) AS affected_system,
         o_orderstatus = 'F' AS is_resolved,
         '192.168.1.' || {_pmod("o_custkey", 255)} AS detail_ip_address,
         'user' || {_pmod("o_custkey", 150)} AS detail_username,
         'INC-' || o_custkey AS incident_id
  FROM orders)"""


def _failed(rules: LoginRiskRules, name: str = "failed_logins", src: str = "login_attempts") -> str:
    span = "time_span_seconds"
    return f"""
{name}_g AS (
  SELECT username, ip_address, count(*) AS failed_attempt_count,
         min("timestamp") AS first_attempt, max("timestamp") AS last_attempt
  FROM {src} WHERE NOT success GROUP BY username, ip_address),
{name}_s AS (
  SELECT *, {unix("last_attempt")} - {unix("first_attempt")} AS {span} FROM {name}_g),
{name} AS (
  SELECT username, ip_address, failed_attempt_count, first_attempt, last_attempt, {span},
         failed_attempt_count / NULLIF(CAST({span} AS DOUBLE) / 60, 0) AS attempts_per_minute,
         CASE WHEN failed_attempt_count >= {rules.burst_count} THEN
                CASE WHEN {span} <= {rules.band_100_s} THEN 100
                     WHEN {span} <= {rules.band_80_s} THEN 80
                     WHEN {span} <= {rules.band_50_s} THEN 50 ELSE 30 END
              WHEN failed_attempt_count >= {rules.repeat_count} THEN 20 ELSE 10 END AS risk_score
  FROM {name}_s)"""


SCORED_TRAFFIC = f"""
traffic_lag AS (
  SELECT *, LAG("timestamp") OVER (PARTITION BY source_ip
             ORDER BY "timestamp" ASC NULLS FIRST, traffic_id ASC NULLS FIRST, tie_key ASC NULLS FIRST)
           AS prev_timestamp
  FROM network_traffic),
traffic_flags AS (
  SELECT *,
         COALESCE(CASE WHEN prev_timestamp IS NOT NULL
                       THEN {unix('"timestamp"')} - {unix("prev_timestamp")} END < 1, false) AS rapid_connection,
         COALESCE(port IN (22, 3389, 445, 1433, 3306, 5432), false) AS suspicious_port,
         COALESCE(packet_size > 1000, false) AS large_packet
  FROM traffic_lag),
scored_traffic AS (
  SELECT traffic_id, source_ip, destination_ip, protocol, port, "timestamp", packet_size,
         is_suspicious, rapid_connection, suspicious_port, large_packet,
         CASE WHEN COALESCE(is_suspicious, false) THEN 100
              WHEN rapid_connection AND suspicious_port THEN 80
              WHEN rapid_connection OR suspicious_port THEN 50
              WHEN large_packet THEN 30 ELSE 10 END AS anomaly_score
  FROM traffic_flags)"""


def _enriched(name: str, where: str) -> str:
    return f"""
{name}_s AS (
  SELECT *, CASE severity WHEN 'HIGH' THEN 100 WHEN 'MEDIUM' THEN 50 WHEN 'LOW' THEN 20 ELSE 10 END
            AS severity_score
  FROM security_alerts {where}),
{name} AS (
  SELECT alert_id, alert_type, severity, "timestamp", source, description, affected_system,
         is_resolved, incident_id, severity_score,
         CASE WHEN severity_score >= 80 THEN 'CRITICAL' WHEN severity_score >= 50 THEN 'HIGH'
              WHEN severity_score >= 20 THEN 'MEDIUM' ELSE 'LOW' END AS priority,
         COALESCE(NOT is_resolved AND severity_score >= 50, false) AS action_required
  FROM {name}_s)"""


ALL_ALERTS = _enriched("all_alerts", "")
ENRICHED = _enriched("enriched_alerts", "WHERE is_resolved = false")

BASE = ",".join([VIEWS, _failed(LoginRiskRules()), SCORED_TRAFFIC, ALL_ALERTS, ENRICHED])


def _q(body: str, extra: str = "") -> str:
    ctes = BASE + ("," + extra if extra else "")
    return f"WITH {ctes}\n{body}"


_ALERT_COLS = (
    'alert_id, alert_type, severity, "timestamp", source, description, affected_system, '
    "is_resolved, incident_id, severity_score, priority, action_required"
)

AS_OF_TRAFFIC = "1998-08-02 00:00:00"

ORACLE: dict[str, str] = {
    "failed_login_metrics": _q("SELECT * FROM failed_logins"),
    "failed_login_metrics_scaled": _q(
        "SELECT * FROM scaled_logins", _failed(SCALED_LOGIN_RISK, name="scaled_logins")
    ),
    "traffic_anomalies": _q("SELECT * FROM scored_traffic"),
    "prioritized_alerts": _q(f"SELECT {_ALERT_COLS} FROM all_alerts"),
    "unresolved_alerts": _q(f"SELECT {_ALERT_COLS} FROM enriched_alerts"),
    "risk_distribution": _q("SELECT risk_score, count(*) AS count FROM failed_logins GROUP BY risk_score"),
    "risk_distribution_range": _q(
        "SELECT risk_score, count(*) AS count FROM failed_logins "
        "WHERE risk_score BETWEEN 15 AND 50 GROUP BY risk_score"
    ),
    "anomaly_distribution": _q(
        "SELECT anomaly_score, count(*) AS count FROM scored_traffic GROUP BY anomaly_score"
    ),
    "high_anomalies": _q("SELECT * FROM scored_traffic WHERE anomaly_score > 50"),
    "priority_distribution": _q(
        "SELECT priority, count(*) AS count, "
        "CASE priority WHEN 'CRITICAL' THEN 0 WHEN 'HIGH' THEN 1 WHEN 'MEDIUM' THEN 2 "
        "WHEN 'LOW' THEN 3 ELSE 4 END AS sort_order FROM enriched_alerts GROUP BY priority"
    ),
    "priority_share": _q(
        "SELECT priority, count(*) AS count, "
        "CASE priority WHEN 'CRITICAL' THEN 0 WHEN 'HIGH' THEN 1 WHEN 'MEDIUM' THEN 2 "
        "WHEN 'LOW' THEN 3 ELSE 4 END AS sort_order, "
        "count(*) / sum(count(*)) OVER () AS share FROM enriched_alerts GROUP BY priority"
    ),
    "priority_selected": _q(
        "SELECT priority, count(*) AS count, "
        "CASE priority WHEN 'CRITICAL' THEN 0 WHEN 'HIGH' THEN 1 WHEN 'MEDIUM' THEN 2 "
        "WHEN 'LOW' THEN 3 ELSE 4 END AS sort_order FROM enriched_alerts "
        "WHERE priority IN ('HIGH', 'LOW') GROUP BY priority"
    ),
    "alert_type_distribution": _q(
        "SELECT alert_type, count(*) AS count FROM enriched_alerts "
        "WHERE priority IN ('CRITICAL', 'HIGH') GROUP BY alert_type"
    ),
    "action_summary": _q(
        "SELECT action_required, count(*) AS count FROM enriched_alerts GROUP BY action_required"
    ),
    "urgent_alerts": _q(f"SELECT {_ALERT_COLS} FROM enriched_alerts WHERE priority IN ('CRITICAL', 'HIGH')"),
    "kpi_cards": _q(
        """SELECT 'failed_logins' AS card, count(*) AS total, count(*) FILTER (WHERE risk_score >= 80) AS flagged
             FROM failed_logins
           UNION ALL
           SELECT 'suspicious_traffic', count(*), count(*) FILTER (WHERE anomaly_score >= 80) FROM scored_traffic
           UNION ALL
           SELECT 'security_alerts', count(*), count(*) FILTER (WHERE priority = 'CRITICAL') FROM enriched_alerts
           UNION ALL
           SELECT 'actions_required', count(*) FILTER (WHERE action_required),
                  count(*) FILTER (WHERE action_required) FROM enriched_alerts"""
    ),
    "risk_bounds": _q(
        "SELECT least(coalesce(min(risk_score), 0), 0) AS slider_min, "
        "greatest(coalesce(max(risk_score), 100), 100) AS slider_max FROM failed_logins"
    ),
    "run_summary": _q(
        """SELECT 'login_attempts_extracted' AS metric, count(*) AS value FROM login_attempts
           UNION ALL SELECT 'failed_login_metrics', count(*) FROM failed_logins
           UNION ALL SELECT 'traffic_records_extracted', count(*) FROM network_traffic
           UNION ALL SELECT 'suspicious_traffic_patterns', count(*) FILTER (WHERE anomaly_score > 50)
                     FROM scored_traffic
           UNION ALL SELECT 'security_alerts_processed', count(*) FROM security_alerts
                     WHERE is_resolved = false
           UNION ALL SELECT 'critical_high_alerts', count(*) FILTER (WHERE priority IN ('CRITICAL', 'HIGH'))
                     FROM enriched_alerts"""
    ),
    "login_page": _q(
        "SELECT * FROM failed_logins WHERE failed_attempt_count >= 3 "
        "ORDER BY risk_score DESC, username ASC NULLS FIRST, ip_address ASC NULLS FIRST "
        "LIMIT 10 OFFSET 10"
    ),
    "traffic_page": _q(
        "SELECT * FROM scored_traffic WHERE protocol = 'SSH' "
        'ORDER BY anomaly_score DESC, "timestamp" ASC NULLS FIRST, traffic_id ASC NULLS FIRST, '
        "source_ip ASC NULLS FIRST, destination_ip ASC NULLS FIRST, port ASC NULLS FIRST "
        "LIMIT 10 OFFSET 20"
    ),
    "alert_page": _q(
        f"SELECT {_ALERT_COLS} FROM enriched_alerts WHERE description LIKE '%system 1%' "
        "ORDER BY severity_score DESC, action_required DESC, alert_id ASC NULLS FIRST LIMIT 10 OFFSET 0"
    ),
    "highlighted_logins": _q(
        "SELECT *, CASE WHEN risk_score >= 80 THEN 'high-risk' END AS highlight FROM scaled_logins",
        _failed(SCALED_LOGIN_RISK, name="scaled_logins"),
    ),
    "recent_traffic": _q(
        "SELECT * FROM scored_traffic "
        f"WHERE \"timestamp\" BETWEEN TIMESTAMP '{AS_OF_TRAFFIC}' - INTERVAL 30 DAY AND TIMESTAMP '{AS_OF_TRAFFIC}'"
    ),
    "timestamps_as_text": _q(
        "SELECT username, ip_address, failed_attempt_count, "
        "strftime(first_attempt, '%Y-%m-%d %H:%M:%S') AS first_attempt, "
        "strftime(last_attempt, '%Y-%m-%d %H:%M:%S') AS last_attempt, "
        "time_span_seconds, attempts_per_minute, risk_score FROM failed_logins"
    ),
    "connection_gaps": _q(
        f"""SELECT traffic_id, tie_key, source_ip, "timestamp", prev_timestamp,
                  CASE WHEN prev_timestamp IS NOT NULL
                       THEN {unix('"timestamp"')} - {unix("prev_timestamp")} END AS time_diff_seconds
           FROM traffic_lag"""
    ),
    "brute_force_bursts": _q(
        f"""SELECT username, min("timestamp") AS burst_start, max("timestamp") AS burst_end,
                  {unix('max("timestamp")')} - {unix('min("timestamp")')} AS duration_seconds,
                  count(*) AS attempts
           FROM bf_sessions GROUP BY username, burst HAVING count(*) >= 3""",
        f"""
bf_fail AS (
  SELECT username, "timestamp", {unix('"timestamp"')} AS sec
  FROM login_attempts WHERE NOT success AND "timestamp" IS NOT NULL),
bf_lag AS (
  SELECT *, LAG(sec) OVER (PARTITION BY username ORDER BY sec, "timestamp") AS prev_sec FROM bf_fail),
bf_sessions AS (
  SELECT *, SUM(CASE WHEN prev_sec IS NULL OR sec - prev_sec > 86400 THEN 1 ELSE 0 END)
              OVER (PARTITION BY username ORDER BY sec, "timestamp" ROWS UNBOUNDED PRECEDING) AS burst
  FROM bf_lag)""",
    ),
    "port_scans": _q(
        f"""SELECT source_ip, make_timestamp(ws * 1000000) AS window_start,
                  make_timestamp((ws + 2592000) * 1000000) AS window_end,
                  count(DISTINCT port) AS distinct_ports, count(*) AS connections,
                  min("timestamp") AS first_seen, max("timestamp") AS last_seen
           FROM (SELECT *, {unix('"timestamp"')} - (({unix('"timestamp"')} % 2592000) + 2592000) % 2592000 AS ws
                 FROM network_traffic WHERE "timestamp" IS NOT NULL)
           GROUP BY source_ip, ws HAVING count(DISTINCT port) >= 5"""
    ),
    "incident_timelines": _q(
        f"""SELECT incident_id, count(*) AS steps, min("timestamp") AS first_seen,
                  max("timestamp") AS last_seen,
                  count(*) FILTER (WHERE is_resolved = false) AS unresolved_steps,
                  max(CASE WHEN rn_first = 1 THEN alert_type END) AS first_alert_type,
                  max(CASE WHEN rn_last = 1 THEN alert_type END) AS last_alert_type,
                  count(DISTINCT alert_type) AS distinct_alert_types,
                  {unix('max("timestamp")')} - {unix('min("timestamp")')} AS duration_seconds
           FROM (SELECT *,
                   ROW_NUMBER() OVER (PARTITION BY incident_id ORDER BY "timestamp" ASC NULLS FIRST, alert_id) AS rn_first,
                   ROW_NUMBER() OVER (PARTITION BY incident_id ORDER BY "timestamp" DESC NULLS LAST, alert_id DESC) AS rn_last
                 FROM security_alerts WHERE incident_id IS NOT NULL)
           GROUP BY incident_id HAVING count(*) >= 4"""
    ),
    "incident_steps": _q(
        """SELECT incident_id, alert_id, "timestamp", alert_type, severity, is_resolved,
                  ROW_NUMBER() OVER (PARTITION BY incident_id ORDER BY "timestamp" ASC NULLS FIRST, alert_id)
                    AS step
           FROM security_alerts WHERE incident_id IS NOT NULL"""
    ),
    "failures_by_zone": _q(
        """SELECT zone, location, count(*) AS attempts, count(*) FILTER (WHERE NOT success) AS failures,
                  count(*) FILTER (WHERE NOT success) / count(*) AS failure_rate
           FROM (SELECT *, CASE WHEN ip_address LIKE '192.168.1.%' OR ip_address LIKE '10.0.0.%'
                                  OR ip_address LIKE '172.16.0.%' THEN 'internal'
                                WHEN ip_address LIKE '203.0.113.%' OR ip_address LIKE '198.51.100.%'
                                  THEN 'external' ELSE 'unknown' END AS zone
                 FROM login_attempts)
           GROUP BY zone, location"""
    ),
    "success_after_failures": _q(
        """SELECT attempt_id, username, "timestamp", ip_address, location, recent_failures
           FROM (SELECT *, CAST(COALESCE(SUM(CASE WHEN success = false THEN 1 ELSE 0 END) OVER (
                          PARTITION BY username ORDER BY "timestamp" ASC NULLS FIRST, attempt_id ASC
                          ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS recent_failures
                 FROM login_attempts)
           WHERE success AND recent_failures >= 2"""
    ),
    "contract_violations": _q(
        """SELECT 'network_traffic' AS dataset, rule, columns, violations FROM (
             SELECT 'not_null' AS rule, 'traffic_id' AS columns, count(*) FILTER (WHERE traffic_id IS NULL) AS violations FROM network_traffic
             UNION ALL SELECT 'not_null', 'source_ip', count(*) FILTER (WHERE source_ip IS NULL) FROM network_traffic
             UNION ALL SELECT 'not_null', 'destination_ip', count(*) FILTER (WHERE destination_ip IS NULL) FROM network_traffic
             UNION ALL SELECT 'not_null', 'protocol', count(*) FILTER (WHERE protocol IS NULL) FROM network_traffic
             UNION ALL SELECT 'not_null', 'port', count(*) FILTER (WHERE port IS NULL) FROM network_traffic
             UNION ALL SELECT 'not_null', 'packet_size', count(*) FILTER (WHERE packet_size IS NULL) FROM network_traffic
             UNION ALL SELECT 'not_null', 'timestamp', count(*) FILTER (WHERE "timestamp" IS NULL) FROM network_traffic
             UNION ALL SELECT 'not_null', 'is_suspicious', count(*) FILTER (WHERE is_suspicious IS NULL) FROM network_traffic
             UNION ALL SELECT 'max_length_50', 'source_ip', count(*) FILTER (WHERE length(source_ip) > 50) FROM network_traffic
             UNION ALL SELECT 'max_length_50', 'destination_ip', count(*) FILTER (WHERE length(destination_ip) > 50) FROM network_traffic
             UNION ALL SELECT 'max_length_50', 'protocol', count(*) FILTER (WHERE length(protocol) > 50) FROM network_traffic
             UNION ALL SELECT 'primary_key', 'traffic_id', CAST(coalesce(sum(n) FILTER (WHERE n > 1 OR traffic_id IS NULL), 0) AS BIGINT)
                       FROM (SELECT traffic_id, count(*) AS n FROM network_traffic GROUP BY traffic_id))
           UNION ALL
           SELECT 'login_attempts', rule, columns, violations FROM (
             SELECT 'not_null' AS rule, 'attempt_id' AS columns, count(*) FILTER (WHERE attempt_id IS NULL) AS violations FROM login_attempts
             UNION ALL SELECT 'not_null', 'username', count(*) FILTER (WHERE username IS NULL) FROM login_attempts
             UNION ALL SELECT 'not_null', 'timestamp', count(*) FILTER (WHERE "timestamp" IS NULL) FROM login_attempts
             UNION ALL SELECT 'not_null', 'ip_address', count(*) FILTER (WHERE ip_address IS NULL) FROM login_attempts
             UNION ALL SELECT 'not_null', 'success', count(*) FILTER (WHERE success IS NULL) FROM login_attempts
             UNION ALL SELECT 'max_length_100', 'username', count(*) FILTER (WHERE length(username) > 100) FROM login_attempts
             UNION ALL SELECT 'max_length_50', 'ip_address', count(*) FILTER (WHERE length(ip_address) > 50) FROM login_attempts
             UNION ALL SELECT 'max_length_500', 'user_agent', count(*) FILTER (WHERE length(user_agent) > 500) FROM login_attempts
             UNION ALL SELECT 'max_length_100', 'location', count(*) FILTER (WHERE length(location) > 100) FROM login_attempts
             UNION ALL SELECT 'primary_key', 'attempt_id', CAST(coalesce(sum(n) FILTER (WHERE n > 1 OR attempt_id IS NULL), 0) AS BIGINT)
                       FROM (SELECT attempt_id, count(*) AS n FROM login_attempts GROUP BY attempt_id))
           UNION ALL
           SELECT 'failed_login_metrics', rule, columns, violations FROM (
             SELECT 'not_null' AS rule, 'username' AS columns, count(*) FILTER (WHERE username IS NULL) AS violations FROM failed_logins
             UNION ALL SELECT 'not_null', 'ip_address', count(*) FILTER (WHERE ip_address IS NULL) FROM failed_logins
             UNION ALL SELECT 'not_null', 'failed_attempt_count', count(*) FILTER (WHERE failed_attempt_count IS NULL) FROM failed_logins
             UNION ALL SELECT 'not_null', 'first_attempt', count(*) FILTER (WHERE first_attempt IS NULL) FROM failed_logins
             UNION ALL SELECT 'not_null', 'last_attempt', count(*) FILTER (WHERE last_attempt IS NULL) FROM failed_logins
             UNION ALL SELECT 'not_null', 'time_span_seconds', count(*) FILTER (WHERE time_span_seconds IS NULL) FROM failed_logins
             UNION ALL SELECT 'not_null', 'attempts_per_minute', count(*) FILTER (WHERE attempts_per_minute IS NULL) FROM failed_logins
             UNION ALL SELECT 'not_null', 'risk_score', count(*) FILTER (WHERE risk_score IS NULL) FROM failed_logins
             UNION ALL SELECT 'max_length_100', 'username', count(*) FILTER (WHERE length(username) > 100) FROM failed_logins
             UNION ALL SELECT 'max_length_50', 'ip_address', count(*) FILTER (WHERE length(ip_address) > 50) FROM failed_logins)
           UNION ALL
           SELECT 'suspicious_traffic_analysis', rule, columns, violations FROM (
             SELECT 'not_null' AS rule, 'traffic_id' AS columns, count(*) FILTER (WHERE traffic_id IS NULL) AS violations FROM scored_traffic
             UNION ALL SELECT 'not_null', 'source_ip', count(*) FILTER (WHERE source_ip IS NULL) FROM scored_traffic
             UNION ALL SELECT 'not_null', 'destination_ip', count(*) FILTER (WHERE destination_ip IS NULL) FROM scored_traffic
             UNION ALL SELECT 'not_null', 'protocol', count(*) FILTER (WHERE protocol IS NULL) FROM scored_traffic
             UNION ALL SELECT 'not_null', 'port', count(*) FILTER (WHERE port IS NULL) FROM scored_traffic
             UNION ALL SELECT 'not_null', 'timestamp', count(*) FILTER (WHERE "timestamp" IS NULL) FROM scored_traffic
             UNION ALL SELECT 'not_null', 'packet_size', count(*) FILTER (WHERE packet_size IS NULL) FROM scored_traffic
             UNION ALL SELECT 'not_null', 'is_suspicious', count(*) FILTER (WHERE is_suspicious IS NULL) FROM scored_traffic
             UNION ALL SELECT 'not_null', 'anomaly_score', count(*) FILTER (WHERE anomaly_score IS NULL) FROM scored_traffic
             UNION ALL SELECT 'max_length_50', 'source_ip', count(*) FILTER (WHERE length(source_ip) > 50) FROM scored_traffic
             UNION ALL SELECT 'max_length_50', 'destination_ip', count(*) FILTER (WHERE length(destination_ip) > 50) FROM scored_traffic
             UNION ALL SELECT 'max_length_50', 'protocol', count(*) FILTER (WHERE length(protocol) > 50) FROM scored_traffic)"""
    ),
}

ORACLE["csv_snapshot_roundtrip"] = ORACLE["failed_login_metrics"]
ORACLE["documents_normalized"] = ORACLE["unresolved_alerts"]
ORACLE["etl_run_summary"] = ORACLE["run_summary"]
ORACLE["latest_snapshot"] = ORACLE["priority_distribution"]
ORACLE["stream_failed_logins"] = ORACLE["failed_login_metrics"]
ORACLE["stream_traffic"] = ORACLE["traffic_anomalies"]
ORACLE["stream_alerts"] = ORACLE["unresolved_alerts"]
ORACLE["stream_failed_logins_windowed"] = _q(
    """SELECT window_start, window_end, username, ip_address, failed_attempt_count, first_attempt,
              last_attempt, time_span_seconds,
              failed_attempt_count / NULLIF(CAST(time_span_seconds AS DOUBLE) / 60, 0) AS attempts_per_minute,
              CASE WHEN failed_attempt_count >= 5 THEN
                     CASE WHEN time_span_seconds <= 60 THEN 100 WHEN time_span_seconds <= 300 THEN 80
                          WHEN time_span_seconds <= 3600 THEN 50 ELSE 30 END
                   WHEN failed_attempt_count >= 3 THEN 20 ELSE 10 END AS risk_score
       FROM win""",
    f"""
win_g AS (
  SELECT {unix('"timestamp"')} - (({unix('"timestamp"')} % 3600) + 3600) % 3600 AS ws,
         username, ip_address, count(*) AS failed_attempt_count,
         min("timestamp") AS first_attempt, max("timestamp") AS last_attempt
  FROM login_attempts WHERE NOT success AND "timestamp" IS NOT NULL
  GROUP BY ws, username, ip_address),
win AS (
  SELECT make_timestamp(ws * 1000000) AS window_start, make_timestamp((ws + 3600) * 1000000) AS window_end,
         username, ip_address, failed_attempt_count, first_attempt, last_attempt,
         {unix("last_attempt")} - {unix("first_attempt")} AS time_span_seconds
  FROM win_g)""",
)
ORACLE["stream_brute_force_bursts"] = _q(
    f"""SELECT username, burst_start, burst_end, duration_seconds, attempts FROM (
          SELECT username, min("timestamp") AS burst_start, max("timestamp") AS burst_end,
                 {unix('max("timestamp")')} - {unix('min("timestamp")')} AS duration_seconds,
                 count(*) AS attempts
          FROM bf_sessions GROUP BY username, burst HAVING count(*) >= 3)
        """,
    f"""
bf_fail AS (
  SELECT username, "timestamp", {unix('"timestamp"')} AS sec
  FROM login_attempts WHERE NOT success AND "timestamp" IS NOT NULL),
bf_lag AS (
  SELECT *, LAG(sec) OVER (PARTITION BY username ORDER BY sec, "timestamp") AS prev_sec FROM bf_fail),
bf_sessions AS (
  SELECT *, SUM(CASE WHEN prev_sec IS NULL OR sec - prev_sec > 86400 THEN 1 ELSE 0 END)
              OVER (PARTITION BY username ORDER BY sec, "timestamp" ROWS UNBOUNDED PRECEDING) AS burst
  FROM bf_lag)""",
)
ORACLE["stream_port_scans"] = _q(
    f"""SELECT source_ip, make_timestamp(ws * 1000000) AS window_start,
              make_timestamp((ws + 2592000) * 1000000) AS window_end,
              count(DISTINCT port) AS distinct_ports, count(*) AS connections,
              min("timestamp") AS first_seen, max("timestamp") AS last_seen
       FROM (SELECT *, {unix('"timestamp"')} - (({unix('"timestamp"')} % 2592000) + 2592000) % 2592000 AS ws
             FROM network_traffic WHERE "timestamp" IS NOT NULL)
       GROUP BY source_ip, ws
       HAVING count(DISTINCT port) >= 5"""
)

ORACLE["incident_chains"] = _q(
    """SELECT incident_id, CAST(sum(n) AS BIGINT) AS steps, count(*) AS runs,
              string_agg(alert_type || CASE WHEN n > 1 THEN ' x' || n ELSE '' END, ' > ' ORDER BY first_step) AS chain
       FROM (SELECT incident_id, alert_type, run, count(*) AS n, min(step) AS first_step FROM chain_runs
             GROUP BY incident_id, alert_type, run)
       GROUP BY incident_id HAVING sum(n) >= 2""",
    """
chain_steps AS (
  SELECT incident_id, alert_type,
         ROW_NUMBER() OVER (PARTITION BY incident_id ORDER BY "timestamp" ASC NULLS FIRST, alert_id) AS step
  FROM security_alerts WHERE incident_id IS NOT NULL),
chain_runs AS (
  SELECT *, step - ROW_NUMBER() OVER (PARTITION BY incident_id, alert_type ORDER BY step) AS run FROM chain_steps)""",
)
ORACLE["deep_traffic_page"] = _q(
    "SELECT * FROM scored_traffic "
    'ORDER BY anomaly_score DESC, "timestamp" ASC NULLS FIRST, traffic_id ASC NULLS FIRST, '
    "source_ip ASC NULLS FIRST, destination_ip ASC NULLS FIRST, port ASC NULLS FIRST "
    "LIMIT 10 OFFSET 50000"
)

#: The mixed documents again, as DuckDB JSON.
_MIXED = f"""
mixed_documents AS (
  SELECT *, (alert_id // 2) % 3 AS shape, json_merge_patch(
    json_object('alert_id', alert_id, 'alert_type', alert_type, 'severity', severity, 'timestamp', strftime("timestamp", '%Y-%m-%dT%H:%M:%S'),
                'source', source, 'description', description, 'affected_system', affected_system, 'is_resolved', is_resolved),
    CASE (alert_id // 2) % 3
      WHEN 0 THEN json_object('detection_details', json_object('ip_address', detail_ip_address, 'username', detail_username, 'incident_id', incident_id, 'step', alert_id % 6 + 1))
      WHEN 1 THEN json_object('detection_details', json_object('ip_address', detail_ip_address, 'port', alert_id % 60000, 'protocol', 'TCP', 'username', CASE WHEN alert_id % 2 = 0 THEN detail_username END))
      ELSE json_object('detection_details', json_object('port', 'udp/' || (alert_id % 60000), 'route', json_object('zone', 'dmz', 'hops', range(1, alert_id % 3 + 2))))
    END) AS document
  FROM security_alerts)"""
ORACLE["document_fields"] = _q(
    """SELECT path, CASE WHEN min(type) = max(type) THEN min(type) ELSE 'VARIANT' END AS type, count(*) AS documents
       FROM (SELECT substr(replace(t.fullkey, '"', ''), 3) AS path, t.type AS json_type,
               CASE t.type WHEN 'VARCHAR' THEN 'STRING' WHEN 'UBIGINT' THEN 'BIGINT' WHEN 'ARRAY' THEN 'ARRAY<BIGINT>' ELSE t.type END AS type
             FROM mixed_documents, json_tree(document) AS t)
       WHERE path <> '' AND path NOT LIKE '%]' AND json_type <> 'NULL' GROUP BY path""",
    _MIXED,
)
ORACLE["alerts_from_open_documents"] = _q(
    """SELECT e.alert_id, e.alert_type, e."timestamp", CASE WHEN shape = 0 THEN e.incident_id END AS incident_id, severity_score, priority,
              CASE WHEN shape = 1 THEN CAST(e.alert_id % 60000 AS INTEGER) END AS detail_port,
              document->>'$.detection_details.port' AS port_text, document->>'$.detection_details.protocol' AS protocol,
              CAST(document->>'$.detection_details.step' AS INTEGER) AS step, document->>'$.detection_details.route.zone' AS zone,
              CAST(document->>'$.detection_details.route.hops[#-1]' AS INTEGER) AS last_hop
       FROM enriched_alerts e JOIN mixed_documents USING (alert_id)""",
    _MIXED,
)

#: Files of the timely streams, their watermarks in whole milliseconds, and lateness: rows of a
#: file are held against the watermark that the batch before it ran with.
_TIMELY = f"""
filed AS (
  SELECT *, least((day("timestamp") - 1) // 8, 3) + CASE WHEN attempt_id % 7 = 0 THEN 1 ELSE 0 END AS file,
         {unix('"timestamp"')} // 3600 * 3600 AS ws
  FROM login_attempts WHERE "timestamp" IS NOT NULL),
marks AS (
  SELECT b.file, (SELECT max(epoch_us("timestamp")) // 1000 FROM filed WHERE NOT success AND file <= b.file - 2) - 86400000 AS late_ms,
         (SELECT max(epoch_us("timestamp")) // 1000 FROM filed WHERE NOT success) - 86400000 AS last_ms
  FROM (SELECT DISTINCT file FROM filed) b),
timely AS (
  SELECT filed.*, last_ms, coalesce((ws + 3600) * 1000 <= late_ms, false) AS late FROM filed JOIN marks USING (file)
  WHERE NOT success)"""
ORACLE["stream_finished_windows"] = _q(
    f"""SELECT make_timestamp(ws * 1000000) AS window_start, make_timestamp((ws + 3600) * 1000000) AS window_end, username, ip_address,
               failed_attempt_count, first_attempt, last_attempt, span AS time_span_seconds,
               failed_attempt_count / NULLIF(CAST(span AS DOUBLE) / 60, 0) AS attempts_per_minute,
               CASE WHEN failed_attempt_count >= 5 THEN CASE WHEN span <= 60 THEN 100 WHEN span <= 300 THEN 80 WHEN span <= 3600 THEN 50 ELSE 30 END
                    WHEN failed_attempt_count >= 3 THEN 20 ELSE 10 END AS risk_score
        FROM (SELECT ws, username, ip_address, count(*) AS failed_attempt_count, min("timestamp") AS first_attempt, max("timestamp") AS last_attempt,
                     {unix('max("timestamp")')} - {unix('min("timestamp")')} AS span
              FROM timely WHERE NOT late AND (ws + 3600) * 1000 <= last_ms GROUP BY ws, username, ip_address)""",
    _TIMELY,
)
ORACLE["stream_late_rows"] = _q(
    """SELECT CAST(file AS BIGINT) AS batch, count(*) AS input_rows,
              (SELECT count(*) FROM (SELECT DISTINCT ws, username, ip_address FROM timely WHERE late AND timely.file = filed.file)) AS late_groups
       FROM filed GROUP BY file""",
    _TIMELY,
)
ORACLE["stream_closed_bursts"] = _q(
    f"""SELECT username, min("timestamp") AS burst_start, max("timestamp") AS burst_end,
               max(sec) - min(sec) AS duration_seconds, count(*) AS attempts
        FROM cb_sessions GROUP BY username, burst
        HAVING count(*) >= 3 AND max(sec) + 86401 <= (SELECT max(sec) FROM cb_lag)""",
    f"""
cb_lag AS (
  SELECT username, "timestamp", {unix('"timestamp"')} AS sec, LAG({unix('"timestamp"')}) OVER (PARTITION BY username ORDER BY "timestamp") AS prev_sec
  FROM login_attempts WHERE NOT success AND "timestamp" IS NOT NULL),
cb_sessions AS (
  SELECT *, SUM(CASE WHEN prev_sec IS NULL OR sec - prev_sec > 86400 THEN 1 ELSE 0 END)
              OVER (PARTITION BY username ORDER BY "timestamp" ROWS UNBOUNDED PRECEDING) AS burst
  FROM cb_lag)""",
)
ORACLE["clustered_traffic"] = _q(
    "SELECT * FROM scored_traffic WHERE anomaly_score >= 80 AND \"timestamp\" >= TIMESTAMP '1998-01-01 00:00:00'"
)
ORACLE["refresh_charts"] = _q(
    """SELECT 'risk_distribution' AS chart, CAST(risk_score AS VARCHAR) AS label, count(*) AS value FROM failed_logins WHERE risk_score BETWEEN 15 AND 50 GROUP BY risk_score
       UNION ALL SELECT 'anomaly_distribution', CAST(anomaly_score AS VARCHAR), count(*) FROM scored_traffic GROUP BY anomaly_score
       UNION ALL SELECT 'priority_distribution', priority, count(*) FROM enriched_alerts WHERE priority IN ('CRITICAL', 'HIGH') GROUP BY priority
       UNION ALL SELECT 'alert_type_distribution', alert_type, count(*) FROM enriched_alerts WHERE priority IN ('CRITICAL', 'HIGH') GROUP BY alert_type
       UNION ALL SELECT 'action_summary', CAST(action_required AS VARCHAR), count(*) FROM enriched_alerts GROUP BY action_required
       UNION ALL SELECT 'kpi', 'failed_logins', count(*) FROM failed_logins
       UNION ALL SELECT 'kpi', 'high_risk_logins', count(*) FILTER (WHERE risk_score >= 80) FROM failed_logins
       UNION ALL SELECT 'kpi', 'suspicious_traffic', count(*) FROM scored_traffic
       UNION ALL SELECT 'kpi', 'high_anomalies', count(*) FILTER (WHERE anomaly_score >= 80) FROM scored_traffic
       UNION ALL SELECT 'kpi', 'security_alerts', count(*) FROM enriched_alerts
       UNION ALL SELECT 'kpi', 'critical_alerts', count(*) FILTER (WHERE priority = 'CRITICAL') FROM enriched_alerts
       UNION ALL SELECT 'kpi', 'actions_required', count(*) FILTER (WHERE action_required) FROM enriched_alerts"""
)
ORACLE["sliding_port_scans"] = _q(
    f"""SELECT source_ip, make_timestamp(ws * 1000000) AS window_start, make_timestamp((ws + 2592000) * 1000000) AS window_end,
               count(DISTINCT port) AS distinct_ports, count(*) AS connections, min("timestamp") AS first_seen, max("timestamp") AS last_seen
        FROM (SELECT *, {unix('"timestamp"')} // 864000 * 864000 - 864000 * unnest([0, 1, 2]) AS ws FROM network_traffic WHERE "timestamp" IS NOT NULL)
        GROUP BY source_ip, ws HAVING count(DISTINCT port) >= 8"""
)
ORACLE["key_violations"] = _q(
    """SELECT 'network_traffic' AS dataset, 'primary_key' AS rule, 'traffic_id' AS columns,
              CAST(coalesce(sum(n) FILTER (WHERE n > 1 OR traffic_id IS NULL), 0) AS BIGINT) AS violations
       FROM (SELECT traffic_id, count(*) AS n FROM network_traffic GROUP BY traffic_id)
       UNION ALL
       SELECT 'login_attempts', 'primary_key', 'attempt_id', CAST(coalesce(sum(n) FILTER (WHERE n > 1 OR attempt_id IS NULL), 0) AS BIGINT)
       FROM (SELECT attempt_id, count(*) AS n FROM login_attempts GROUP BY attempt_id)"""
)
