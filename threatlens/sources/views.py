"""Security views over the driver's parquet tables.

Each view is a narrow projection of one table (no shuffle): the parquet scan keeps
its column pruning and filter pushdown through it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threatlens.config import (
    ALERT_TYPES,
    LOCATIONS,
    LOGIN_ADDRESSES,
    PROTOCOLS,
    SEVERITY_BY_ORDER_PRIORITY,
    TRAFFIC_PORTS,
)
from threatlens.functions.columns import lookup, pick_mod, text


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """``<dir>/<name>.parquet`` (file or folder), else a ``<dir>/<name>`` folder of
    parquet files, as large tables are usually stored."""
    base = f"{sf_dir.rstrip('/')}/{name}"
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(f"{base}.parquet")
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return spark.read.parquet(f"{base}.parquet" if fs.exists(p) else base)


def login_attempts_from_events(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("event_id").alias("attempt_id"),
        text("user", F.col("user_id")).alias("username"),
        F.col("ts").alias("timestamp"),
        pick_mod(LOGIN_ADDRESSES, F.col("event_id")).alias("ip_address"),
        (F.col("event_type") != "error").alias("success"),
        F.col("event_type").alias("user_agent"),
        pick_mod(LOCATIONS, F.col("user_id")).alias("location"),
    )


def network_traffic_from_lineitem(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("traffic_id"),
        text("192.168.1.", F.pmod("l_suppkey", F.lit(255))).alias("source_ip"),
        text("10.0.0.", F.pmod("l_partkey", F.lit(255))).alias("destination_ip"),
        pick_mod(PROTOCOLS, F.col("l_linenumber")).alias("protocol"),
        pick_mod(TRAFFIC_PORTS, F.col("l_partkey")).alias("port"),
        (F.col("l_quantity") * 40).cast("int").alias("packet_size"),
        F.col("l_shipdate").alias("timestamp"),
        ((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")).alias("is_suspicious"),
        F.col("l_partkey").alias("tie_key"),
    )


def security_alerts_from_orders(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.col("o_orderkey").alias("alert_id"),
        pick_mod(ALERT_TYPES, F.col("o_custkey")).alias("alert_type"),
        lookup(SEVERITY_BY_ORDER_PRIORITY, F.col("o_orderpriority")).alias("severity"),
        F.col("o_orderdate").alias("timestamp"),
        text("IDS-", F.pmod("o_orderkey", F.lit(5)) + 1).alias("source"),
        text("Security alert detected on system ", F.pmod("o_orderkey", F.lit(20))).alias("description"),
        text("Server-", F.pmod("o_custkey", F.lit(10)) + 1).alias("affected_system"),
        (F.col("o_orderstatus") == "F").alias("is_resolved"),
        F.create_map(
            F.lit("ip_address"),
            text("192.168.1.", F.pmod("o_custkey", F.lit(255))),
            F.lit("username"),
            text("user", F.pmod("o_custkey", F.lit(150))),
            F.lit("incident_id"),
            text("INC-", F.col("o_custkey")),
        ).alias("detection_details"),
    )


def login_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return login_attempts_from_events(table(spark, sf_dir, "events"))


def network_traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return network_traffic_from_lineitem(table(spark, sf_dir, "lineitem"))


def security_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return security_alerts_from_orders(table(spark, sf_dir, "orders"))


def register(spark: SparkSession, sf_dir: str) -> list[str]:
    """Temp views for ad-hoc SQL: the three security views and the scored results
    (``failed_logins``, ``suspicious_traffic``, ``enriched_alerts``).  Each SQL query
    plans against the parquet scans, with the usual pushdown; only the per-second
    table behind ``suspicious_traffic`` is materialized at registration."""
    from threatlens.operators.alerts import prioritize_alerts, unresolved
    from threatlens.operators.logins import failed_login_metrics
    from threatlens.operators.traffic import traffic_anomalies

    logins = login_attempts(spark, sf_dir)
    traffic = network_traffic(spark, sf_dir)
    alerts = security_alerts(spark, sf_dir)
    frames = {
        "login_attempts": logins,
        "network_traffic": traffic,
        "security_alerts": alerts,
        "failed_logins": failed_login_metrics(logins),
        "suspicious_traffic": traffic_anomalies(traffic),
        "enriched_alerts": prioritize_alerts(unresolved(alerts)),
    }
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
    return list(frames)
