"""Explicit schemas: sources are never inferred.

Timestamps are wall-clock values without a zone (``TimestampNTZType``), the type
the driver's parquet tables carry.
"""

from __future__ import annotations

from pyspark.sql import types as T

TS = T.TimestampNTZType()

LOGIN_ATTEMPTS = T.StructType(
    [
        T.StructField("attempt_id", T.LongType(), False),
        T.StructField("username", T.StringType()),
        T.StructField("timestamp", TS),
        T.StructField("ip_address", T.StringType()),
        T.StructField("success", T.BooleanType()),
        T.StructField("user_agent", T.StringType()),
        T.StructField("location", T.StringType()),
    ]
)

NETWORK_TRAFFIC = T.StructType(
    [
        T.StructField("traffic_id", T.LongType(), False),
        T.StructField("source_ip", T.StringType()),
        T.StructField("destination_ip", T.StringType()),
        T.StructField("protocol", T.StringType()),
        T.StructField("port", T.IntegerType()),
        T.StructField("packet_size", T.IntegerType()),
        T.StructField("timestamp", TS),
        T.StructField("is_suspicious", T.BooleanType()),
        T.StructField("tie_key", T.LongType()),
    ]
)

SECURITY_ALERTS = T.StructType(
    [
        T.StructField("alert_id", T.LongType(), False),
        T.StructField("alert_type", T.StringType()),
        T.StructField("severity", T.StringType()),
        T.StructField("timestamp", TS),
        T.StructField("source", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("affected_system", T.StringType()),
        T.StructField("is_resolved", T.BooleanType()),
        T.StructField("detection_details", T.MapType(T.StringType(), T.StringType())),
    ]
)

FAILED_LOGIN_METRICS = T.StructType(
    [
        T.StructField("username", T.StringType()),
        T.StructField("ip_address", T.StringType()),
        T.StructField("failed_attempt_count", T.LongType(), False),
        T.StructField("first_attempt", TS),
        T.StructField("last_attempt", TS),
        T.StructField("time_span_seconds", T.LongType()),
        T.StructField("attempts_per_minute", T.DoubleType()),
        T.StructField("risk_score", T.IntegerType(), False),
    ]
)

SUSPICIOUS_TRAFFIC = T.StructType(
    [
        T.StructField("traffic_id", T.LongType(), False),
        T.StructField("source_ip", T.StringType()),
        T.StructField("destination_ip", T.StringType()),
        T.StructField("protocol", T.StringType()),
        T.StructField("port", T.IntegerType()),
        T.StructField("timestamp", TS),
        T.StructField("packet_size", T.IntegerType()),
        T.StructField("is_suspicious", T.BooleanType()),
        T.StructField("rapid_connection", T.BooleanType(), False),
        T.StructField("suspicious_port", T.BooleanType(), False),
        T.StructField("large_packet", T.BooleanType(), False),
        T.StructField("anomaly_score", T.IntegerType(), False),
    ]
)

ENRICHED_ALERTS = T.StructType(
    list(SECURITY_ALERTS.fields)
    + [
        T.StructField("severity_score", T.IntegerType(), False),
        T.StructField("priority", T.StringType(), False),
        T.StructField("action_required", T.BooleanType(), False),
    ]
)

#: Result kind -> schema, for snapshots and document exports.
RESULT_SCHEMAS = {
    "failed_logins": FAILED_LOGIN_METRICS,
    "suspicious_traffic": SUSPICIOUS_TRAFFIC,
    "enriched_alerts": ENRICHED_ALERTS,
}


def empty(spark, schema: T.StructType):
    """A typed, row-less DataFrame (replaces a column-less one for absent data)."""
    return spark.createDataFrame([], schema)


def conform(df, schema: T.StructType):
    """``df`` with exactly the columns of ``schema``, by name, cast to its types.

    Missing nullable columns become typed nulls; a missing non-nullable column is an
    error.  Zoned timestamps cast to ``timestamp_ntz`` keep their UTC wall-clock
    value when the session zone is UTC (as ``build_session`` sets it)."""
    from pyspark.sql import functions as F

    have = {c.lower(): c for c in df.columns}
    cols = []
    for f in schema.fields:
        src = have.get(f.name.lower())
        if src is None:
            if not f.nullable:
                raise ValueError(f"required column {f.name!r} is missing")
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.col(src).cast(f.dataType).alias(f.name))
    return df.select(*cols)
