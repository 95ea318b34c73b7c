"""Data contracts (C-1): NOT NULL, primary key and VARCHAR length rules counted in
one pass, instead of being enforced by table DDL."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Contract:
    name: str
    primary_key: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    max_length: tuple[tuple[str, int], ...] = field(default_factory=tuple)


# The column rules of the source and result tables.
LOGIN_ATTEMPTS_CONTRACT = Contract(
    name="login_attempts",
    primary_key=("attempt_id",),
    not_null=("attempt_id", "username", "timestamp", "ip_address", "success"),
    max_length=(("username", 100), ("ip_address", 50), ("user_agent", 500), ("location", 100)),
)

NETWORK_TRAFFIC_CONTRACT = Contract(
    name="network_traffic",
    primary_key=("traffic_id",),
    not_null=(
        "traffic_id",
        "source_ip",
        "destination_ip",
        "protocol",
        "port",
        "packet_size",
        "timestamp",
        "is_suspicious",
    ),
    max_length=(("source_ip", 50), ("destination_ip", 50), ("protocol", 50)),
)

FAILED_LOGIN_METRICS_CONTRACT = Contract(
    name="failed_login_metrics",
    not_null=(
        "username",
        "ip_address",
        "failed_attempt_count",
        "first_attempt",
        "last_attempt",
        "time_span_seconds",
        "attempts_per_minute",
        "risk_score",
    ),
    max_length=(("username", 100), ("ip_address", 50)),
)

SUSPICIOUS_TRAFFIC_CONTRACT = Contract(
    name="suspicious_traffic_analysis",
    not_null=(
        "traffic_id",
        "source_ip",
        "destination_ip",
        "protocol",
        "port",
        "timestamp",
        "packet_size",
        "is_suspicious",
        "anomaly_score",
    ),
    max_length=(("source_ip", 50), ("destination_ip", 50), ("protocol", 50)),
)


def contract_violations(df: DataFrame, contract: Contract) -> DataFrame:
    """One row per rule: (dataset, rule, columns, violations).

    NOT NULL and length rules are ``count_if`` terms of a single aggregate; the key
    rule counts the rows whose key is null or shared with another row, through a
    partially aggregated ``groupBy(key)``.
    """
    terms = []
    for c in contract.not_null:
        terms.append((f"not_null", c, F.count_if(F.col(c).isNull())))
    for c, n in contract.max_length:
        terms.append((f"max_length_{n}", c, F.count_if(F.length(F.col(c)) > n)))
    parts = []
    if terms:
        one = df.agg(*[expr.alias(f"v{i}") for i, (_, _, expr) in enumerate(terms)])
        stacked = one.select(
            F.explode(
                F.array(
                    *[
                        F.struct(
                            F.lit(rule).alias("rule"),
                            F.lit(col).alias("columns"),
                            F.col(f"v{i}").cast("long").alias("violations"),
                        )
                        for i, (rule, col, _) in enumerate(terms)
                    ]
                )
            ).alias("r")
        ).select("r.*")
        parts.append(stacked)
    if contract.primary_key:
        key = list(contract.primary_key)
        any_null = None
        for k in key:
            any_null = F.col(k).isNull() if any_null is None else any_null | F.col(k).isNull()
        groups = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
        bad = groups.agg(
            F.coalesce(
                F.sum(F.when((F.col("n") > 1) | any_null, F.col("n")).otherwise(0)), F.lit(0)
            ).cast("long").alias("violations")
        )
        parts.append(
            bad.select(
                F.lit("primary_key").alias("rule"),
                F.lit(",".join(key)).alias("columns"),
                "violations",
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(F.lit(contract.name).alias("dataset"), "rule", "columns", "violations")


#: Key values of one bitmap: 4 KiB hold whether each of them occurs.
BITMAP_VALUES = 32768


def key_violations(df: DataFrame, contract: Contract) -> DataFrame:
    """The primary-key rule of ``contract_violations`` for a single whole-number key, without a
    shuffle of all keys.

    First pass: per range of ``BITMAP_VALUES`` key values, the rows and the bits that they set.
    A range with as many bits as rows has no repeated key.  The partial aggregate of a task
    is a bitmap a range (an eighth of a byte a key value), and a table stored in key order sends
    little more than one per range; a key spread over far more values than rows is better
    counted by ``contract_violations``.  Second pass: the rows of the remaining ranges alone are
    counted by key."""
    if len(contract.primary_key) != 1:
        raise ValueError("a bitmap holds a single whole-number key")
    (name,) = contract.primary_key
    if not isinstance(df.schema[name].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        raise ValueError(f"key {name!r} is no whole number")
    key = F.col(name).cast("long")
    keys = df.select(key.alias("_key"), F.bitmap_bucket_number(key).alias("_range"), F.bitmap_bit_position(key).alias("_bit"))
    ranges = keys.groupBy("_range").agg(
        F.count("_key").alias("rows"),
        F.count_if(F.col("_key").isNull()).alias("nulls"),
        F.bitmap_count(F.bitmap_construct_agg("_bit")).alias("values"),
    )
    # negative numbers, too, are one bit each within their range
    doubtful = ranges.filter((F.col("rows") > F.col("values")) & F.col("_range").isNotNull()).select("_range")
    repeated = keys.join(doubtful, "_range", "left_semi").groupBy("_key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    found = repeated.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).unionAll(ranges.agg(F.coalesce(F.sum("nulls"), F.lit(0)).alias("n")))
    return found.agg(F.sum("n").cast("long").alias("violations")).select(
        F.lit(contract.name).alias("dataset"), F.lit("primary_key").alias("rule"), F.lit(name).alias("columns"), "violations"
    )
