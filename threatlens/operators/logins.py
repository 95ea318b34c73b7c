"""Login operators: failed-login risk (C1), brute-force bursts (D1), failures by
address zone (D4) and success after failures (D5)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from threatlens.config import LoginRiskRules, Zones
from threatlens.functions.network import with_ip_value, zone_of
from threatlens.functions.scoring import attempts_per_minute, risk_score, unix_seconds
from threatlens.functions.sequence import with_sequence


def failed_logins_by(logins: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Failures per key: their number, first and last time."""
    return (
        logins.filter(~F.col("success"))
        .groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("failed_attempt_count"),
            F.min("timestamp").alias("first_attempt"),
            F.max("timestamp").alias("last_attempt"),
        )
    )


def with_login_risk(groups: DataFrame, keys: Sequence[str], rules: LoginRiskRules = LoginRiskRules()) -> DataFrame:
    """Span, rate and risk of groups of failures."""
    count, span = F.col("failed_attempt_count"), F.col("time_span_seconds")
    seconds = unix_seconds(F.col("last_attempt")) - unix_seconds(F.col("first_attempt"))
    return groups.withColumn("time_span_seconds", seconds).select(
        *keys,
        "failed_attempt_count",
        "first_attempt",
        "last_attempt",
        "time_span_seconds",
        attempts_per_minute(count, span).alias("attempts_per_minute"),
        risk_score(count, span, rules).alias("risk_score"),
    )


def failed_login_metrics(logins: DataFrame, rules: LoginRiskRules = LoginRiskRules()) -> DataFrame:
    """Per (username, ip_address): failures, first/last failure, span, rate and risk.

    One hash aggregate with map-side partial aggregation, so a hot pair is reduced
    on every mapper before the shuffle.  The result is not sorted; ordering is a
    report concern (``reports.ordered``).
    """
    keys = ["username", "ip_address"]
    return with_login_risk(failed_logins_by(logins, keys), keys, rules)


def brute_force_bursts(
    logins: DataFrame,
    keys: Sequence[str] = ("username", "ip_address"),
    max_gap_s: int = 60,
    min_attempts: int = 5,
    bucket_s: int = 86400,
) -> DataFrame:
    """Bursts of failed logins: a new burst starts when the gap to the previous failure
    of the same key exceeds ``max_gap_s`` (whole seconds); keep bursts with at least
    ``min_attempts`` failures.

    Skew-safe plan (a single key may hold a third of all rows):

    1. failures are pre-aggregated per (key, epoch second) — map-side combine, and the
       gap between failures inside one second is 0, so this loses nothing;
    2. seconds are sessionized inside (key, day) windows, which hold at most
       ``bucket_s`` rows whatever the data volume;
    3. the per-day sessions are chained across days through one summary row per
       (key, day): only a day's first session can continue the previous day's last,
       so the per-key window sees at most one row per day;
    4. one final aggregate per chained burst.
    """
    return bursts_of_seconds(failures_by_second(logins, keys), keys, max_gap_s, min_attempts, bucket_s)


def failures_by_second(logins: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Failures per key and epoch second: their number, first and last time."""
    return (
        logins.filter(~F.col("success") & F.col("timestamp").isNotNull())
        .withColumn("_sec", unix_seconds(F.col("timestamp")))
        .groupBy(*keys, "_sec")
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.min("timestamp").alias("_first"),
            F.max("timestamp").alias("_last"),
        )
    )


def bursts_of_seconds(
    per_second: DataFrame, keys: Sequence[str], max_gap_s: int = 60, min_attempts: int = 5, bucket_s: int = 86400
) -> DataFrame:
    """The bursts of ``failures_by_second`` rows (steps 2 to 4 of ``brute_force_bursts``)."""
    if max_gap_s < 0 or bucket_s < 1:
        raise ValueError("need max_gap_s >= 0 and bucket_s >= 1")
    keys = list(keys)
    gap = F.lit(max_gap_s)
    per_second = per_second.withColumn("_bucket", F.floor(F.col("_sec") / bucket_s))
    w_day = Window.partitionBy(*keys, "_bucket").orderBy("_sec")
    prev = F.lag("_sec").over(w_day)
    local = per_second.withColumn(
        "_new", F.when(prev.isNull() | ((F.col("_sec") - prev) > gap), 1).otherwise(0)
    ).withColumn("_local", F.sum("_new").over(w_day.rowsBetween(Window.unboundedPreceding, 0)))
    pieces = local.groupBy(*keys, "_bucket", "_local").agg(
        F.min("_sec").alias("_start_sec"),
        F.max("_sec").alias("_end_sec"),
        F.min("_first").alias("_first"),
        F.max("_last").alias("_last"),
        F.sum("_n").alias("_n"),
    )
    # Chaining across buckets: only a bucket's first piece can continue the previous
    # non-empty bucket's last piece, so the per-key window runs over one summary row
    # per (key, bucket) — bounded by the time span, whatever the number of pieces.
    per_bucket = pieces.groupBy(*keys, "_bucket").agg(
        F.min("_start_sec").alias("_b_start"),
        F.max("_end_sec").alias("_b_end"),
        F.max("_local").alias("_b_pieces"),
    )
    w_key = Window.partitionBy(*keys).orderBy("_bucket")
    linked = F.coalesce((F.col("_b_start") - F.lag("_b_end").over(w_key)) <= gap, F.lit(False))
    chained = per_bucket.withColumn("_linked", linked.cast("long")).withColumn(
        "_before",
        F.coalesce(
            F.sum(F.col("_b_pieces") - F.col("_linked")).over(w_key.rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0),
        ),
    )
    # burst number of a piece: bursts started in earlier buckets + its index in its
    # bucket, minus one when the bucket's first piece continues the previous burst
    chain = chained.select(
        *[F.col(k).alias(f"_c_{k}") for k in keys], F.col("_bucket").alias("_c_bucket"), "_linked", "_before"
    )
    same = F.col("_bucket") == F.col("_c_bucket")
    for k in keys:  # a null key is a key like any other
        same = same & F.col(k).eqNullSafe(F.col(f"_c_{k}"))
    numbered = pieces.join(chain, same).withColumn("_burst", F.col("_before") + F.col("_local") - F.col("_linked"))
    bursts = numbered.groupBy(*keys, "_burst").agg(
        F.min("_first").alias("burst_start"),
        F.max("_last").alias("burst_end"),
        F.sum("_n").alias("attempts"),
    )
    return bursts.filter(F.col("attempts") >= min_attempts).select(
        *keys,
        "burst_start",
        "burst_end",
        (unix_seconds(F.col("burst_end")) - unix_seconds(F.col("burst_start"))).alias(
            "duration_seconds"
        ),
        F.col("attempts").cast("long").alias("attempts"),
    )


def failures_by_zone(logins: DataFrame, zones: Zones = Zones()) -> DataFrame:
    """Attempts, failures and failure rate per address zone and location."""
    return (
        with_ip_value(logins.select("ip_address", "location", "success"), "ip_address", "_value")
        .withColumn("zone", zone_of(F.col("_value"), zones))
        .groupBy("zone", "location")
        .agg(
            F.count(F.lit(1)).alias("attempts"),
            F.count_if(~F.col("success")).alias("failures"),
        )
        .withColumn("failure_rate", F.col("failures") / F.col("attempts"))
    )


def success_after_failures(
    logins: DataFrame, look_back: int = 3, min_failures: int = 2
) -> DataFrame:
    """Successful logins preceded, among the previous ``look_back`` attempts of the
    same user (order: timestamp, attempt_id), by at least ``min_failures`` failures.

    Exact and skew-safe: ``with_sequence`` numbers each user's attempts and keeps a
    running failure count over a range-partitioned sort (a hot user is split across
    tasks); the failures in the window are then ``fails_before(i) - fails_before(i -
    look_back)``, one equi-join on (username, seq) with unique keys.
    """
    if look_back < 1:
        raise ValueError("look_back must be at least 1")
    fail = F.when(F.col("success"), 0).when(~F.col("success"), 1).otherwise(0)
    # only what the result needs: the sequence's checkpoint stops column pruning
    needed = logins.select("attempt_id", "username", "timestamp", "ip_address", "location", "success")
    seq = with_sequence(
        needed.withColumn("_fail", fail),
        keys=["username"],
        order=["timestamp", "attempt_id"],
        running={"_fails": F.col("_fail")},
    )
    hits = seq.filter(F.col("success")).withColumn("_before", F.col("_fails") - F.col("_fail"))
    anchor = seq.select(
        F.col("username").alias("_u"), F.col("seq").alias("_s"), F.col("_fails").alias("_older")
    )
    joined = hits.join(
        anchor,
        (F.col("username").eqNullSafe(F.col("_u")))
        & (F.col("_s") == F.col("seq") - F.lit(look_back + 1)),
        "left",
    )
    recent = (F.col("_before") - F.coalesce(F.col("_older"), F.lit(0))).cast("long")
    return joined.withColumn("recent_failures", recent).filter(
        F.col("recent_failures") >= min_failures
    ).select(
        "attempt_id",
        "username",
        "timestamp",
        "ip_address",
        "location",
        "recent_failures",
    )
