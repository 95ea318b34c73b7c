"""Event-time windows that close: failed logins per window (R1) and brute-force bursts (D1)
with a watermark.

Unlike ``incremental.py``, where every row counts and every group stays in the state, here
a window is final once the watermark (the newest event time less ``delay``) has passed its
end: it is handed on once, in append mode, and leaves the state, so the state holds the
open windows only, however long the stream runs.  Rows of closed windows are late; they
are dropped, and the query's progress counts them (``late_groups``).

Event times are wall-clock values; watermarks need instants.  ``instant`` and
``wall_clock`` convert between them as UTC, whatever the session's zone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from threatlens.config import LoginRiskRules
from threatlens.functions.scoring import unix_seconds
from threatlens.operators.logins import with_login_risk
from threatlens.streaming.incremental import LOGIN_KEYS, Trigger


def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def instant(wall: Column) -> Column:
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", _epoch(), wall))


def wall_clock(at: Column) -> Column:
    return F.timestamp_add("MICROSECOND", F.unix_micros(at), _epoch())


def _failures(logins: DataFrame, delay: str) -> DataFrame:
    failed = logins.filter(~F.col("success") & F.col("timestamp").isNotNull())
    return failed.withColumn("event_time", instant(F.col("timestamp"))).withWatermark("event_time", delay)


def _append(df: DataFrame, path: str, checkpoint: str, trigger: Trigger) -> StreamingQuery:
    writer = df.writeStream.outputMode("append").format("parquet").option("path", path)
    return trigger.apply(writer.option("checkpointLocation", checkpoint)).start()


def finished_windows_stream(
    logins: DataFrame,
    out_path: str,
    checkpoint: str,
    window: str = "1 hour",
    delay: str = "1 hour",
    trigger: Trigger = Trigger(),
) -> StreamingQuery:
    """Failed logins per (user, address) and window, each window once, when it is closed."""
    groups = _failures(logins, delay).groupBy(F.window("event_time", window).alias("w"), *LOGIN_KEYS)
    counted = groups.agg(
        F.count(F.lit(1)).alias("failed_attempt_count"),
        F.min("timestamp").alias("first_attempt"),
        F.max("timestamp").alias("last_attempt"),
    )
    start, end = (wall_clock(F.col(f"w.{side}")).alias(f"window_{side}") for side in ("start", "end"))
    return _append(counted.select(start, end, *[c for c in counted.columns if c != "w"]), out_path, checkpoint, trigger)


def read_finished_windows(spark: SparkSession, out_path: str, rules: LoginRiskRules = LoginRiskRules()) -> DataFrame:
    return with_login_risk(spark.read.parquet(out_path), ["window_start", "window_end", *LOGIN_KEYS], rules)


def closed_bursts_stream(
    logins: DataFrame,
    out_path: str,
    checkpoint: str,
    keys: Sequence[str] = ("username", "ip_address"),
    max_gap_s: int = 60,
    min_attempts: int = 5,
    delay: str = "1 second",
    trigger: Trigger = Trigger(),
) -> StreamingQuery:
    """Bursts of failed logins as session windows: a burst is handed on when no failure can
    continue it.  Gaps are whole seconds up to ``max_gap_s``, as in ``brute_force_bursts``
    (a failure just ``max_gap_s`` after a session's last one belongs to it); with a delay of
    a second at least, no failure in time order comes after its session was closed."""
    gap = f"{max_gap_s} seconds" if max_gap_s else "1 microsecond"
    failed = logins.filter(~F.col("success") & F.col("timestamp").isNotNull())
    second = F.date_trunc("SECOND", instant(F.col("timestamp")))
    failures = failed.withColumn("second", second).withWatermark("second", delay)
    sessions = failures.groupBy(F.session_window("second", gap).alias("w"), *keys).agg(
        F.min("timestamp").alias("burst_start"), F.max("timestamp").alias("burst_end"), F.count(F.lit(1)).alias("attempts")
    )
    span = unix_seconds(F.col("burst_end")) - unix_seconds(F.col("burst_start"))
    kept = sessions.filter(F.col("attempts") >= min_attempts)
    return _append(kept.select(*keys, "burst_start", "burst_end", span.alias("duration_seconds"), "attempts"), out_path, checkpoint, trigger)


def late_groups(query: StreamingQuery) -> list[tuple[int, int, int]]:
    """(batch, input rows, late groups) of the batches that had rows, from the query's progress
    (Spark keeps the last ``spark.sql.streaming.numRecentProgressUpdates``).

    The watermark is applied after the partial aggregation, so a late group is the late
    rows of one task that share a window and key."""
    return [
        (p["batchId"], p["numInputRows"], sum(op["numRowsDroppedByWatermark"] for op in p["stateOperators"]))
        for p in query.recentProgress
        if p["numInputRows"]
    ]
