"""Traffic operators: anomaly scoring (C2), connection gaps (W1/W2), port scans (D2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from threatlens.config import TrafficRules
from threatlens.functions.scoring import anomaly_score, large_packet, suspicious_port, unix_seconds
from threatlens.functions.sequence import with_previous
from threatlens.schemas import SUSPICIOUS_TRAFFIC

#: Row order inside a source: the reference orders by timestamp only; the id and
#: tie key make "the previous connection" deterministic under timestamp ties.
TRAFFIC_ORDER = ("timestamp", "traffic_id", "tie_key")

def with_tie_key(traffic: DataFrame) -> DataFrame:
    """Sources whose ``traffic_id`` is already unique (a serial key) carry no
    ``tie_key``; a constant one keeps ``TRAFFIC_ORDER`` valid for them."""
    if "tie_key" in traffic.columns:
        return traffic
    return traffic.withColumn("tie_key", F.lit(0).cast("long"))


#: Fixed: the columns of the scored table, in their order.
SCORED_COLUMNS = tuple(SUSPICIOUS_TRAFFIC.fieldNames())


def rapid_connections(traffic: DataFrame, rules: TrafficRules = TrafficRules()) -> DataFrame:
    """Add ``rapid_connection``: the previous connection of the same source (in
    ``TRAFFIC_ORDER``) is less than ``rules.rapid_gap_s`` whole seconds earlier.

    Gaps are differences of whole epoch seconds and rows are time-ordered, so with the
    default of one second the gap is below it exactly when an earlier row of the same
    source falls in the same second.  That is a row number within (source, second): one
    shuffle, which spreads a hot source over its seconds.  Rows without a timestamp are
    never rapid and each get a partition of their own.  Any other gap takes the exact
    distributed lag (``with_previous``).
    """
    traffic = with_tie_key(traffic)
    sec = unix_seconds(F.col("timestamp"))
    if rules.rapid_gap_s == 1:
        alone = F.when(F.col("timestamp").isNull(), F.xxhash64("traffic_id", "tie_key"))
        seconds = Window.partitionBy("source_ip", sec, alone).orderBy(*TRAFFIC_ORDER)
        rapid = F.col("timestamp").isNotNull() & (F.row_number().over(seconds) > 1)
        return traffic.withColumn("rapid_connection", rapid)
    previous = with_previous(traffic, ["source_ip"], list(TRAFFIC_ORDER), "timestamp", "_previous")
    gap = unix_seconds(F.col("timestamp")) - unix_seconds(F.col("_previous"))
    return previous.withColumn("rapid_connection", F.coalesce(gap < rules.rapid_gap_s, F.lit(False))).drop("_previous")


def with_scores(
    flagged: DataFrame, rules: TrafficRules = TrafficRules(), extra: Sequence[str] = ()
) -> DataFrame:
    """The scored columns of rows with ``rapid_connection``, then the ``extra`` ones."""
    scored = flagged.withColumns(
        {
            "suspicious_port": suspicious_port(F.col("port"), rules),
            "large_packet": large_packet(F.col("packet_size"), rules),
        }
    ).withColumn(
        "anomaly_score",
        anomaly_score(
            F.col("is_suspicious"), F.col("rapid_connection"), F.col("suspicious_port"), F.col("large_packet")
        ),
    )
    return scored.select(*SCORED_COLUMNS, *extra)


def traffic_anomalies(traffic: DataFrame, rules: TrafficRules = TrafficRules()) -> DataFrame:
    """Score every connection (rows are kept, only scored); the 12 output columns of
    the suspicious-traffic table in their order.  Not sorted (see ``reports``)."""
    return with_scores(rapid_connections(traffic, rules), rules)


def connection_gaps(traffic: DataFrame) -> DataFrame:
    """Previous connection time of the same source and the whole-second gap to it
    (null for a source's first connection): the lag the reference computes, done
    with an exact distributed row numbering instead of one task per source."""
    prev = with_previous(
        with_tie_key(traffic).select("traffic_id", "tie_key", "source_ip", "timestamp"),
        keys=["source_ip"],
        order=list(TRAFFIC_ORDER),
        value="timestamp",
        alias="prev_timestamp",
    )
    return prev.select(
        "traffic_id",
        "tie_key",
        "source_ip",
        "timestamp",
        "prev_timestamp",
        F.when(
            F.col("prev_timestamp").isNotNull(),
            unix_seconds(F.col("timestamp")) - unix_seconds(F.col("prev_timestamp")),
        ).alias("time_diff_seconds"),
    )


def port_scans(
    traffic: DataFrame,
    keys: Sequence[str] = ("source_ip", "destination_ip"),
    window: str = "60 seconds",
    min_ports: int = 5,
) -> DataFrame:
    """Tumbling windows (epoch-aligned) in which one key touched at least
    ``min_ports`` distinct ports.  Distinct counting is a two-phase aggregate
    (key, window, port) -> (key, window), both partially aggregated map-side."""
    keys = list(keys)
    grouped = (
        traffic.filter(F.col("timestamp").isNotNull())
        .groupBy(*keys, F.window("timestamp", window).alias("w"))
        .agg(
            F.count_distinct("port").alias("distinct_ports"),
            F.count(F.lit(1)).alias("connections"),
            F.min("timestamp").alias("first_seen"),
            F.max("timestamp").alias("last_seen"),
        )
    )
    return grouped.filter(F.col("distinct_ports") >= min_ports).select(
        *keys,
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        "distinct_ports",
        "connections",
        "first_seen",
        "last_seen",
    )


#: Standard error of a distinct count from a sketch of 2**k registers is about 1.04 / 2**(k/2).
SKETCH_BITS = 12


def _panes(seconds: F.Column, pane_s: int) -> F.Column:
    return F.floor(seconds / pane_s).cast("long")


def sliding_scan_candidates(
    traffic: DataFrame, keys: Sequence[str], window_s: int, slide_s: int, min_ports: int, sketch_bits: int = SKETCH_BITS
) -> DataFrame:
    """(keys, first pane) of the sliding windows that may hold ``min_ports`` distinct ports.

    One HyperLogLog sketch of the ports per key and pane of ``slide_s``, merged map-side; a
    window is the union of its panes' sketches, so overlapping windows share all counting
    and no port is a row.  A window passes if its estimate is at most three standard errors below the limit."""
    panes = (
        traffic.filter(F.col("timestamp").isNotNull())
        .groupBy(*keys, _panes(unix_seconds(F.col("timestamp")), slide_s).alias("pane"))
        .agg(F.hll_sketch_agg("port", sketch_bits).alias("ports"))
    )
    starts = F.sequence(F.col("pane") - (window_s // slide_s - 1), F.col("pane"))
    windows = panes.select(*keys, F.explode(starts).alias("first_pane"), "ports")
    union = windows.groupBy(*keys, "first_pane").agg(F.hll_union_agg("ports").alias("ports"))
    error = 1.04 / 2 ** (sketch_bits / 2)
    return union.filter(F.hll_sketch_estimate("ports") >= min_ports * (1 - 3 * error)).select(*keys, "first_pane")


def sliding_port_scans(
    traffic: DataFrame,
    keys: Sequence[str] = ("source_ip", "destination_ip"),
    window_s: int = 60,
    slide_s: int = 10,
    min_ports: int = 5,
    sketch_bits: int = SKETCH_BITS,
) -> DataFrame:
    """Sliding windows (epoch-aligned, every ``slide_s``) in which one key touched at least
    ``min_ports`` distinct ports.

    Sketches find the candidate windows; only the rows of their panes are looked at again
    and counted exactly, so rows are not multiplied by the windows that hold them unless a
    candidate needs them."""
    if slide_s < 1 or window_s % slide_s:
        raise ValueError("the window must be a whole number of slides")
    keys = list(keys)
    found = sliding_scan_candidates(traffic, keys, window_s, slide_s, min_ports, sketch_bits).withColumns({f"_k{i}": F.struct(k) for i, k in enumerate(keys)})
    found = found.drop(*keys)
    span = window_s // slide_s
    rows = traffic.filter(F.col("timestamp").isNotNull()).select(
        *[F.struct(k).alias(f"_k{i}") for i, k in enumerate(keys)], "port", "timestamp", _panes(unix_seconds(F.col("timestamp")), slide_s).alias("pane")
    )
    same = [f"_k{i}" for i in range(len(keys))]  # as structs, null keys meet as well
    wanted = found.select(*same, "first_pane", F.explode(F.sequence("first_pane", F.col("first_pane") + span - 1)).alias("pane"))
    # per pane and port first: a busy port is a row, not its connections
    ports = rows.groupBy(*same, "pane", "port").agg(
        F.count(F.lit(1)).alias("connections"), F.min("timestamp").alias("first_seen"), F.max("timestamp").alias("last_seen")
    )
    counted = ports.join(wanted, [*same, "pane"]).groupBy(*same, "first_pane").agg(
        F.count_distinct("port").alias("distinct_ports"),
        F.sum("connections").alias("connections"),
        F.min("first_seen").alias("first_seen"),
        F.max("last_seen").alias("last_seen"),
    )
    start = F.timestamp_add("SECOND", F.col("first_pane") * slide_s, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    return counted.filter(F.col("distinct_ports") >= min_ports).select(
        *[F.col(f"_k{i}.{k}").alias(k) for i, k in enumerate(keys)],
        start.alias("window_start"),
        F.timestamp_add("SECOND", F.lit(window_s), start).alias("window_end"),
        "distinct_ports",
        "connections",
        "first_seen",
        "last_seen",
    )
