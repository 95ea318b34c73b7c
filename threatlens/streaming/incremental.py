"""Incremental versions of the three scores (R1-R4) and two detectors with Structured
Streaming.  Every row counts, in whatever order the files come.

* R1 ``failed_logins_stream``, its windowed variant and the detectors D1 and D2 are streaming
  aggregations without a watermark: Spark's state store holds one row per group (for bursts
  per key and second, for port scans per key, window and port), and in update mode a batch
  hands on the groups that it changed.  ``read_*`` takes the newest row of each group and
  finishes the operator, so late rows count and no window stays open.
  ``streaming/windows.py`` has the variants that finish windows and drop late rows.
* R2 ``score_traffic_stream``: ``foreachBatch``; a connection is rapid if it is not the
  first of its (source, second), so the state is the first row of each (source, second).
  It is kept by day (or another period), and a batch reads the days of its own rows only.  A late row that precedes a
  stored first row makes that one rapid: the row is written again as a correction, and
  ``read_scored`` puts it in place.
* R3 ``score_alerts_stream``: stateless projection (parquet file sink, exactly once).
* R4: the dashboard refresh period is the default processing-time trigger;
  ``available_now=True`` processes what is there and stops (tests, backfills).

Everything a batch writes lies under its batch id and is written with overwrite, and a
batch reads only what earlier batches wrote, so a retried batch replaces its own files.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.window import Window

from threatlens.config import AlertRules, LoginRiskRules, TrafficRules
from threatlens.functions.scoring import unix_seconds
from threatlens.operators.alerts import prioritize_alerts, unresolved
from threatlens.operators.logins import bursts_of_seconds, failed_logins_by, failures_by_second, with_login_risk
from threatlens.operators.traffic import SCORED_COLUMNS, TRAFFIC_ORDER, with_scores, with_tie_key

REFRESH_PERIOD = "5 minutes"


@dataclass(frozen=True)
class Trigger:
    processing_time: str = REFRESH_PERIOD
    available_now: bool = False

    def apply(self, writer):
        if self.available_now:
            return writer.trigger(availableNow=True)
        return writer.trigger(processingTime=self.processing_time)


def read_stream(spark: SparkSession, path: str, schema=None, max_files_per_trigger: int | None = None) -> DataFrame:
    """A parquet folder (or a single file) as a stream; the schema defaults to the
    files' own."""
    schema = schema or spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(p) and fs.getFileStatus(p).isFile():
        # the file source needs a directory as its base; as a glob, the file's own
        # folder becomes the base
        path = f"{p.getParent().toString()}/{{{p.getName()}}}"
    return reader.parquet(path)


# --------------------------------------------------------------------------- keyed results

def update_stream(grouped: DataFrame, root: str, checkpoint: str, trigger: Trigger = Trigger()) -> StreamingQuery:
    """A streaming aggregation whose changed groups are written batch by batch; its state
    is Spark's own (set ``spark.sql.streaming.stateStore.providerClass`` to the RocksDB
    provider for many groups)."""

    def publish(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/updates/batch_id={batch_id}")

    writer = grouped.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(publish)
    return trigger.apply(writer).start()


def latest(spark: SparkSession, root: str, keys: Sequence[str]) -> DataFrame:
    """The newest row of each group."""
    updates = spark.read.option("basePath", f"{root}/updates").parquet(f"{root}/updates")
    values = [c for c in updates.columns if c not in (*keys, "batch_id")]
    newest = updates.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch_id").alias("v"))
    return newest.select(*keys, *[F.col(f"v.{c}").alias(c) for c in values])


# --------------------------------------------------------------------------- R1

LOGIN_KEYS = ["username", "ip_address"]


def failed_logins_stream(logins: DataFrame, out_root: str, checkpoint: str, trigger: Trigger = Trigger()) -> StreamingQuery:
    """Failed logins per (username, ip_address)."""
    return update_stream(failed_logins_by(logins, LOGIN_KEYS), out_root, checkpoint, trigger)


def read_failed_logins(spark: SparkSession, out_root: str, rules: LoginRiskRules = LoginRiskRules()) -> DataFrame:
    """The metrics of all rows so far, as the batch operator gives them."""
    return with_login_risk(latest(spark, out_root, LOGIN_KEYS), LOGIN_KEYS, rules)


def _window_start(seconds: int) -> Column:
    """The start of the epoch-aligned window of a row, as wall-clock time."""
    sec = unix_seconds(F.col("timestamp"))
    return _wall(sec - F.pmod(sec, F.lit(seconds)))


def _wall(seconds: Column) -> Column:
    """Epoch seconds as UTC wall-clock time, without the session zone."""
    return F.timestamp_add("SECOND", seconds, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


WINDOW_KEYS = ["window_start", *LOGIN_KEYS]


def windowed_failed_logins_stream(
    logins: DataFrame, out_root: str, checkpoint: str, window_s: int = 3600, trigger: Trigger = Trigger()
) -> StreamingQuery:
    """Failed logins per event-time window; rows without a time are in no window."""
    timed = logins.filter(F.col("timestamp").isNotNull()).withColumn("window_start", _window_start(window_s))
    return update_stream(failed_logins_by(timed, WINDOW_KEYS), out_root, checkpoint, trigger)


def read_windowed_failed_logins(
    spark: SparkSession, out_root: str, window_s: int = 3600, rules: LoginRiskRules = LoginRiskRules()
) -> DataFrame:
    end = F.timestamp_add("SECOND", F.lit(window_s), F.col("window_start"))
    groups = latest(spark, out_root, WINDOW_KEYS).withColumn("window_end", end)
    return with_login_risk(groups, ["window_start", "window_end", *LOGIN_KEYS], rules)


# --------------------------------------------------------------------------- R2

#: The source as a struct, so that a null source is a key like any other.
FIRST_KEYS = ("source", "second")


def _keyed(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"source": F.struct("source_ip"), "second": unix_seconds(F.col("timestamp"))})


#: Tasks that write one period's state, so that a busy one is not one task.
STATE_FILES = 8


def _period(second: Column, period_s: int) -> Column:
    return F.floor(second / period_s).cast("int")


def _earlier(spark: SparkSession, path: str, periods: Sequence[int], batch_id: int, schema: T.StructType) -> DataFrame:
    """The first rows of these periods as earlier batches left them; others are not even listed."""
    jvm = spark.sparkContext._jvm
    fs = jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [f"{path}/period={p}" for p in periods if fs.exists(jvm.org.apache.hadoop.fs.Path(f"{path}/period={p}"))]
    if not found:
        return spark.createDataFrame([], schema)
    with_batch = T.StructType([*schema.fields, T.StructField("period", T.IntegerType()), T.StructField("batch_id", T.LongType())])
    stored = spark.read.schema(with_batch).option("basePath", path).parquet(*found)
    return stored.filter(F.col("batch_id") < batch_id).drop("period", "batch_id")


def process_traffic_batch(
    batch: DataFrame, batch_id: int, out_root: str, rules: TrafficRules = TrafficRules(), period_s: int = 86400
) -> None:
    """One micro-batch of R2 (the ``foreachBatch`` body).

    ``scored`` gets every row of the batch, with ``late`` (older than the newest row of
    earlier batches) and, for readers, ``tie_key``; ``corrections`` the earlier rows that
    a late row has made rapid; ``metrics`` the counts; ``state`` the first rows of each
    (source, second), by period of ``period_s`` seconds and by batch.  The batch reads the
    state of its own periods and the metrics of the batch before, so its work does not grow
    with the history.  Events of a short time belong to one or two days; give a longer period
    where a batch's events are spread over many.

    The batch's rows and the stored ones are shuffled and sorted once, together; the three
    outputs are filters of that, kept until they are written."""
    if rules.rapid_gap_s != 1:
        raise ValueError("the stream's state holds the first row of a second: rapid_gap_s must be 1")
    spark = batch.sparkSession
    batch = with_tie_key(batch)
    columns = batch.columns
    newest = None
    if batch_id:
        newest = spark.read.parquet(f"{out_root}/metrics/batch_id={batch_id - 1}").first()["newest_second"]
    # one number for each period that the batch touches
    timed = _keyed(batch.filter(F.col("timestamp").isNotNull())).select(_period(F.col("second"), period_s).alias("period"))
    periods = sorted(r["period"] for r in timed.distinct().collect())
    keyed = _keyed(batch).select(*FIRST_KEYS, F.struct(*columns).alias("row"))
    known = _earlier(spark, f"{out_root}/state", periods, batch_id, keyed.schema).select("row.*")
    # a stored row comes before an equal one of the batch
    rows = batch.withColumn("_stored", F.lit(False)).unionByName(known.withColumn("_stored", F.lit(True)))
    second = unix_seconds(F.col("timestamp"))
    alone = F.when(F.col("timestamp").isNull(), F.xxhash64("traffic_id", "tie_key"))
    seconds = Window.partitionBy("source_ip", second, alone).orderBy(*TRAFFIC_ORDER, F.desc("_stored"))
    marked = rows.withColumns({"_place": F.row_number().over(seconds), "_stored_so_far": F.count_if("_stored").over(seconds)}).persist()
    try:
        rapid = F.col("timestamp").isNotNull() & (F.col("_place") > 1)
        late = F.coalesce(second < F.lit(newest), F.lit(False)) if newest is not None else F.lit(False)
        flagged = marked.filter(~F.col("_stored")).withColumns({"rapid_connection": rapid, "late": late})
        counts = Observation(f"traffic_{batch_id}")
        scored = with_scores(flagged, rules, [*(c for c in columns if c not in SCORED_COLUMNS), "late"])
        scored.observe(
            counts,
            F.count(F.lit(1)).alias("scored"),
            F.count_if("late").alias("late"),
            F.max(second).alias("newest"),
        ).write.mode("overwrite").parquet(f"{out_root}/scored/batch_id={batch_id}")
        # a stored first row that is first no longer
        lost = marked.filter(F.col("_stored") & (F.col("_stored_so_far") == 1) & (F.col("_place") > 1))
        corrected = Observation(f"corrections_{batch_id}")
        with_scores(lost.withColumn("rapid_connection", F.lit(True)), rules, ["tie_key"]).observe(
            corrected, F.count(F.lit(1)).alias("n")
        ).write.mode("overwrite").parquet(f"{out_root}/corrections/batch_id={batch_id}")
        # the batch's firsts that are first still; a retry overwrites its own batch's folders
        first = _keyed(marked.filter(~F.col("_stored") & (F.col("_place") == 1) & F.col("timestamp").isNotNull()))
        first = first.select(*FIRST_KEYS, F.struct(*columns).alias("row"))
        first = first.withColumns({"period": _period(F.col("second"), period_s), "batch_id": F.lit(batch_id).cast("long")})
        spread = first.repartition("period", F.pmod(F.xxhash64("second"), F.lit(STATE_FILES)))
        writer = spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("period", "batch_id")
        writer.parquet(f"{out_root}/state")
    finally:
        marked.unpersist()
    seen = counts.get
    top = max((x for x in (newest, seen["newest"]) if x is not None), default=None)
    # written last: the next batch needs it
    spark.createDataFrame(
        [(seen["scored"], seen["late"], corrected.get["n"], top)], "scored long, late long, corrections long, newest_second long"
    ).write.mode("overwrite").parquet(f"{out_root}/metrics/batch_id={batch_id}")


def score_traffic_stream(
    traffic: DataFrame,
    out_root: str,
    checkpoint: str,
    rules: TrafficRules = TrafficRules(),
    trigger: Trigger = Trigger(),
    period_s: int = 86400,
) -> StreamingQuery:
    def process(batch: DataFrame, batch_id: int) -> None:
        process_traffic_batch(batch, batch_id, out_root, rules, period_s)

    return trigger.apply(traffic.writeStream.option("checkpointLocation", checkpoint).foreachBatch(process)).start()


def read_scored(spark: SparkSession, out_root: str) -> DataFrame:
    """All rows scored so far, corrected ones in their last form."""
    scored = spark.read.parquet(f"{out_root}/scored").drop("batch_id")
    corrections = spark.read.parquet(f"{out_root}/corrections").drop("batch_id")
    # a correction replaces the one row of its order key that is not rapid; as structs, null keys meet as well
    keys = [F.struct("source_ip").alias("_source"), F.struct(*TRAFFIC_ORDER).alias("_place")]
    first = ~F.col("rapid_connection")
    kept = scored.filter(first).select("*", *keys).join(corrections.select(*keys), ["_source", "_place"], "left_anti")
    return scored.filter(~first).unionByName(kept.drop("_source", "_place")).select(*SCORED_COLUMNS).unionByName(corrections.select(*SCORED_COLUMNS))


# --------------------------------------------------------------------------- R3

def score_alerts_stream(
    alerts: DataFrame,
    out_path: str,
    checkpoint: str,
    rules: AlertRules = AlertRules(),
    trigger: Trigger = Trigger(),
    only_unresolved: bool = True,
) -> StreamingQuery:
    src = unresolved(alerts) if only_unresolved else alerts
    writer = (
        prioritize_alerts(src, rules)
        .writeStream.outputMode("append")
        .format("parquet")
        .option("path", out_path)
        .option("checkpointLocation", checkpoint)
    )
    return trigger.apply(writer).start()


# --------------------------------------------------------------------------- detectors

def brute_force_bursts_stream(
    logins: DataFrame,
    out_root: str,
    checkpoint: str,
    keys: tuple[str, ...] = ("username", "ip_address"),
    max_gap_s: int = 60,
    trigger: Trigger = Trigger(),
) -> StreamingQuery:
    """Bursts of failed logins: the state is the failures of each key and second."""
    return update_stream(failures_by_second(logins, keys), out_root, checkpoint, trigger)


def read_bursts(
    spark: SparkSession, out_root: str, keys: tuple[str, ...] = ("username", "ip_address"), max_gap_s: int = 60, min_attempts: int = 5
) -> DataFrame:
    """The bursts of all rows so far; as in batch, no key has to fit in one task."""
    return bursts_of_seconds(latest(spark, out_root, [*keys, "_sec"]), keys, max_gap_s, min_attempts)


def port_scans_stream(
    traffic: DataFrame,
    out_root: str,
    checkpoint: str,
    keys: tuple[str, ...] = ("source_ip", "destination_ip"),
    window_s: int = 60,
    trigger: Trigger = Trigger(),
) -> StreamingQuery:
    """Distinct ports per key and window: the state is one row per port."""
    timed = traffic.filter(F.col("timestamp").isNotNull()).withColumn("window_start", _window_start(window_s))
    ports = timed.groupBy(*keys, "window_start", "port").agg(
        F.count(F.lit(1)).alias("connections"), F.min("timestamp").alias("first_seen"), F.max("timestamp").alias("last_seen")
    )
    return update_stream(ports, out_root, checkpoint, trigger)


def read_port_scans(
    spark: SparkSession, out_root: str, keys: tuple[str, ...] = ("source_ip", "destination_ip"), window_s: int = 60, min_ports: int = 5
) -> DataFrame:
    ports = latest(spark, out_root, [*keys, "window_start", "port"])
    windows = ports.groupBy(*keys, "window_start").agg(
        F.count("port").alias("distinct_ports"),
        F.sum("connections").alias("connections"),
        F.min("first_seen").alias("first_seen"),
        F.max("last_seen").alias("last_seen"),
    )
    end = F.timestamp_add("SECOND", F.lit(window_s), F.col("window_start"))
    return windows.filter(F.col("distinct_ports") >= min_ports).select(
        *keys, "window_start", end.alias("window_end"), "distinct_ports", "connections", "first_seen", "last_seen"
    )
