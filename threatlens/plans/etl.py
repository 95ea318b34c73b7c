"""The batch pipeline (X1), its run summary (X2) and the report refresh (X3).

Each scored result is computed once, by its own write; the six summary counts ride
along as ``Observation`` metrics of those writes, so no source is scanned twice and
no result is counted by a separate job.
"""

from __future__ import annotations

import datetime as dt
import time
from concurrent.futures import ThreadPoolExecutor
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from threatlens.config import AlertRules, PipelineConfig
from threatlens.operators import alerts as A
from threatlens.operators import logins as L
from threatlens.operators import reports as R
from threatlens.operators import traffic as TR
from threatlens.schemas import RESULT_SCHEMAS, empty
from threatlens.session import scratch_path
from threatlens.sinks.writers import Receipt, write_snapshot
from threatlens.sources import snapshots as S
from threatlens.sources import views as V

#: An extra sink: called with (kind, result DataFrame) after the snapshot is written;
#: the DataFrame reads a typed copy of the result, never CSV, and nothing is computed twice.
Sink = Callable[[str, DataFrame], object]


@dataclass(frozen=True)
class Results:
    failed_logins: DataFrame
    suspicious_traffic: DataFrame
    enriched_alerts: DataFrame

    def items(self):
        return (
            ("failed_logins", self.failed_logins),
            ("suspicious_traffic", self.suspicious_traffic),
            ("enriched_alerts", self.enriched_alerts),
        )


@dataclass
class RunSummary:
    run_id: str
    started: dt.datetime
    finished: dt.datetime
    counts: dict[str, int]
    receipts: dict[str, Receipt] = field(default_factory=dict)

    @property
    def duration_s(self) -> float:
        return (self.finished - self.started).total_seconds()

    def to_frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(
            [(k, int(v)) for k, v in self.counts.items()], "metric string, value bigint"
        )


def run_id_for(moment: dt.datetime) -> str:
    return moment.strftime("%Y%m%d_%H%M%S")


def extract(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sources of one run: all logins, all traffic, unresolved alerts."""
    return (
        V.login_attempts(spark, sf_dir),
        V.network_traffic(spark, sf_dir),
        A.unresolved(V.security_alerts(spark, sf_dir)),
    )


def transform(
    logins: DataFrame, traffic: DataFrame, alerts: DataFrame, cfg: PipelineConfig = PipelineConfig()
) -> Results:
    return Results(
        L.failed_login_metrics(logins, cfg.logins),
        TR.traffic_anomalies(traffic, cfg.traffic),
        A.prioritize_alerts(alerts, cfg.alerts),
    )


def run_pipeline(
    logins: DataFrame,
    traffic: DataFrame,
    alerts: DataFrame,
    out_root: str,
    run_id: str | None = None,
    cfg: PipelineConfig = PipelineConfig(),
    sinks: Iterable[Sink] = (),
    snapshot_format: str = "csv",
) -> RunSummary:
    """Extract → transform → load.  Writes one snapshot per result kind under
    ``out_root`` (partition ``run_id``), then hands each result to the extra sinks
    (JDBC tables, document collections).  Errors are raised, not swallowed."""
    started = dt.datetime.now()
    run_id = run_id or run_id_for(started)
    spark = logins.sparkSession
    obs_logins = Observation("logins_extracted")
    obs_traffic = Observation("traffic_scored")
    obs_alerts = Observation("alerts_enriched")
    observed_logins = logins.observe(obs_logins, F.count(F.lit(1)).alias("n"))
    res = transform(observed_logins, traffic, alerts, cfg)
    scored = res.suspicious_traffic.observe(
        obs_traffic,
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("anomaly_score") > cfg.summary_anomaly).alias("suspicious"),
    )
    enriched = res.enriched_alerts.observe(
        obs_alerts,
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("priority").isin(*cfg.urgent_priorities)).alias("urgent"),
    )
    # the three writes are independent jobs: submitted together, the scheduler
    # overlaps them instead of leaving slots idle between them
    outputs = {
        "failed_logins": res.failed_logins,
        "suspicious_traffic": scored,
        "enriched_alerts": enriched,
    }
    sinks = list(sinks)
    typed_root = out_root
    if sinks and snapshot_format == "csv":
        typed_root = scratch_path(spark, "typed-results")

    def write(kind: str, df: DataFrame) -> Receipt:
        if typed_root != out_root:
            write_snapshot(df, typed_root, kind, run_id, fmt="parquet")
            df = S.read_snapshot(spark, typed_root, kind, run_id, fmt="parquet")
        return write_snapshot(df, out_root, kind, run_id, fmt=snapshot_format)

    with ThreadPoolExecutor(max_workers=len(outputs)) as pool:
        futures = {kind: pool.submit(write, kind, df) for kind, df in outputs.items()}
        receipts = {kind: f.result() for kind, f in futures.items()}
    for sink in sinks:
        for kind, _ in res.items():
            sink(kind, S.read_snapshot(spark, typed_root, kind, run_id, fmt="parquet"))
    counts = {
        "login_attempts_extracted": obs_logins.get["n"],
        "failed_login_metrics": receipts["failed_logins"].rows,
        "traffic_records_extracted": obs_traffic.get["n"],
        "suspicious_traffic_patterns": obs_traffic.get["suspicious"],
        "security_alerts_processed": obs_alerts.get["n"],
        "critical_high_alerts": obs_alerts.get["urgent"],
    }
    return RunSummary(run_id, started, dt.datetime.now(), counts, receipts)


def report_refresh(
    spark: SparkSession,
    out_root: str,
    run_id: str | None = None,
    risk_range: tuple[int, int] = (0, 100),
    priorities: Iterable[str] | None = None,
    page_size: int = 10,
    page_no: int = 0,
    layout: str = "runs",
    time_range: str = "all",
    as_of=None,
    snapshot_format: str = "csv",
) -> dict[str, DataFrame]:
    """Reports of one run (default: the latest run present for every kind): the four
    charts and one page of the three tables, all lazy DataFrames.  ``charts`` holds all
    charts and cards in one frame, from one scan of each snapshot; the single charts are
    there for a page that shows one of them.

    ``layout="flat"`` reads existing ``<kind>_YYYYmmdd_HHMMSS.csv`` files instead (the
    newest of each kind).  ``time_range`` ("all", "24h", "7d", "30d") keeps rows whose
    time (last failed attempt, connection, alert) lies in the range ending at ``as_of``,
    which is required for any range but "all"."""
    if layout == "flat":
        failed, scored, enriched = (
            S.read_flat_snapshot(spark, out_root, k) for k in ("failed_logins", "suspicious_traffic", "enriched_alerts")
        )
    elif layout == "runs":
        run_id = run_id or S.latest_run_id(spark, out_root)
        # without a run that all kinds have, the report is empty: runs are never mixed
        failed, scored, enriched = (
            S.read_snapshot(spark, out_root, kind, run_id, fmt=snapshot_format) if run_id else empty(spark, RESULT_SCHEMAS[kind])
            for kind in ("failed_logins", "suspicious_traffic", "enriched_alerts")
        )
    else:
        raise ValueError(f"unknown layout {layout!r}; use 'runs' or 'flat'")
    if time_range != "all":
        if as_of is None:
            raise ValueError("a time range needs an explicit as_of")
        failed = R.time_range(failed, "last_attempt", as_of, time_range)
        scored = R.time_range(scored, "timestamp", as_of, time_range)
        enriched = R.time_range(enriched, "timestamp", as_of, time_range)
    selected = list(priorities) if priorities is not None else None
    return {
        "charts": R.refresh_charts(failed, scored, enriched, risk_range, selected),
        "risk_distribution": R.risk_distribution(failed, *risk_range).orderBy("risk_score"),
        "anomaly_distribution": R.anomaly_distribution(scored).orderBy("anomaly_score"),
        "priority_distribution": R.priority_distribution(enriched, selected).orderBy("sort_order"),
        "alert_type_distribution": R.alert_type_distribution(enriched, selected).orderBy(
            F.desc("count"), "alert_type"
        ),
        "login_table": R.table_page(R.highlight(failed, "failed_logins"), "failed_logins", page_no, page_size),
        "traffic_table": R.table_page(R.highlight(scored, "suspicious_traffic"), "suspicious_traffic", page_no, page_size),
        "alert_table": R.table_page(R.highlight(enriched, "enriched_alerts"), "alerts_table", page_no, page_size),
    }


def etl_run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run the whole pipeline into a fresh folder of the shared scratch area and
    return its summary counts as (metric, value)."""
    out = scratch_path(spark, "etl-run")
    summary = run_pipeline(*extract(spark, sf_dir), out_root=out, run_id="20240101_000000")
    return summary.to_frame(spark)


def refreshed_priorities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs into one folder, the older one with other priority bands (no
    CRITICAL); the refresh must report the newer run."""
    out = scratch_path(spark, "refresh")
    older = PipelineConfig(alerts=AlertRules(priority_bands=((101, "CRITICAL"), (50, "HIGH"), (20, "MEDIUM"))))
    run_pipeline(*extract(spark, sf_dir), out_root=out, run_id="20240101_000000", cfg=older, snapshot_format="parquet")
    run_pipeline(*extract(spark, sf_dir), out_root=out, run_id="20240102_000000", snapshot_format="parquet")
    return report_refresh(spark, out, snapshot_format="parquet")["priority_distribution"]


def bench_full_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    t0 = time.perf_counter()
    frame = etl_run_summary(spark, sf_dir)
    return frame.withColumn("seconds", F.lit(round(time.perf_counter() - t0, 3)))
