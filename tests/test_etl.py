"""Pipeline run, observed summary and report refresh; the driver contract."""

import duckdb

import __spark_entry__ as E
from threatlens.plans import etl as P
from threatlens.session import scratch_path
from threatlens.sinks.writers import write_snapshot

SMALL = "/root/testdata/sf0.001"


def test_run_and_refresh(spark):
    root = scratch_path(spark, "test-etl-run")
    logins, traffic, alerts = P.extract(spark, SMALL)
    s = P.run_pipeline(logins, traffic, alerts, root, run_id="20240101_000000")
    assert s.counts["login_attempts_extracted"] == logins.count()
    assert s.counts["traffic_records_extracted"] == traffic.count()
    assert s.counts["security_alerts_processed"] == alerts.count()
    res = P.transform(logins, traffic, alerts)
    assert s.counts["failed_login_metrics"] == res.failed_logins.count()
    assert s.counts["suspicious_traffic_patterns"] == res.suspicious_traffic.filter("anomaly_score > 50").count()
    assert s.counts["critical_high_alerts"] == res.enriched_alerts.filter("priority in ('CRITICAL','HIGH')").count()
    reports = P.report_refresh(spark, root)
    assert sum(r["count"] for r in reports["anomaly_distribution"].collect()) == traffic.count()
    assert [r["sort_order"] for r in reports["priority_distribution"].collect()] == sorted(
        r["sort_order"] for r in reports["priority_distribution"].collect())
    assert reports["login_table"].count() == 10 and "highlight" in reports["alert_table"].columns


def test_entry_and_contract(spark):
    df = E.entry(spark)
    assert df.count() > 0 and df.columns[-1] == "risk_score"
    assert set(E.oracle_sql()) <= set(E.queries())


def test_every_query_matches_its_oracle(spark):
    """The driver's correctness gate, on sf0.001."""
    from check_oracle import TABLES, canon

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    oracle = E.oracle_sql()
    failures = []
    for name, fn in E.queries().items():
        df = fn(spark, SMALL)
        rows = df.collect()
        if name not in oracle:
            continue
        rel = con.execute(oracle[name])
        cols = [d[0] for d in rel.description]
        if sorted(cols) != sorted(df.columns) or canon(df.columns, rows) != canon(cols, rel.fetchall()):
            failures.append(name)
    assert failures == []


def test_sql_views(spark):
    from threatlens.sources import views as V

    names = V.register(spark, SMALL)
    assert "suspicious_traffic" in names
    top = spark.sql(
        "SELECT risk_score, count(*) AS n FROM failed_logins GROUP BY risk_score ORDER BY risk_score DESC"
    ).collect()
    assert sum(r["n"] for r in top) == spark.table("failed_logins").count()
    assert spark.sql("SELECT count(*) FROM enriched_alerts WHERE is_resolved").first()[0] == 0


def test_cluster_conf_scales_partitions():
    from threatlens.session import cluster_conf

    big = cluster_conf(100 * 2**40, executors=1000, cores_per_executor=4)
    assert int(big["spark.sql.shuffle.partitions"]) == 100 * 2**40 // (256 << 20)  # 409,600
    small = cluster_conf(10 << 20, executors=2, cores_per_executor=4)
    assert int(small["spark.sql.shuffle.partitions"]) == 24  # three waves of 8 slots


def test_refresh_without_runs_is_empty(spark):
    root = scratch_path(spark, "test-empty-refresh")
    reports = P.report_refresh(spark, root)
    assert reports["risk_distribution"].count() == 0 and reports["alert_table"].count() == 0
    assert "highlight" in reports["login_table"].columns


def test_extra_sinks_receive_written_results(spark):
    from threatlens.sinks.writers import write_documents

    root = scratch_path(spark, "test-etl-sinks")
    receipts = {}

    def documents(kind, df):
        receipts[kind] = write_documents(df, f"{root}/documents/{kind}")

    s = P.run_pipeline(*P.extract(spark, SMALL), out_root=root, run_id="20240101_000000", sinks=[documents])
    assert set(receipts) == {"failed_logins", "suspicious_traffic", "enriched_alerts"}
    assert receipts["failed_logins"].rows == s.counts["failed_login_metrics"]
    assert receipts["suspicious_traffic"].rows == s.counts["traffic_records_extracted"]
    assert receipts["enriched_alerts"].rows == s.counts["security_alerts_processed"]


def test_refresh_from_flat_layout(spark):
    import os

    folder = scratch_path(spark, "test-flat-refresh")
    base = folder.replace("file:", "")
    os.makedirs(base, exist_ok=True)
    with open(os.path.join(base, "failed_logins_20240101_000000.csv"), "w") as fh:
        fh.write("username,ip_address,failed_attempt_count,first_attempt,last_attempt,time_span_seconds,"
                 "attempts_per_minute,risk_score\n"
                 "u1,10.0.0.1,5,2024-01-01 00:00:00,2024-01-01 00:00:30,30,10.0,100\n"
                 "u2,10.0.0.2,1,2024-01-01 00:00:00,2024-01-01 00:00:00,0,,10\n")
    reports = P.report_refresh(spark, folder, layout="flat")
    assert {r["risk_score"]: r["count"] for r in reports["risk_distribution"].collect()} == {100: 1, 10: 1}
    assert reports["anomaly_distribution"].count() == 0


def test_refresh_with_time_range(spark):
    import datetime as dt

    import pytest

    root = scratch_path(spark, "test-refresh-range")
    P.run_pipeline(*P.extract(spark, SMALL), out_root=root, run_id="20240101_000000")
    everything = P.report_refresh(spark, root)
    as_of = dt.datetime(1998, 8, 2)
    recent = P.report_refresh(spark, root, time_range="30d", as_of=as_of)
    total = lambda d: sum(r["count"] for r in d.collect())
    assert 0 < total(recent["anomaly_distribution"]) < total(everything["anomaly_distribution"])
    with pytest.raises(ValueError):
        P.report_refresh(spark, root, time_range="7d")


def test_parquet_snapshots(spark):
    root = scratch_path(spark, "test-parquet-run")
    s = P.run_pipeline(*P.extract(spark, SMALL), out_root=root, run_id="20240101_000000", snapshot_format="parquet")
    reports = P.report_refresh(spark, root, snapshot_format="parquet")
    assert sum(r["count"] for r in reports["anomaly_distribution"].collect()) == s.counts["traffic_records_extracted"]
    from threatlens.sources import snapshots as S

    alerts = S.read_snapshot(spark, root, "enriched_alerts", fmt="parquet")
    assert alerts.count() == s.counts["security_alerts_processed"]
    assert dict(alerts.dtypes)["detection_details"] == "map<string,string>"


def test_command_line(spark):
    """run, report and queries through the command line (a separate process)."""
    import json
    import os
    import subprocess
    import sys

    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = scratch_path(spark, "test-cli")
    env = dict(os.environ, PYTHONPATH=repo)
    run = subprocess.run([sys.executable, "-m", "threatlens", "run", "--tables", SMALL, "--out", out,
                          "--run-id", "20240101_000000"], capture_output=True, text=True, env=env, timeout=600)
    assert run.returncode == 0, run.stderr[-2000:]
    summary = json.loads(run.stdout.strip().splitlines()[-1])
    assert summary["run_id"] == "20240101_000000" and summary["traffic_records_extracted"] > 0
    rep = subprocess.run([sys.executable, "-m", "threatlens", "report", "--out", out, "--priority", "CRITICAL"],
                         capture_output=True, text=True, env=env, timeout=600)
    assert rep.returncode == 0 and "priority_distribution" in rep.stdout and "CRITICAL" in rep.stdout
    names = subprocess.run([sys.executable, "-m", "threatlens", "queries"], capture_output=True, text=True,
                           env=env, timeout=120).stdout.split()
    assert "traffic_anomalies" in names and len(names) == 53


def test_reports_never_mix_runs(spark):
    root = scratch_path(spark, "test-mixed-runs")
    logins, traffic, alerts = P.extract(spark, SMALL)
    res = P.transform(logins, traffic, alerts)
    write_snapshot(res.failed_logins, root, "failed_logins", "20240101_000000")
    write_snapshot(res.suspicious_traffic, root, "suspicious_traffic", "20240102_000000")
    write_snapshot(res.enriched_alerts, root, "enriched_alerts", "20240102_000000")
    report = P.report_refresh(spark, root)
    assert all(df.count() == 0 for name, df in report.items() if name.endswith("_table"))


def test_sinks_get_typed_results(spark):
    root = scratch_path(spark, "test-typed-sinks")
    got = {}
    P.run_pipeline(*P.extract(spark, SMALL), out_root=root, sinks=[lambda kind, df: got.update({kind: df})])
    want = dict(P.transform(*P.extract(spark, SMALL)).items())
    for kind, df in got.items():
        assert all(f.endswith(".parquet") for f in df.inputFiles())
        assert df.count() == want[kind].count()
