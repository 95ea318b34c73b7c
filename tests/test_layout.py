"""Charts from one scan, clustered files, sliding windows by sketches, keys by bitmaps."""

import datetime as dt
import glob
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from threatlens.operators import alerts as A
from threatlens.operators import contracts as C
from threatlens.operators import logins as L
from threatlens.operators import reports as R
from threatlens.operators import traffic as TR
from threatlens.sinks import clustering as CL
from threatlens.sources import views as V

SMALL = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_charts_equal_the_single_reports(spark):
    failed = L.failed_login_metrics(V.login_attempts(spark, SMALL))
    scored = TR.traffic_anomalies(V.network_traffic(spark, SMALL))
    enriched = A.prioritize_alerts(A.unresolved(V.security_alerts(spark, SMALL)))
    charts = R.refresh_charts(failed, scored, enriched, (10, 20), ["HIGH", "LOW"])
    assert plan(charts).count("Relation [") == 3  # one scan of each dataset
    got = {}
    for r in charts.collect():
        got.setdefault(r["chart"], {})[r["label"]] = r["value"]
    bars = lambda df, c: {str(r[c]).lower() if isinstance(r[c], bool) else str(r[c]): r["count"] for r in df.collect()}
    assert got["risk_distribution"] == bars(R.risk_distribution(failed, 10, 20), "risk_score")
    assert got["anomaly_distribution"] == bars(R.anomaly_distribution(scored), "anomaly_score")
    assert got["priority_distribution"] == bars(R.priority_distribution(enriched, ["HIGH", "LOW"]), "priority")
    assert got["alert_type_distribution"] == bars(R.alert_type_distribution(enriched, ["HIGH", "LOW"]), "alert_type")
    assert got["action_summary"] == bars(R.action_summary(enriched), "action_required")
    cards = {r["card"]: (r["total"], r["flagged"]) for r in R.kpi_cards(failed, scored, enriched).collect()}
    kpi = got["kpi"]
    assert (kpi["failed_logins"], kpi["high_risk_logins"]) == cards["failed_logins"]
    assert (kpi["suspicious_traffic"], kpi["high_anomalies"]) == cards["suspicious_traffic"]
    assert (kpi["security_alerts"], kpi["critical_alerts"]) == cards["security_alerts"] and kpi["actions_required"] == cards["actions_required"][0]


def test_charts_of_nothing_are_totals_of_zero(spark):
    failed = L.failed_login_metrics(V.login_attempts(spark, SMALL)).filter("false")
    scored = TR.traffic_anomalies(V.network_traffic(spark, SMALL)).filter("false")
    enriched = A.prioritize_alerts(V.security_alerts(spark, SMALL)).filter("false")
    assert {r["value"] for r in R.refresh_charts(failed, scored, enriched).collect()} <= {0}


def test_interleaved_bits(spark):
    row = spark.range(1).select(CL.interleaved([F.lit(0b101), F.lit(0b011)], 3).alias("z")).first()
    assert row["z"] == 0b100111
    with pytest.raises(ValueError):
        CL.interleaved([F.lit(0)] * 9, 7)


def test_clustered_files_skip_row_groups(spark, tmp_path):
    """A filter on two of the columns meets under a quarter of the row groups, and the rows are all there."""
    rng = random.Random(4)
    base = dt.datetime(2024, 1, 1)
    sources = ["10.0.%d.%d" % (i // 16, i % 16) for i in range(256)]
    rows = [(rng.randint(0, 10**6), rng.choice(sources) if rng.random() < 0.99 else None, base + dt.timedelta(seconds=rng.randint(0, 10**6))) for _ in range(30_000)]
    df = spark.createDataFrame(rows, "score int, source string, at timestamp_ntz").repartition(4)
    path = str(tmp_path / "clustered")
    CL.write_clustered(df, path, ["score", "source", "at"], files=64, bits=4)
    wanted = (F.col("score") < 150_000) & F.col("source").between("10.0.3.0", "10.0.4.9")
    back = spark.read.parquet(path)
    assert sorted(map(str, back.filter(wanted).collect())) == sorted(map(str, df.filter(wanted).collect()))
    assert back.count() == len(rows)
    met = total = 0
    for file in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(file).metadata
        for g in range(meta.num_row_groups):
            stats = {meta.row_group(g).column(c).path_in_schema: meta.row_group(g).column(c).statistics for c in range(meta.num_columns)}
            total += 1
            low = stats["score"].min < 150_000
            met += low and (not stats["source"].has_min_max or (stats["source"].min <= "10.0.4.9" and stats["source"].max >= "10.0.3.0"))
    assert total >= 40 and met < total / 4
    with pytest.raises(ValueError):
        CL.write_clustered(df, path, [])


def brute_sliding(rows, window, slide, least):
    found = {}
    for key, port, at in rows:
        if at is not None:
            second = int((at - dt.datetime(1970, 1, 1)).total_seconds())
            for k in range(window // slide):
                found.setdefault((key, second // slide * slide - k * slide), []).append((port, at))
    return {
        (key, start, len({p for p, _ in v if p is not None}), len(v), min(t for _, t in v), max(t for _, t in v))
        for (key, start), v in found.items()
        if len({p for p, _ in v if p is not None}) >= least
    }


def test_sliding_scans_equal_brute_force(spark):
    rng = random.Random(5)
    base = dt.datetime(2024, 1, 1)
    rows = [(rng.choice(["a", "b", None]), rng.choice([None, *range(40)]), None if rng.random() < 0.05 else base + dt.timedelta(seconds=rng.randint(0, 600))) for _ in range(900)]
    rows += [("scan", p, base + dt.timedelta(seconds=p // 100)) for p in range(3000)]  # beyond a sketch's exact range
    df = spark.createDataFrame(rows, "source_ip string, port int, timestamp timestamp_ntz").repartition(4)
    for least in (3, 12, 900):
        got = TR.sliding_port_scans(df, ["source_ip"], 60, 10, least).collect()
        epoch = dt.datetime(1970, 1, 1)
        seen = {(r["source_ip"], int((r["window_start"] - epoch).total_seconds()), r["distinct_ports"], r["connections"], r["first_seen"], r["last_seen"]) for r in got}
        assert seen == brute_sliding(rows, 60, 10, least) and len(got) == len(seen) > 0
        assert all(r["window_end"] - r["window_start"] == dt.timedelta(seconds=60) for r in got)
    with pytest.raises(ValueError):
        TR.sliding_port_scans(df, ["source_ip"], 60, 7)


@pytest.mark.parametrize("keys", [[1, 2, 3], [1, 1, 2, None, None], [40_000, 40_000, 40_000, 7, -5, -5, -32769, 2**62], [], [None]])
def test_key_violations_equal_the_full_count(spark, keys):
    df = spark.createDataFrame([(k,) for k in keys], "id long").repartition(3)
    contract = C.Contract("t", primary_key=("id",))
    assert C.key_violations(df, contract).collect() == C.contract_violations(df, contract).collect()


def test_key_violations_need_one_whole_number(spark):
    df = spark.createDataFrame([("a", 1)], "a string, b int")
    for key in (("a",), ("a", "b")):
        with pytest.raises(ValueError):
            C.key_violations(df, C.Contract("t", primary_key=key))


def test_frequent_values_keep_their_ranges_and_share_no_file(spark, tmp_path):
    """A sample of rows, not of keys: a value on many rows hides no other.  Rows that are alike
    in all the columns are still dealt to several files."""
    n = 40_000
    df = spark.range(n).select("id", (F.col("id") % 5 * 20).alias("score"), (F.col("id") % 8).alias("day"))
    places = CL.with_curve_position(df, ["score", "day"], "place").select("place").distinct().count()
    assert places == 5 * 8
    alike = df.withColumns({"score": F.when(F.col("id") % 10 > 0, F.lit(50)), "day": F.lit(1)})
    for name, rows in (("even", df), ("alike", alike)):
        path = str(tmp_path / name)
        CL.write_clustered(rows, path, ["score", "day"], files=10)
        back = spark.read.parquet(path)
        sizes = [r["count"] for r in back.groupBy(F.input_file_name()).count().collect()]
        assert sum(sizes) == n and max(sizes) < n / 4
        assert back.exceptAll(rows).count() == 0
