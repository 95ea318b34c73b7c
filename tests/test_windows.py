"""Windows and sessions that close behind a watermark."""

import datetime as dt

from pyspark.sql import functions as F

from threatlens.operators.logins import brute_force_bursts
from threatlens.session import scratch_path
from threatlens.streaming import incremental as ST
from threatlens.streaming import windows as W

SCHEMA = "username string, ip_address string, success boolean, timestamp timestamp_ntz"
BASE = dt.datetime(2024, 1, 1)
ONCE = ST.Trigger(available_now=True)


def stream_of(spark, files, root):
    """One file, and one micro-batch, for each list of (user, seconds after BASE or None, success)."""
    for rows in files:
        df = spark.createDataFrame([(u, "10.0.0.1", ok, None if s is None else BASE + dt.timedelta(seconds=s)) for u, s, ok in rows], SCHEMA)
        df.coalesce(1).write.mode("append").parquet(f"{root}/src")
    return ST.read_stream(spark, f"{root}/src", schema=df.schema, max_files_per_trigger=1)


FILES = [
    [("a", 0, False), ("a", 10, False), ("b", 3599, False), ("a", 20, True), ("c", None, False)],
    [("a", 7200, False), ("b", 3000, False)],  # 3000 s is not late yet
    [("a", 20_000, False)],
    [("a", 30_000, False), ("b", 100, False)],  # late: its window is closed
]


def test_each_window_once_and_late_rows_counted(spark):
    root = scratch_path(spark, "test-finished")
    query = W.finished_windows_stream(stream_of(spark, FILES, root), f"{root}/out", f"{root}/ck", "1 hour", "10 minutes", ONCE)
    query.awaitTermination()
    got = {(r["window_start"], r["username"], r["failed_attempt_count"]) for r in W.read_finished_windows(spark, f"{root}/out").collect()}
    hour = lambda h: BASE + dt.timedelta(hours=h)
    # the window of 30,000 s is open still
    assert got == {(hour(0), "a", 2), (hour(0), "b", 2), (hour(2), "a", 1), (hour(5), "a", 1)}
    late = W.late_groups(query)
    assert [n for _, n, _ in late] == [5, 2, 1, 2] and sum(n for _, _, n in late) == 1
    rows = query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"]
    assert rows == 1  # closed windows have left the state


def test_closed_bursts_equal_batch_for_files_in_order(spark):
    times = [0, 30, 90, 151, 152, 400, 401, 402, 2000, 2060, 2121, 9000]
    rows = [[(u, t + k, False) for t in times[i : i + 4] for k, u in enumerate(("a", "b"))] + [("a", times[i], True)] for i in range(0, 12, 4)]
    root = scratch_path(spark, "test-closed")
    W.closed_bursts_stream(stream_of(spark, rows, root), f"{root}/out", f"{root}/ck", ("username",), 60, 2, trigger=ONCE).awaitTermination()
    whole = brute_force_bursts(spark.read.parquet(f"{root}/src"), ("username",), 60, 2)
    columns = whole.columns
    assert sorted(spark.read.parquet(f"{root}/out").select(columns).collect()) == sorted(whole.collect()) and whole.count() == 8


def test_wall_clock_is_the_same_in_every_zone(spark):
    df = spark.createDataFrame([(BASE + dt.timedelta(microseconds=123456),)], "t timestamp_ntz")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for z in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", z)
            row = df.select(W.wall_clock(W.instant(F.col("t"))).alias("t"), F.unix_micros(W.instant(F.col("t"))).alias("us")).first()
            assert row["t"] == BASE + dt.timedelta(microseconds=123456) and row["us"] == 1704067200123456
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
