"""Streams equal the batch operators, in whatever order the rows come."""

import datetime as dt

from pyspark.sql import functions as F

from threatlens.operators.logins import brute_force_bursts, failed_login_metrics
from threatlens.operators.traffic import port_scans, traffic_anomalies
from threatlens.session import scratch_path
from threatlens.sources import views as V
from threatlens.streaming import incremental as ST

SMALL = "/root/testdata/sf0.001"


def split_by_time(spark, df, column, parts, root):
    """Write ``df`` as ``parts`` files in time order (one per micro-batch)."""
    ranked = df.withColumn("_b", F.ntile(parts).over(
        __import__("pyspark.sql.window", fromlist=["Window"]).Window.orderBy(column, *df.columns[:1])))
    for b in range(1, parts + 1):
        ranked.filter(F.col("_b") == b).drop("_b").coalesce(1).write.mode("overwrite").parquet(f"{root}/part={b:03d}")
    return [f"{root}/part={b:03d}" for b in range(1, parts + 1)]


def test_traffic_stream_equals_batch(spark):
    root = scratch_path(spark, "test-stream-traffic")
    lineitem = V.table(spark, SMALL, "lineitem")
    src = f"{root}/src"
    for p in split_by_time(spark, lineitem, "l_shipdate", 4, f"{root}/staged"):
        spark.read.parquet(p).write.mode("append").parquet(src)
    stream = ST.read_stream(spark, src, schema=lineitem.schema, max_files_per_trigger=1)
    q = ST.score_traffic_stream(V.network_traffic_from_lineitem(stream), f"{root}/out", f"{root}/ckpt",
                                trigger=ST.Trigger(available_now=True))
    q.awaitTermination()
    assert spark.read.parquet(f"{root}/out/scored").count() == lineitem.count()
    assert sorted(ST.read_scored(spark, f"{root}/out").collect()) == sorted(
        traffic_anomalies(V.network_traffic_from_lineitem(lineitem)).collect())


def unsorted_files(spark, df, root, parts=4):
    """Write ``df`` as files that are not in time order; a stream of one file a batch."""
    df.repartition(parts, F.hash(*df.columns)).write.parquet(root)
    return ST.read_stream(spark, root, schema=df.schema, max_files_per_trigger=1)


def traffic_rows(spark, n=600, seed=3):
    import random

    rng = random.Random(seed)
    base = dt.datetime(2024, 1, 1)
    rows = [
        (
            i - i % 2 * (i % 5 == 0), 0, rng.choice(["10.0.0.1", "10.0.0.2", None]), "10.0.0.9", "SSH", 22, rng.randint(1, 2000), False,
            None if rng.random() < 0.05 else base + dt.timedelta(seconds=rng.choice([0, 86400 * 20]) + rng.randint(0, 200) / 2),
        )
        for i in range(n)
    ]
    return spark.createDataFrame(
        rows,
        "traffic_id long, tie_key long, source_ip string, destination_ip string, protocol string, port int, packet_size int, "
        "is_suspicious boolean, timestamp timestamp_ntz",
    )


def by_id(df):
    return sorted(tuple((x is not None, x) for x in r) for r in df.collect())


def test_unsorted_traffic_keeps_and_scores_every_row(spark):
    """Late rows, rows of any period, null times and null sources included."""
    rows = traffic_rows(spark)
    for period in (7 * 86400, 20):
        root = scratch_path(spark, "test-stream-unsorted")
        stream = unsorted_files(spark, rows, f"{root}/src")
        ST.score_traffic_stream(stream, f"{root}/out", f"{root}/ckpt", trigger=ST.Trigger(available_now=True), period_s=period).awaitTermination()
        assert by_id(ST.read_scored(spark, f"{root}/out")) == by_id(traffic_anomalies(rows))
        metrics = spark.read.parquet(f"{root}/out/metrics").drop("batch_id")
        total = metrics.agg(F.sum("scored"), F.sum("late"), F.sum("corrections"), F.count("*")).first()
        assert total[0] == 600 and total[1] > 0 and total[2] > 0 and total[3] == 4
        late_nulls = spark.read.parquet(f"{root}/out/scored").filter("timestamp is null and late").count()
        assert late_nulls == 0


def test_unsorted_logins_keep_every_row(spark):
    events = V.table(spark, SMALL, "events")
    logins = V.login_attempts(spark, SMALL)
    once = ST.Trigger(available_now=True)
    root = scratch_path(spark, "test-stream-unsorted-logins")
    stream = lambda k: V.login_attempts_from_events(unsorted_files(spark, events, f"{root}/src{k}"))
    ST.failed_logins_stream(stream(0), f"{root}/a", f"{root}/ca", once).awaitTermination()
    assert by_id(ST.read_failed_logins(spark, f"{root}/a")) == by_id(failed_login_metrics(logins))
    ST.windowed_failed_logins_stream(stream(1), f"{root}/b", f"{root}/cb", 3600, once).awaitTermination()
    got = ST.read_windowed_failed_logins(spark, f"{root}/b")
    assert got.agg(F.sum("failed_attempt_count")).first()[0] == logins.filter(~F.col("success")).count()
    keys = ("username",)
    ST.brute_force_bursts_stream(stream(2), f"{root}/c", f"{root}/cc", keys, 86400, once).awaitTermination()
    want = brute_force_bursts(logins, keys, 86400, 3)
    assert by_id(ST.read_bursts(spark, f"{root}/c", keys, 86400, 3)) == by_id(want) and want.count() > 0


def test_bursts_with_a_null_key_agree(spark):
    base = dt.datetime(2024, 1, 1)
    rows = [(None, "10.0.0.1", False, base + dt.timedelta(seconds=10 * i)) for i in range(6)]
    rows += [("x", None, False, base + dt.timedelta(seconds=5 * i)) for i in range(5)]
    df = spark.createDataFrame(rows, "username string, ip_address string, success boolean, timestamp timestamp_ntz")
    batch = brute_force_bursts(df, max_gap_s=60, min_attempts=5)
    assert sorted(r["attempts"] for r in batch.collect()) == [5, 6]
    root = scratch_path(spark, "test-null-bursts")
    ST.brute_force_bursts_stream(unsorted_files(spark, df, f"{root}/src", 3), f"{root}/o", f"{root}/c", trigger=ST.Trigger(available_now=True)).awaitTermination()
    assert by_id(ST.read_bursts(spark, f"{root}/o")) == by_id(batch)


def test_latest_takes_the_newest_row_of_each_group(spark):
    root = scratch_path(spark, "test-latest")
    for batch_id, rows in enumerate(([("a", "x", 1), (None, "x", 2)], [("b", None, 5)], [("a", "x", 3), ("b", None, None)], [])):
        df = spark.createDataFrame(rows, "k string, j string, n int")
        for _ in range(1 + batch_id % 2):  # a retry replaces its own batch
            df.write.mode("overwrite").parquet(f"{root}/updates/batch_id={batch_id}")
    got = {tuple(r) for r in ST.latest(spark, root, ["k", "j"]).collect()}
    assert got == {("a", "x", 3), (None, "x", 2), ("b", None, None)}


def test_a_batch_reads_its_own_periods_only(spark, monkeypatch):
    """Batches in time order: what a batch reads does not grow with the number before it."""
    read = []
    earlier = ST._earlier

    def counting(spark, path, periods, batch_id, schema):
        found = earlier(spark, path, periods, batch_id, schema)
        read.append((len(periods), found.count()))
        return found

    monkeypatch.setattr(ST, "_earlier", counting)
    root = scratch_path(spark, "test-constant")
    base = dt.datetime(2024, 1, 1)
    columns = "traffic_id long, tie_key long, source_ip string, destination_ip string, protocol string, port int, packet_size int, is_suspicious boolean, timestamp timestamp_ntz"
    rows = []
    for batch_id in range(8):
        some = [(100 * batch_id + i, 0, "10.0.0.1", "10.0.0.9", "SSH", 22, 10, False, base + dt.timedelta(seconds=43200 * batch_id + i // 2)) for i in range(40)]
        rows += some
        ST.process_traffic_batch(spark.createDataFrame(some, columns), batch_id, root)
    assert all(periods == 1 and seen <= 20 for periods, seen in read)
    assert by_id(ST.read_scored(spark, root)) == by_id(traffic_anomalies(spark.createDataFrame(rows, columns)))


def test_a_batch_is_read_twice_and_sorted_once(spark):
    """Once for its periods, once for all that it writes."""
    rows = traffic_rows(spark).cache()
    seen = spark.sparkContext.accumulator(0)

    def passed(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    root = scratch_path(spark, "test-read-once")
    for batch_id in range(2):
        part = rows.filter(F.pmod("packet_size", F.lit(2)) == batch_id)
        seen.value = 0
        ST.process_traffic_batch(part.mapInArrow(passed, rows.schema), batch_id, root)
        assert 0 < seen.value <= 2 * part.count()
    assert by_id(ST.read_scored(spark, root)) == by_id(traffic_anomalies(rows))


def test_a_corrected_row_without_an_id_comes_once(spark):
    rows = traffic_rows(spark, 1).schema
    at = dt.datetime(2024, 1, 1)
    row = lambda i, ms: (None, None, "10.0.0.1", "10.0.0.9", "SSH", 22, i, False, at + dt.timedelta(milliseconds=ms))
    batches = [spark.createDataFrame(b, rows) for b in ([row(1, 500)], [row(2, 100), row(3, 700)])]
    root = scratch_path(spark, "test-null-id")
    for batch_id, batch in enumerate(batches):
        ST.process_traffic_batch(batch, batch_id, root)
    assert by_id(ST.read_scored(spark, root)) == by_id(traffic_anomalies(batches[0].union(batches[1])))


def test_processing_time_trigger_keeps_running(spark):
    """R4: the timer picks up files that come while the stream runs."""
    root = scratch_path(spark, "test-timer")
    orders = V.table(spark, SMALL, "orders").limit(300)
    first, second = orders.filter("o_orderkey % 2 = 0"), orders.filter("o_orderkey % 2 = 1")
    first.write.parquet(f"{root}/src")
    stream = ST.read_stream(spark, f"{root}/src", schema=orders.schema)
    alerts = V.security_alerts_from_orders(stream)
    q = ST.score_alerts_stream(alerts, f"{root}/out", f"{root}/ckpt", trigger=ST.Trigger("500 milliseconds"), only_unresolved=False)
    try:
        q.processAllAvailable()
        assert q.isActive and spark.read.parquet(f"{root}/out").count() == first.count()
        second.write.mode("append").parquet(f"{root}/src")
        q.processAllAvailable()
        assert q.isActive and spark.read.parquet(f"{root}/out").count() == orders.count()
    finally:
        q.stop()
    assert ST.Trigger().processing_time == "5 minutes"


def test_port_scan_stream_equals_batch(spark):
    root = scratch_path(spark, "test-stream-scans")
    lineitem = V.table(spark, SMALL, "lineitem")
    stream = V.network_traffic_from_lineitem(unsorted_files(spark, lineitem, f"{root}/src"))
    keys, window = ("source_ip",), 30 * 86400
    ST.port_scans_stream(stream, f"{root}/o", f"{root}/c", keys, window, ST.Trigger(available_now=True)).awaitTermination()
    want = port_scans(V.network_traffic(spark, SMALL), keys, "30 days", 3)
    assert by_id(ST.read_port_scans(spark, f"{root}/o", keys, window, 3)) == by_id(want) and want.count() > 0


def test_traffic_batch_retry_is_idempotent(spark):
    """Re-running a micro-batch (as after a lost executor) reproduces its outputs and
    still reads the state of the batch before it."""
    traffic = V.network_traffic(spark, SMALL)
    cut = traffic.agg(F.expr("percentile_approx(timestamp, 0.5)")).first()[0]
    first, second = traffic.filter(F.col("timestamp") <= cut), traffic.filter(F.col("timestamp") > cut)
    root = scratch_path(spark, "test-retry")
    ST.process_traffic_batch(first, 0, root)
    ST.process_traffic_batch(second, 1, root)
    files = lambda kind: sorted(map(str, spark.read.parquet(f"{root}/{kind}").filter("batch_id = 1").collect()))
    kinds = ("scored", "state", "corrections", "metrics")
    once = {k: files(k) for k in kinds}
    ST.process_traffic_batch(second, 1, root)  # the retry
    assert {k: files(k) for k in kinds} == once and once["state"] and once["scored"]
    ST.process_traffic_batch(second.filter(F.lit(False)), 2, root)  # an empty batch 2
    assert sorted(ST.read_scored(spark, root).collect()) == sorted(traffic_anomalies(traffic).collect())


def test_a_batch_reads_several_source_files(spark, monkeypatch):
    """The source files follow the rows, and the micro-batches stay four."""
    from threatlens.plans import registry as Q

    monkeypatch.setattr(Q, "STREAM_FILE_ROWS", 300)
    stream, out, _ = Q._stream(spark, "/root/testdata/sf0.001", "lineitem", "stream-files")
    source = spark.read.parquet(out.removesuffix("out") + "source")
    rows = source.count()
    each = -(-rows // (4 * 300))
    sizes = [r["count"] for r in source.groupBy(F.input_file_name()).count().collect()]
    assert each > 1 and len(sizes) == 4 * each and max(sizes) < 2 * 300
    assert stream.isStreaming
