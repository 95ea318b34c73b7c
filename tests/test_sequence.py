"""Property tests: the skew-safe plans equal the plain per-key Window versions,
whatever the key distribution (one hot key included) and partition count."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from conftest import BASE, at
from threatlens.config import TrafficRules
from threatlens.functions.sequence import with_previous, with_sequence
from threatlens.operators.traffic import TRAFFIC_ORDER, rapid_connections
from threatlens.schemas import NETWORK_TRAFFIC

rows_strategy = st.lists(
    st.tuples(
        st.sampled_from(["hot", "hot", "hot", "a", "b", None]),
        st.one_of(st.none(), st.floats(min_value=0, max_value=30).map(lambda x: round(x, 2))),
        st.integers(min_value=-3, max_value=3),
    ),
    min_size=1,
    max_size=60,
)

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


def frame(spark, rows):
    data = [
        (i, key, "d", "TCP", 80, 100, None if off is None else at(off), False, i * 7 % 5)
        for i, (key, off, _v) in enumerate(rows)
    ]
    df = spark.createDataFrame(data, NETWORK_TRAFFIC)
    vals = spark.createDataFrame([(i, v) for i, (_, _, v) in enumerate(rows)], "traffic_id long, v int")
    return df.join(vals, "traffic_id")


@SETTINGS
@given(rows=rows_strategy, parts=st.integers(min_value=1, max_value=7))
def test_sequence_equals_row_number(spark, rows, parts):
    df = frame(spark, rows)
    w = Window.partitionBy("source_ip").orderBy(*TRAFFIC_ORDER)
    expect = df.select(
        "traffic_id",
        F.row_number().over(w).alias("seq"),
        F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("run"),
    )
    got = with_sequence(df, ["source_ip"], list(TRAFFIC_ORDER), {"run": F.col("v")}, num_partitions=parts)
    assert sorted(got.select("traffic_id", "seq", "run").collect()) == sorted(expect.collect())


@SETTINGS
@given(rows=rows_strategy, parts=st.integers(min_value=1, max_value=7))
def test_previous_equals_lag(spark, rows, parts):
    df = frame(spark, rows)
    w = Window.partitionBy("source_ip").orderBy(*TRAFFIC_ORDER)
    expect = df.select("traffic_id", F.lag("timestamp").over(w).alias("prev"))
    got = with_previous(df, ["source_ip"], list(TRAFFIC_ORDER), "timestamp", "prev", num_partitions=parts)
    assert sorted(got.select("traffic_id", "prev").collect()) == sorted(expect.collect())


@SETTINGS
@given(rows=rows_strategy)
def test_rapid_equals_lag_definition(spark, rows):
    df = frame(spark, rows)
    w = Window.partitionBy("source_ip").orderBy(*TRAFFIC_ORDER)
    prev = F.lag("timestamp").over(w)
    gap = F.unix_timestamp("timestamp") - F.unix_timestamp(prev)
    expect = df.select("traffic_id", F.coalesce(gap < 1, F.lit(False)).alias("rapid"))
    got = rapid_connections(df).select("traffic_id", F.col("rapid_connection").alias("rapid"))
    assert sorted(got.collect()) == sorted(expect.collect())


def test_sequence_spreads_a_hot_key(spark):
    """One key with most rows is split over several range partitions."""
    n = 4000
    df = spark.range(n).select(
        F.when(F.col("id") % 10 < 8, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 7).cast("string"))).alias("k"),
        F.col("id"),
    )
    out = with_sequence(df, ["k"], ["id"], num_partitions=8)
    hot = out.filter(F.col("k") == "hot")
    assert hot.agg(F.min("seq"), F.max("seq"), F.count("*")).first() == (1, 3200, 3200)
    # the range-partitioned, checkpointed input spreads the hot key over >1 partition
    spread = (
        df.repartitionByRange(8, "k", "id").withColumn("p", F.spark_partition_id())
        .filter(F.col("k") == "hot").select("p").distinct().count()
    )
    assert spread > 1


def _traffic(spark, rows):
    """(id, source, seconds or None) rows."""
    return spark.createDataFrame(
        [(i, ip, None if t is None else BASE + dt.timedelta(seconds=t)) for i, ip, t in rows],
        "traffic_id long, source_ip string, timestamp timestamp_ntz",
    )


def _rapid(df, rules=TrafficRules()):
    return {r["traffic_id"]: r["rapid_connection"] for r in rapid_connections(df, rules).collect()}


def test_rapid_gap_of_other_lengths(spark):
    rows = [(1, "a", 0), (2, "a", 3), (3, "a", 8), (4, "b", 8), (5, None, 0), (6, None, 4), (7, "a", None), (8, "a", None)]
    df = _traffic(spark, rows)
    assert _rapid(df, TrafficRules(rapid_gap_s=5)) == {1: False, 2: True, 3: False, 4: False, 5: False, 6: True, 7: False, 8: False}
    assert _rapid(df, TrafficRules(rapid_gap_s=6))[3]
    assert not any(_rapid(df).values())


def test_rapid_window_equals_the_lag(spark):
    import random

    rng = random.Random(4)
    rows = [(i, rng.choice(["a", "b", None]), rng.choice([None, *[x / 4 for x in range(80)]])) for i in range(400)]
    want, last = {}, {}
    for i, ip, t in sorted(rows, key=lambda r: (r[2] is not None, r[2] or 0, r[0])):
        want[i] = t is not None and last.get(ip) is not None and int(t) - int(last[ip]) < 1
        last[ip] = t
    assert _rapid(_traffic(spark, rows)) == want


def test_scoring_runs_no_job_when_it_is_built(spark):
    from threatlens.operators.traffic import traffic_anomalies
    from threatlens.sources import views as V

    traffic = V.network_traffic(spark, "/root/testdata/sf0.001")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("build", "build")
    plan = traffic_anomalies(traffic)._jdf.queryExecution().executedPlan().toString()
    assert not tracker.getJobIdsForGroup("build")
    spark.sparkContext.setJobGroup("tests", "tests")
    assert plan.count("Exchange hashpartitioning") == 1


def _chains(rows):
    """Run-length-coded values per key, by plain Python."""
    out = {}
    for key in {r[0] for r in rows}:
        runs = []
        for _, _, v in sorted((r for r in rows if r[0] == key), key=lambda r: r[1]):
            v = "null" if v is None else v
            if runs and runs[-1][0] == v:
                runs[-1][1] += 1
            else:
                runs.append([v, 1])
        total = sum(n for _, n in runs)
        out[key] = (total, len(runs), " > ".join(v + (f" x{n}" if n > 1 else "") for v, n in runs))
    return out


def test_ordered_runs_join_across_partitions(spark):
    """Runs that cross any number of partition bounds, single rows, null values and null keys."""
    import random

    from threatlens.functions.sequence import ordered_runs

    rng = random.Random(6)
    rows = [("hot", i, rng.choice("aab")) for i in range(900)] + [("same", i, "z") for i in range(500)]
    rows += [(f"k{i % 7}", i, rng.choice(["x", "y", None])) for i in range(60)] + [("one", 1, "q"), (None, 2, "n"), (None, 3, "n")]
    df = spark.createDataFrame(rows, "k string, at long, v string").repartition(5)
    for parts in (1, 4, 37):
        got = ordered_runs(df, ["k"], ["at"], "v", num_partitions=parts)
        assert {r["k"]: (r["rows"], r["runs"], r["chain"]) for r in got.collect()} == _chains(rows)
    assert ordered_runs(df.filter("false"), ["k"], ["at"], "v").collect() == []
