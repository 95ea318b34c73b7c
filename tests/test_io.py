"""Sources and sinks: options, snapshot / document round trips, receipts."""

import pytest
from pyspark.sql import functions as F

from conftest import at, collect
from threatlens.operators.logins import failed_login_metrics
from threatlens.schemas import ENRICHED_ALERTS, SECURITY_ALERTS
from threatlens.session import scratch_path
from threatlens.sinks.writers import write_documents, write_snapshot
from threatlens.sources import documents as D
from threatlens.sources import jdbc as J
from threatlens.sources import snapshots as S
from threatlens.sources import views as V
from threatlens.operators.alerts import prioritize_alerts

SMALL = "/root/testdata/sf0.001"


def test_jdbc_options():
    env = {"MYSQL_HOST": "db", "MYSQL_USER": "u", "MYSQL_PASSWORD": "p", "MYSQL_DB": "sec"}
    o = J.jdbc_options("mysql", env)
    assert o["url"] == "jdbc:mysql://db:3306/sec" and o["useSSL"] == "false"
    assert J.jdbc_options("postgres", {**{k.replace("MYSQL", "POSTGRES"): v for k, v in env.items()},
                                        "POSTGRES_PORT": "6543"})["url"] == "jdbc:postgresql://db:6543/sec"
    with pytest.raises(ValueError, match="MYSQL_HOST, MYSQL_PASSWORD"):
        J.jdbc_options("mysql", {"MYSQL_USER": "u", "MYSQL_DB": "d"})
    q = J.read_options(o, query="SELECT 1", partitioning=J.Partitioning("attempt_id", 1, 1000, 8))
    assert q["dbtable"] == "(SELECT 1) AS query_result" and q["numPartitions"] == "8"
    with pytest.raises(ValueError):
        J.read_options(o)


def alerts(spark):
    rows = [(i, "Ransomware", ["HIGH", "LOW", None][i % 3], at(i * 0.25), "IDS-1", "d, \"q\"", "S-1",
             i % 2 == 0, {"incident_id": f"INC-{i % 4}", "ip_address": "10.0.0.1"} if i % 5 else None)
            for i in range(40)]
    return spark.createDataFrame(rows, SECURITY_ALERTS)


def test_snapshot_roundtrip_and_latest(spark):
    root = scratch_path(spark, "test-snap")
    enriched = prioritize_alerts(alerts(spark))
    r1 = write_snapshot(enriched.filter("alert_id < 10"), root, "enriched_alerts", "20240101_000000")
    r2 = write_snapshot(enriched, root, "enriched_alerts", "20240102_000000")
    assert (r1.rows, r2.rows, r2.columns) == (10, 40, len(ENRICHED_ALERTS.fields)) and r2.bytes > 0 and r2.files >= 1
    back = S.read_snapshot(spark, root, "enriched_alerts")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, enriched.collect()))
    assert S.read_snapshot(spark, root, "enriched_alerts", "20240101_000000").count() == 10
    assert S.latest_run_id(spark, root) is None  # other kinds missing: no common run
    assert S.read_snapshot(spark, root, "failed_logins").count() == 0


def test_documents_roundtrip(spark):
    path = scratch_path(spark, "test-docs")
    src = alerts(spark)
    write_documents(src, path)
    back = D.read_documents(spark, path, query={"is_resolved": False})
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, src.filter(~F.col("is_resolved")).collect()))
    assert D.read_documents(spark, path + "-missing").count() == 0


def test_object_ids_normalized(spark):
    df = spark.createDataFrame([({"$oid": "abc"}, 1)], "_id struct<`$oid`: string>, n int")
    assert collect(D.normalize_documents(df)) == [{"_id": "abc", "n": 1}]


def test_jdbc_write_options():
    from threatlens.sinks.writers import jdbc_write_options

    base = {"url": "jdbc:mysql://db:3306/sec", "user": "u", "password": "p"}
    o = jdbc_write_options(base, "failed_login_metrics", create_table_options="ENGINE=InnoDB DEFAULT CHARSET=utf8mb4")
    assert o["dbtable"] == "failed_login_metrics" and o["truncate"] == "true"
    assert o["createTableOptions"] == "ENGINE=InnoDB DEFAULT CHARSET=utf8mb4" and o["url"] == base["url"]
    assert jdbc_write_options(base, "t", truncate=False)["truncate"] == "false"


def test_extended_json_documents(spark):
    """An export with {"$oid"} ids and {"$date"} dates (ISO with Z, with an offset, and
    epoch millis) reads back to the same typed rows as the plain export."""
    import datetime as dt

    from threatlens.schemas import SECURITY_ALERTS
    from threatlens.sources import views as V

    alerts = V.security_alerts(spark, "/root/testdata/sf0.001")
    path = scratch_path(spark, "test-extended-json")
    iso = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSS")
    shifted = F.date_format(F.col("timestamp") + F.expr("INTERVAL 2 HOURS"), "yyyy-MM-dd'T'HH:mm:ss.SSS")
    millis = (F.unix_micros(F.col("timestamp").cast("timestamp")) / 1000).cast("long")
    date = (
        F.when(F.col("alert_id") % 3 == 0, F.to_json(F.struct(F.concat(iso, F.lit("Z")).alias("$date"))))
        .when(F.col("alert_id") % 3 == 1, F.to_json(F.struct(F.concat(shifted, F.lit("+02:00")).alias("$date"))))
        .otherwise(F.to_json(F.struct(F.struct(millis.cast("string").alias("$numberLong")).alias("$date"))))
    )
    docs = alerts.select(
        F.to_json(F.struct(F.struct(F.col("alert_id").cast("string").alias("$oid")).alias("_id"),
                           *[c for c in alerts.columns if c != "timestamp"],
                           F.lit("__DATE__").alias("timestamp"))).alias("j"),
        date.alias("d"),
    ).select(F.expr("replace(j, '\"__DATE__\"', d)").alias("value"))
    docs.write.mode("overwrite").text(path)
    from pyspark.sql import types as T

    schema = T.StructType(SECURITY_ALERTS.fields + [T.StructField("_id", T.StringType())])
    back = D.read_documents(spark, path, schema=schema, query={"is_resolved": False}, extended_json=True)
    expect = alerts.filter(~F.col("is_resolved")).withColumn("_id", F.col("alert_id").cast("string"))
    assert sorted(map(tuple, back.select(*expect.columns).collect())) == sorted(map(tuple, expect.collect()))
    assert isinstance(back.first()["timestamp"], dt.datetime)


def test_flat_snapshots_written_through_pandas(spark):
    """<kind>_YYYYmmdd_HHMMSS.csv files as a pandas writer leaves them: True/False,
    dicts as Python text, timestamps with or without fractions; the newest wins."""
    import os

    folder = scratch_path(spark, "test-flat")
    os.makedirs(folder.replace("file:", ""), exist_ok=True)
    header = ("alert_id,alert_type,severity,timestamp,source,description,affected_system,is_resolved,"
              "detection_details,severity_score,priority,action_required\n")
    old = header + "1,Ransomware,LOW,2024-01-01 00:00:00,IDS-1,d,S-1,False,,20,MEDIUM,False\n"
    new = header + ("2,Brute Force,HIGH,2024-01-02 03:04:05.250000,IDS-2,\"d, x\",S-2,False,"
                    "\"{'ip_address': '10.0.0.1', 'incident_id': 'INC-7'}\",100,CRITICAL,True\n")
    base = folder.replace("file:", "")
    for name, text in [("enriched_alerts_20240101_000000.csv", old), ("enriched_alerts_20240102_000000.csv", new)]:
        with open(os.path.join(base, name), "w") as fh:
            fh.write(text)
    rows = collect(S.read_flat_snapshot(spark, folder, "enriched_alerts"))
    assert len(rows) == 1 and rows[0]["alert_id"] == 2 and rows[0]["action_required"] is True
    assert rows[0]["detection_details"] == {"ip_address": "10.0.0.1", "incident_id": "INC-7"}
    assert rows[0]["timestamp"].microsecond == 250000 and rows[0]["description"] == "d, x"
    assert S.read_flat_snapshot(spark, folder, "failed_logins").count() == 0


def test_conform_to_schema(spark):
    import datetime as dt

    from threatlens.schemas import LOGIN_ATTEMPTS, conform

    raw = spark.createDataFrame(
        [(7, "admin", dt.datetime(2024, 1, 1, 12, 0), "10.0.0.1", True)],
        "ATTEMPT_ID int, username string, timestamp timestamp, ip_address string, success boolean",
    )
    df = conform(raw, LOGIN_ATTEMPTS)
    assert df.dtypes == [("attempt_id", "bigint"), ("username", "string"), ("timestamp", "timestamp_ntz"),
                         ("ip_address", "string"), ("success", "boolean"), ("user_agent", "string"),
                         ("location", "string")]
    assert df.first()["timestamp"] == dt.datetime(2024, 1, 1, 12, 0)
    with pytest.raises(ValueError, match="attempt_id"):
        conform(raw.drop("ATTEMPT_ID"), LOGIN_ATTEMPTS)


def test_csv_snapshot_keeps_any_text(spark):
    from threatlens.schemas import ENRICHED_ALERTS, FAILED_LOGIN_METRICS

    root = scratch_path(spark, "test-any-text")
    odd = [" bob ", "", None, "a\nb", "c\r\nd", 'q"uo"te', '"', "back\\slash", "\\n", "\\\\", "\\e", "x\0y", ",", "'", "\\", "é😀", '\\"', "\ttab\t"]
    text = next(f.name for f in FAILED_LOGIN_METRICS.fields if f.name == "username")
    base = V.login_attempts(spark, SMALL)
    rows = failed_login_metrics(base).limit(1).drop(text).crossJoin(spark.createDataFrame([(x,) for x in odd], f"{text} string"))
    rows = rows.select(*FAILED_LOGIN_METRICS.fieldNames())
    write_snapshot(rows, root, "failed_logins", "20240101_000000")
    got = S.read_snapshot(spark, root, "failed_logins")
    assert sorted((r[text] is None, r[text] or "") for r in got.collect()) == sorted((x is None, x or "") for x in odd)
    assert got.drop(text).distinct().collect() == rows.drop(text).distinct().collect()
    names = ENRICHED_ALERTS.fieldNames()
    assert "detection_details" in names
    alerts = prioritize_alerts(V.security_alerts(spark, SMALL)).limit(1).select(*names)
    maps = alerts.withColumn("detection_details", F.create_map(F.lit("k\n"), F.lit('v"\\ ')))
    write_snapshot(maps, root, "enriched_alerts", "20240101_000000")
    assert S.read_snapshot(spark, root, "enriched_alerts").first()["detection_details"] == {"k\n": 'v"\\ '}


def test_flat_map_text(spark):
    convert = S._dict_to_json()
    texts = ["{'ip_address': '1.2.3.4', 'username': None}", '{\'username\': "O\'Brien", \'ok\': True, \'n\': 3}', '{"a": null}', None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(F.from_json(convert("t"), "map<string,string>").alias("m"))
    assert [r["m"] for r in df.collect()] == [
        {"ip_address": "1.2.3.4", "username": None}, {"username": "O'Brien", "ok": "true", "n": "3"}, {"a": None}, None
    ]
    import pytest

    with pytest.raises(Exception):
        spark.createDataFrame([("not a map",)], "t string").select(convert("t")).collect()


def test_dates_before_1970(spark):
    from threatlens.sources.documents import extended_timestamp

    df = spark.createDataFrame([('{"$date": {"$numberLong": "-1000"}}',), ('{"$date": "1969-12-31T23:59:59Z"}',)], "t string")
    out = df.select(extended_timestamp(F.col("t"), __import__("pyspark.sql.types", fromlist=["T"]).TimestampNTZType(), "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]").alias("x"))
    assert len({r["x"] for r in out.collect()}) == 1
