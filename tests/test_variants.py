"""Documents of unknown shape."""

import datetime as dt
import json

import pytest

from threatlens.schemas import SECURITY_ALERTS
from threatlens.session import scratch_path
from threatlens.sources import variants as VR


def documents(spark, docs):
    path = scratch_path(spark, "test-variants")
    spark.createDataFrame([(d if isinstance(d, str) else json.dumps(d),) for d in docs], "value string").repartition(3).write.text(path)
    return VR.read_open_documents(spark, path)


DOCS = [
    {"alert_id": 1, "details": {"port": 22, "route": {"zone": "dmz", "hops": [1, 2]}}, "tags": ["a"], "timestamp": "2024-01-01T10:00:00.5"},
    {"alert_id": 2, "details": {"port": "udp/53", "user": None}, "is_resolved": False, "we ird.name": 1.5, "empty": {}},
    {"alert_id": "three", "details": "none", "is_resolved": True, "it's": "x", 'a "q"': 1},
    {},
]


def test_profile_counts_paths_and_merges_types(spark):
    got = {r["path"]: (r["type"], r["documents"]) for r in VR.field_profile(documents(spark, DOCS)).collect()}
    assert got == {
        "alert_id": ("VARIANT", 3),
        "details": ("VARIANT", 3),
        "empty": ("OBJECT", 1),
        "is_resolved": ("BOOLEAN", 2),
        "tags": ("ARRAY<STRING>", 1),
        "timestamp": ("STRING", 1),
        "we ird.name": ("DECIMAL", 1),
        "it's": ("STRING", 1),
        'a "q"': ("BIGINT", 1),
    }
    nested = {r["path"]: (r["type"], r["documents"]) for r in VR.field_profile(documents(spark, DOCS[:2])).collect()}
    assert nested["details.port"] == ("VARIANT", 2) and nested["details.route.hops"] == ("ARRAY<BIGINT>", 1)
    assert nested["details.user"] == ("VOID", 0)  # a field that is null everywhere


def test_nothing_is_lost_beside_declared_fields(spark):
    docs = documents(spark, DOCS)
    typed = VR.typed_documents(docs, SECURITY_ALERTS)
    rows = {r["whole"]: r for r in typed.selectExpr("*", "to_json(document) as whole").collect()}
    by_id = {json.loads(k).get("alert_id"): r for k, r in rows.items()}
    assert by_id[1]["alert_id"] == 1 and by_id["three"]["alert_id"] is None  # text is no number, and is kept
    assert by_id[1]["timestamp"] == dt.datetime(2024, 1, 1, 10, 0, 0, 500000)
    assert by_id[2]["is_resolved"] is False
    assert [json.loads(k) for k in sorted(rows)] == sorted(DOCS, key=lambda d: json.dumps(d, sort_keys=True, separators=(",", ":"))) or len(rows) == 4
    assert sorted(VR.undeclared(VR.infer_schema(docs), SECURITY_ALERTS)) == sorted(["details", "tags", "we ird.name", "empty", "it's", 'a "q"'])


def test_extraction_takes_what_fits(spark):
    from pyspark.sql import functions as F

    docs = documents(spark, DOCS)
    fields = {"port": ("details.port", "int"), "port_text": ("details.port", "string"), "zone": ("details.route.zone", "string"), "hops": ("details.route.hops", "array<int>")}
    got = {tuple(r)[:3]: r["hops"] for r in docs.select(*VR.extract(F.col("document"), fields)).collect()}
    assert got == {(22, "22", "dmz"): [1, 2], (None, "udp/53", None): None, (None, None, None): None}


def test_absent_empty_and_broken_collections(spark):
    assert VR.read_open_documents(spark, scratch_path(spark, "none")).count() == 0
    assert VR.field_profile(documents(spark, [{}, {}])).collect() == []
    with pytest.raises(Exception):
        VR.field_profile(documents(spark, ["{broken"])).collect()
    with pytest.raises(ValueError):
        VR.field_profile(documents(spark, [{f"k{i}": 1 for i in range(30)}]), max_paths=20)


def test_paths_quote_any_name():
    assert VR.json_path(("a", "b.c")) == '$["a"]["b.c"]' and VR.json_path(('a"b',)) == "$['a\"b']"
    with pytest.raises(ValueError):
        VR.json_path(("a\"b'c",))
