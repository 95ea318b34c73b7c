"""Result snapshots (S10–S12): CSV folders partitioned by ``run_id``.

``<root>/<kind>/run_id=<YYYYmmdd_HHMMSS>/part-*.csv``.  The latest run is resolved
from the directory listing (metadata only) and read with a partition filter, so
only that run's files are opened.  One run id is used for all kinds, so a report
never mixes runs.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threatlens.functions.columns import unescape_text
from threatlens.schemas import RESULT_SCHEMAS

TS_FORMAT = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def run_ids(spark: SparkSession, root: str, kind: str) -> list[str]:
    p, fs = _fs(spark, f"{root.rstrip('/')}/{kind}")
    if not fs.exists(p):
        return []
    out = []
    for status in fs.listStatus(p):
        name = status.getPath().getName()
        if status.isDirectory() and name.startswith("run_id="):
            # a run is complete once its writer has committed (_SUCCESS marker)
            done = status.getPath().toString() + "/_SUCCESS"
            q, qfs = _fs(spark, done)
            if qfs.exists(q):
                out.append(name.split("=", 1)[1])
    return sorted(out)


def latest_run_id(spark: SparkSession, root: str, kinds: Iterable[str] = tuple(RESULT_SCHEMAS)) -> str | None:
    """Newest run id present (and committed) for every kind."""
    common = None
    for kind in kinds:
        ids = set(run_ids(spark, root, kind))
        common = ids if common is None else common & ids
    return max(common) if common else None


def csv_schema(schema: T.StructType) -> T.StructType:
    """CSV cannot hold maps: map columns travel as JSON text."""
    return T.StructType(
        [
            T.StructField(f.name, T.StringType(), True) if isinstance(f.dataType, T.MapType) else f
            for f in schema.fields
        ]
    )


def read_snapshot(
    spark: SparkSession, root: str, kind: str, run_id: str | None = None, fmt: str = "csv"
) -> DataFrame:
    """The rows of ``kind`` from ``run_id`` (default: the latest committed run of that
    kind; reports pass the latest run common to all kinds); a typed empty frame if
    there is none."""
    schema = RESULT_SCHEMAS[kind]
    run_id = run_id or latest_run_id(spark, root, [kind])
    if run_id is None:
        return spark.createDataFrame([], schema)
    if fmt == "parquet":
        typed = spark.read.schema(T.StructType(schema.fields + [T.StructField("run_id", T.StringType())]))
        df = typed.parquet(f"{root.rstrip('/')}/{kind}").filter(F.col("run_id") == run_id)
        return df.select(*schema.fieldNames())
    df = (
        spark.read.schema(csv_schema(schema).add("run_id", T.StringType()))
        .option("header", True)
        .option("mode", "FAILFAST")
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("timestampNTZFormat", TS_FORMAT)
        .csv(f"{root.rstrip('/')}/{kind}")
        .filter(F.col("run_id") == run_id)
    )
    for f in schema.fields:
        if isinstance(f.dataType, T.MapType):
            df = df.withColumn(f.name, F.from_json(unescape_text(F.col(f.name)), f.dataType))
        elif isinstance(f.dataType, T.StringType):
            df = df.withColumn(f.name, unescape_text(F.col(f.name)))
    return df.select(*schema.fieldNames())


def _dict_to_json():
    """Python dict text ({'k': 'v', 'n': None}) or JSON text as JSON; other text raises."""

    def convert(value):
        import ast
        import json

        if value is None:
            return None
        try:
            found = ast.literal_eval(value)
        except (ValueError, SyntaxError):
            found = json.loads(value)
        if not isinstance(found, dict):
            raise ValueError(f"not a map: {value[:80]!r}")
        return json.dumps({str(k): None if v is None else v if isinstance(v, str) else json.dumps(v, default=str) for k, v in found.items()})

    return F.udf(convert, "string")


def flat_snapshot_paths(spark: SparkSession, folder: str, kind: str) -> list[str]:
    """Files named ``<kind>_YYYYmmdd_HHMMSS.csv`` in ``folder``, oldest first."""
    p, fs = _fs(spark, folder.rstrip("/"))
    if not fs.exists(p):
        return []
    pattern = re.compile(rf"^{re.escape(kind)}_(\d{{8}}_\d{{6}})\.csv$")
    found = []
    for status in fs.listStatus(p):
        m = pattern.match(status.getPath().getName())
        if m and status.isFile():
            found.append((m.group(1), status.getPath().toString()))
    return [path for _, path in sorted(found)]


def read_flat_snapshot(spark: SparkSession, folder: str, kind: str) -> DataFrame:
    """The newest flat CSV snapshot of ``kind`` (one file per run, written through
    pandas): booleans as ``True``/``False`` and map columns as Python dict text are
    accepted.  Typed empty frame when there is none."""
    schema = RESULT_SCHEMAS[kind]
    paths = flat_snapshot_paths(spark, folder, kind)
    if not paths:
        return spark.createDataFrame([], schema)
    df = (
        spark.read.schema(csv_schema(schema))
        .option("header", True)
        .option("mode", "FAILFAST")
        .option("timestampNTZFormat", TS_FORMAT)
        .csv(paths[-1])
    )
    for f in schema.fields:
        if isinstance(f.dataType, T.MapType):
            df = df.withColumn(f.name, F.from_json(_dict_to_json()(F.col(f.name)), f.dataType))
    return df.select(*schema.fieldNames())
