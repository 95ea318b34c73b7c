"""Document sources (S5–S8, S13): alert documents as JSON lines with a fixed schema.

Exported document collections are read in parallel by Spark (one task per file
split), with the equality filter of a document query applied as a DataFrame
filter — never through a driver-side list.  ``format("mongodb")`` can replace the
JSON reader when its connector jar is installed (``read_collection``).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threatlens.schemas import SECURITY_ALERTS


def equality_filter(df: DataFrame, query: Mapping[str, object] | None) -> DataFrame:
    """``{"is_resolved": False}``-style document query as a pushed-down filter."""
    for column, value in (query or {}).items():
        df = df.filter(F.col(column).isNull() if value is None else F.col(column) == F.lit(value))
    return df


def normalize_documents(df: DataFrame) -> DataFrame:
    """Object ids become strings (``{"$oid": ...}`` structs are unwrapped); all other
    columns keep their declared types (timestamps stay timestamps)."""
    if "_id" not in df.columns:
        return df
    field = df.schema["_id"]
    if isinstance(field.dataType, T.StructType) and "$oid" in field.dataType.fieldNames():
        return df.withColumn("_id", F.col("_id").getField("$oid"))
    if isinstance(field.dataType, T.StringType):
        # an extended-JSON id read as text: {"$oid": "..."}
        return df.withColumn("_id", F.coalesce(F.get_json_object(F.col("_id"), "$['$oid']"), F.col("_id")))
    return df.withColumn("_id", F.col("_id").cast("string"))


def read_documents(
    spark: SparkSession,
    path: str,
    schema: T.StructType = SECURITY_ALERTS,
    query: Mapping[str, object] | None = None,
    timestamp_format: str = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]",
    extended_json: bool = False,
) -> DataFrame:
    """JSON-lines documents with an explicit schema; a missing path gives a typed
    empty frame (absent data), any other error is raised.

    ``extended_json`` accepts collection exports that wrap dates as ``{"$date": ...}``
    (ISO text, with or without a zone suffix, or epoch milliseconds) and ids as
    ``{"$oid": ...}``: those fields are read as text and normalized to the declared
    types, so plain and extended exports give the same rows.  Use it as well for plain
    ISO dates that carry a zone suffix (``...Z``, ``...+02:00``), which the strict reader
    rejects."""
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    if not extended_json:
        reader = (
            spark.read.schema(schema)
            .option("mode", "FAILFAST")
            .option("timestampNTZFormat", timestamp_format)
            .option("timestampFormat", timestamp_format)
        )
        return normalize_documents(equality_filter(reader.json(path), query))
    stamps = [f.name for f in schema.fields if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))]
    loose = T.StructType(
        [T.StructField(f.name, T.StringType()) if f.name in stamps else f for f in schema.fields]
    )
    raw = spark.read.schema(loose).option("mode", "FAILFAST").json(path)
    df = raw.withColumns(
        {c: extended_timestamp(F.col(c), schema[c].dataType, timestamp_format) for c in stamps}
    )
    return normalize_documents(equality_filter(df, query))


_ZONE = r"(Z|[+-]\d{2}:?\d{2})$"
_OFFSET = r"([+-])(\d{2}):?(\d{2})$"


def extended_timestamp(text: F.Column, to: T.DataType, fmt: str) -> F.Column:
    """A date given as plain ISO text or as extended JSON ``{"$date": ISO | millis |
    {"$numberLong": millis}}``, as UTC wall-clock time of type ``to``.  A zone
    offset in the text is applied; nothing depends on the session time zone."""
    inner = F.coalesce(F.get_json_object(text, "$['$date']"), text)
    millis = F.coalesce(F.get_json_object(inner, "$['$numberLong']"), inner).try_cast("long")
    wall = F.coalesce(
        F.to_timestamp_ntz(F.regexp_replace(inner, _ZONE, ""), F.lit(fmt)),
        F.to_timestamp_ntz(F.regexp_replace(inner, _ZONE, ""), F.lit("yyyy-MM-dd'T'HH:mm:ss[.SSS]")),
    )
    sign = F.when(F.regexp_extract(inner, _OFFSET, 1) == "-", -1).otherwise(1)
    offset_min = F.coalesce(
        sign
        * (
            F.regexp_extract(inner, _OFFSET, 2).try_cast("int") * 60
            + F.regexp_extract(inner, _OFFSET, 3).try_cast("int")
        ),
        F.lit(0),
    )
    utc = F.timestamp_add("MINUTE", -offset_min, wall)
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    from_millis = F.timestamp_add("MILLISECOND", millis, epoch)
    value = F.when(millis.isNotNull(), from_millis).otherwise(utc)
    return value.cast(to)


def read_collection(
    spark: SparkSession,
    uri: str,
    database: str,
    collection: str,
    schema: T.StructType = SECURITY_ALERTS,
    query: Mapping[str, object] | None = None,
) -> DataFrame:
    """Read through the MongoDB Spark connector (its jar must be installed)."""
    df = (
        spark.read.format("mongodb")
        .schema(schema)
        .option("connection.uri", uri)
        .option("database", database)
        .option("collection", collection)
        .load()
    )
    return normalize_documents(equality_filter(df, query))


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))
