"""Documents of unknown shape (S8/S5): JSON lines read as one VARIANT column.

A document collection has no fixed schema: fields come and go, and a field may hold a
number in one document and text in the next.  ``read_documents`` keeps the declared
fields only; here a document is read whole, as the binary VARIANT value, and

* ``infer_schema`` merges the types of all documents in one distributed aggregate,
* ``field_profile`` counts, in a second one, the documents that hold each path,
* ``typed_documents`` extracts declared fields and leaves the document beside them, so
  that nothing is lost: values that do not fit a declared type are null there and still
  in the document.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threatlens.sources.documents import _exists

DOCUMENT = "document"


def read_open_documents(spark: SparkSession, path: str) -> DataFrame:
    """One VARIANT column ``document``; broken JSON raises, a missing path is an empty frame."""
    if not _exists(spark, path):
        return spark.createDataFrame([], f"{DOCUMENT} variant")
    return spark.read.option("singleVariantColumn", DOCUMENT).option("mode", "FAILFAST").json(path)


def infer_schema(docs: DataFrame, column: str = DOCUMENT) -> T.DataType:
    """The merged type of all documents: objects become structs, and a path with values of
    types that have no common one is a variant."""
    text = docs.agg(F.schema_of_variant_agg(column).alias("type")).first()["type"]
    return T.DataType.fromDDL(re.sub(r"(?<![`\w])OBJECT<", "STRUCT<", text))


def type_name(kind: T.DataType) -> str:
    """OBJECT for structs, otherwise the SQL name without parameters."""
    if isinstance(kind, T.StructType):
        return "OBJECT"
    if isinstance(kind, T.ArrayType):
        return f"ARRAY<{type_name(kind.elementType)}>"
    return kind.simpleString().upper().split("(")[0]


def field_paths(kind: T.DataType, parents: tuple[str, ...] = ()) -> Iterator[tuple[tuple[str, ...], str]]:
    """(path, type) of each field, the objects' own fields after them.  The elements of an array are part
    of its type."""
    if isinstance(kind, T.StructType):
        for f in kind.fields:
            yield (*parents, f.name), type_name(f.dataType)
            yield from field_paths(f.dataType, (*parents, f.name))


def json_path(names: tuple[str, ...]) -> str:
    """The extraction path of nested field names, whatever characters they hold."""
    steps = []
    for n in names:
        if '"' in n and "'" in n:
            raise ValueError(f"a field name with both kinds of quotes: {n!r}")
        steps.append(f"['{n}']" if '"' in n else f'["{n}"]')
    return "$" + "".join(steps)


def holds(document: Column, names: tuple[str, ...]) -> Column:
    """Whether the document has a value at the path; a JSON null is none."""
    value = F.try_variant_get(document, json_path(names), "variant")
    return value.isNotNull() & ~F.coalesce(F.is_variant_null(value), F.lit(False))


def field_profile(docs: DataFrame, column: str = DOCUMENT, max_paths: int = 5000) -> DataFrame:
    """(path, type, documents): each path of the collection, its merged type and the number
    of documents with a value there.

    Two scans, each one aggregate that is partial in every task.  The paths are a fact of
    the collection's shape; a collection that uses data as field names has too many, which
    raises, and needs ``typed_documents`` with a map type instead."""
    paths = list(field_paths(infer_schema(docs, column)))
    spark = docs.sparkSession
    if len(paths) > max_paths:
        raise ValueError(f"{len(paths)} paths are more than {max_paths}: read keyed objects as maps")
    if not paths:
        return spark.createDataFrame([], "path string, type string, documents long")
    counts = docs.agg(*[F.count_if(holds(F.col(column), names)).alias(f"n{i}") for i, (names, _) in enumerate(paths)])
    rows = [
        F.struct(F.lit(".".join(names)).alias("path"), F.lit(kind).alias("type"), F.col(f"n{i}").alias("documents"))
        for i, (names, kind) in enumerate(paths)
    ]
    return counts.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def extract(document: Column, fields: Mapping[str, tuple[str, str]]) -> list[Column]:
    """Columns ``name -> (path of names joined by dots, type)``; what does not fit the type is null."""
    return [F.try_variant_get(document, json_path(tuple(path.split("."))), kind).alias(name) for name, (path, kind) in fields.items()]


def typed_documents(docs: DataFrame, schema: T.StructType, column: str = DOCUMENT) -> DataFrame:
    """The schema's fields, typed, and the whole document in ``column``."""
    typed = []
    for f in schema.fields:
        path = json_path((f.name,))
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            text = F.try_variant_get(F.col(column), path, "string")
            typed.append(text.try_cast(f.dataType).alias(f.name))
        else:
            typed.append(F.try_variant_get(F.col(column), path, f.dataType.simpleString()).alias(f.name))
    return docs.select(*typed, column)


def undeclared(kind: T.DataType, schema: T.StructType) -> list[str]:
    """Top-level fields of the collection that the schema does not declare."""
    return [f.name for f in kind.fields if f.name not in schema.fieldNames()] if isinstance(kind, T.StructType) else []
