"""Sinks (K1–K9): JDBC tables, document exports, CSV snapshots and write receipts.

All writers are distributed (each task writes its own partition); nothing is
collected to the driver.  Row counts come from an ``Observation`` filled in by the
write itself, sizes from the file-system listing.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threatlens.functions.columns import escape_text

SNAPSHOT_TS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
DOCUMENT_TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


@dataclass(frozen=True)
class Receipt:
    path: str
    rows: int
    columns: int
    bytes: int
    files: int


def jdbc_write_options(
    options: Mapping[str, str],
    table: str,
    truncate: bool = True,
    batchsize: int = 10000,
    create_table_options: str | None = None,
) -> dict[str, str]:
    """Writer options: ``truncate`` keeps the table definition on overwrite (keys,
    NOT NULL) instead of dropping it; ``create_table_options`` is passed to the
    database as is (e.g. ``ENGINE=InnoDB DEFAULT CHARSET=utf8mb4``).  Each task
    inserts its partition in one transaction, so a retried task does not duplicate
    rows where the database supports transactions."""
    opts = dict(options)
    opts.update(dbtable=table, batchsize=str(batchsize), truncate="true" if truncate else "false")
    if create_table_options:
        opts["createTableOptions"] = create_table_options
    return opts


def write_jdbc(
    df: DataFrame,
    options: Mapping[str, str],
    table: str,
    mode: str = "overwrite",
    truncate: bool = True,
    batchsize: int = 10000,
    num_partitions: int | None = None,
    create_table_options: str | None = None,
) -> None:
    """Write to a database table (``overwrite`` or ``append``); ``num_partitions``
    caps concurrent connections (coalesce, no shuffle)."""
    if num_partitions is not None:
        df = df.coalesce(num_partitions)
    opts = jdbc_write_options(options, table, truncate, batchsize, create_table_options)
    df.write.format("jdbc").options(**opts).mode(mode).save()


def _textual(df: DataFrame) -> DataFrame:
    """Maps and structs as JSON text (CSV holds only atomic values), text escaped so that
    spaces, quotes, line breaks and the empty text come back as they were."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.MapType, T.StructType, T.ArrayType)):
            cols.append(escape_text(F.to_json(F.col(f.name))).alias(f.name))
        elif isinstance(f.dataType, T.StringType):
            cols.append(escape_text(F.col(f.name)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def receipt(df_writer_path: str, spark, rows: int, columns: int) -> Receipt:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(df_writer_path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    size, files = 0, 0
    for status in fs.listStatus(p):
        name = status.getPath().getName()
        if status.isFile() and not name.startswith(("_", ".")):
            size += status.getLen()
            files += 1
    return Receipt(df_writer_path, rows, columns, size, files)


def _observed_write(df: DataFrame, path: str, write) -> Receipt:
    obs = Observation(f"rows_{abs(hash(path))}")
    write(df.observe(obs, F.count(F.lit(1)).alias("rows")))
    return receipt(path, df.sparkSession, int(obs.get["rows"]), len(df.columns))


def write_snapshot(
    df: DataFrame, root: str, kind: str, run_id: str, mode: str = "overwrite", fmt: str = "csv"
) -> Receipt:
    """One snapshot of ``kind`` for ``run_id``; re-running the same run id replaces it.

    ``csv`` (default, as the dashboards read): header, timestamps as text with
    microseconds, maps as JSON.  ``parquet``: typed and columnar, the better choice at
    scale (column pruning, no text encoding)."""
    if fmt not in ("csv", "parquet"):
        raise ValueError(f"unknown snapshot format {fmt!r}")
    path = f"{root.rstrip('/')}/{kind}/run_id={run_id}"

    def write(d: DataFrame) -> None:
        if fmt == "parquet":
            d.write.mode(mode).parquet(path)
            return
        (
            _textual(d)
            .write.mode(mode)
            .option("header", True)
            .option("escape", '"')
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
            .option("timestampNTZFormat", SNAPSHOT_TS_FORMAT)
            .option("timestampFormat", SNAPSHOT_TS_FORMAT)
            .csv(path)
        )

    return _observed_write(df, path, write)


def write_documents(df: DataFrame, path: str, mode: str = "overwrite") -> Receipt:
    """Replace (or append to) a document collection exported as JSON lines; the
    JSON writer handles timestamps and maps natively."""

    def write(d: DataFrame) -> None:
        (
            d.write.mode(mode)
            .option("timestampNTZFormat", DOCUMENT_TS_FORMAT)
            .option("timestampFormat", DOCUMENT_TS_FORMAT)
            .json(path)
        )

    return _observed_write(df, path, write)


def write_collection(df: DataFrame, uri: str, database: str, collection: str, mode: str = "overwrite") -> None:
    """Write through the MongoDB Spark connector (its jar must be installed)."""
    (
        df.write.format("mongodb")
        .option("connection.uri", uri)
        .option("database", database)
        .option("collection", collection)
        .mode(mode)
        .save()
    )
