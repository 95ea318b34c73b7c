"""JDBC sources (S1–S4, S14): options from the environment and parallel reads.

A database driver jar must be on the classpath (``spark.jars.packages``); none is in
this container, so these functions are tested for the options they build, not
against a live database.
"""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

# Per database kind, the URL scheme, default port and driver class.
DATABASES = {
    "mysql": ("jdbc:mysql", "3306", "com.mysql.cj.jdbc.Driver", {"useSSL": "false"}),
    "postgres": ("jdbc:postgresql", "5432", "org.postgresql.Driver", {}),
}

ENV_PREFIX = {"mysql": "MYSQL", "postgres": "POSTGRES"}


def jdbc_options(kind: str, env: Mapping[str, str] | None = None) -> dict[str, str]:
    """URL and connection options for ``kind`` from ``<PREFIX>_HOST/PORT/USER/PASSWORD/DB``.

    Raises ``ValueError`` naming every missing variable (the port has a default)."""
    if kind not in DATABASES:
        raise ValueError(f"unknown database kind {kind!r}; use one of {sorted(DATABASES)}")
    env = os.environ if env is None else env
    scheme, default_port, driver, extra = DATABASES[kind]
    prefix = ENV_PREFIX[kind]
    needed = {k: env.get(f"{prefix}_{k}") for k in ("HOST", "USER", "PASSWORD", "DB")}
    missing = [f"{prefix}_{k}" for k, v in needed.items() if not v]
    if missing:
        raise ValueError(f"Missing required {kind} environment variables: {', '.join(missing)}")
    port = env.get(f"{prefix}_PORT") or default_port
    return {
        "url": f"{scheme}://{needed['HOST']}:{port}/{needed['DB']}",
        "user": needed["USER"],
        "password": needed["PASSWORD"],
        "driver": driver,
        **extra,
    }


@dataclass(frozen=True)
class Partitioning:
    """Parallel read on a numeric/date column: Spark issues ``num_partitions``
    range queries instead of one."""

    column: str
    lower: int | str
    upper: int | str
    num_partitions: int


def read_options(
    options: Mapping[str, str],
    table: str | None = None,
    query: str | None = None,
    partitioning: Partitioning | None = None,
    fetchsize: int = 10000,
) -> dict[str, str]:
    """Reader options for a table or a query (the query is wrapped as a derived
    table so that it can be partitioned; ORDER BY inside it is pointless work)."""
    if (table is None) == (query is None):
        raise ValueError("give exactly one of table or query")
    opts = dict(options)
    opts["dbtable"] = table if table is not None else f"({query}) AS query_result"
    opts["fetchsize"] = str(fetchsize)
    if partitioning is not None:
        opts.update(
            partitionColumn=partitioning.column,
            lowerBound=str(partitioning.lower),
            upperBound=str(partitioning.upper),
            numPartitions=str(partitioning.num_partitions),
        )
    return opts


def read_jdbc(
    spark: SparkSession,
    options: Mapping[str, str],
    table: str | None = None,
    query: str | None = None,
    partitioning: Partitioning | None = None,
    columns: Sequence[str] | None = None,
    fetchsize: int = 10000,
) -> DataFrame:
    """Read a table or query; ``columns`` is pushed to the database (column pruning),
    filters applied to the result are pushed down as WHERE clauses by Spark."""
    df = (
        spark.read.format("jdbc")
        .options(**read_options(options, table, query, partitioning, fetchsize))
        .load()
    )
    return df.select(*columns) if columns else df
