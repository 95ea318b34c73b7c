"""Exact per-key row numbers and running sums that do not put a hot key in one task.

``Window.partitionBy(key).orderBy(...)`` sends every row of a key to one task; if
one key holds a third of the data, that task holds a third of the data.  Here the
rows are range-partitioned on (key, order) instead — the sampled range bounds split
a hot key across many partitions — and each partition numbers its own rows.

The range-partitioned rows are checkpointed to the shared checkpoint folder: that
pins every row's partition id (two separate range exchanges would sample different
bounds), and cuts the lineage so a lost executor does not recompute the sort.  The
local windows then run over (partition id, key) groups, clustered by a second range
exchange so that large groups do not share a task.

Offsets from earlier partitions: inside partition p only the *first* key can have
rows in earlier partitions (all rows of earlier partitions sort before all rows of
p).  So the table of non-zero offsets has at most one row per partition — a proven
bound — and is broadcast; the numbered rows are never shuffled for it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from threatlens.session import ensure_checkpoint_dir


def _ranged(df: DataFrame, keys: list[str], order: list[str], num_partitions: int | None) -> DataFrame:
    """Range-partition on (keys, order), tag rows with their partition id and pin
    both in the shared checkpoint folder."""
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ensure_checkpoint_dir(spark)
    return (
        df.repartitionByRange(n, *[F.col(c) for c in keys + order])
        .withColumn("_pid", F.spark_partition_id())
        .checkpoint(eager=True)
    )


def _by_part_and_key(ranged: DataFrame, keys: list[str]) -> DataFrame:
    """Cluster the tagged rows by (partition id, key) for the local windows.

    A range exchange never splits a group and weighs its bounds by rows, so each of
    the few large (partition, hot key) groups gets a task of its own; a hash of
    (partition id, key) can send several of them to one task.  The price is one
    sampling read of the (narrow) checkpointed rows."""
    n = ranged.rdd.getNumPartitions()
    return ranged.repartitionByRange(n, F.col("_pid"), *[F.col(k) for k in keys])


def with_sequence(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    running: Mapping[str, Column] | None = None,
    num_partitions: int | None = None,
) -> DataFrame:
    """Add ``seq`` (1-based row number per key in ``order``) and, for each
    ``running`` item, the inclusive running sum of its expression.

    ``order`` must make rows unique within a key (end it with an id column), as for
    any deterministic row number.  Ascending order, nulls first, like ``orderBy``.
    """
    keys, order = list(keys), list(order)
    running = dict(running or {})
    base = df
    for name, expr in running.items():
        base = base.withColumn(f"_v_{name}", expr)
    ranged = _ranged(base, keys, order, num_partitions)
    w_local = Window.partitionBy("_pid", *keys).orderBy(*order)
    upto = w_local.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = _by_part_and_key(ranged, keys).withColumn("_lseq", F.row_number().over(w_local))
    for name in running:
        local = local.withColumn(f"_l_{name}", F.sum(f"_v_{name}").over(upto))

    per_part = ranged.groupBy("_pid", *keys).agg(
        F.count(F.lit(1)).alias("_pcnt"),
        *[F.sum(f"_v_{name}").alias(f"_p_{name}") for name in running],
    )
    before = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.select(
        F.col("_pid").alias("_opid"),
        *[F.col(k).alias(f"_ok_{k}") for k in keys],
        F.sum("_pcnt").over(before).alias("_ocnt"),
        *[F.sum(f"_p_{name}").over(before).alias(f"_o_{name}") for name in running],
    ).filter(F.col("_ocnt").isNotNull())  # at most one row per partition
    cond = F.col("_pid") == F.col("_opid")
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_ok_{k}"))
    joined = local.join(F.broadcast(offsets), cond, "left")
    out = joined.withColumn(
        "seq", (F.coalesce(F.col("_ocnt"), F.lit(0)) + F.col("_lseq")).cast("long")
    )
    for name in running:
        out = out.withColumn(name, F.coalesce(F.col(f"_o_{name}"), F.lit(0)) + F.col(f"_l_{name}"))
    return out.select(*df.columns, "seq", *running.keys())


def with_previous(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    alias: str,
    num_partitions: int | None = None,
) -> DataFrame:
    """``lag(value) over (partition by keys order by order)`` without a per-key task.

    Inside each range partition the window lag over (partition, key) is already the
    exact previous row, except for the first row of each (partition, key).  Only the
    first key of a partition can have rows in earlier partitions, and its previous
    row is the last row of that key in the latest earlier partition holding it: the
    lag over the per-partition tails.  That repair table has at most one row per
    partition and is broadcast; the rows themselves are shuffled once (range) plus
    once for the local window.
    """
    keys, order = list(keys), list(order)
    ranged = _ranged(df, keys, order, num_partitions)
    w_local = Window.partitionBy("_pid", *keys).orderBy(*order)
    local = _by_part_and_key(ranged, keys).withColumn(alias, F.lag(value).over(w_local)).withColumn(
        "_is_last", F.lead(F.lit(1)).over(w_local).isNull()
    )
    tails = local.filter(F.col("_is_last")).select("_pid", *keys, F.col(value).alias("_tail"))
    w_tail = Window.partitionBy(*keys).orderBy("_pid")
    carry = (
        tails.withColumn("_has_prev", F.count(F.lit(1)).over(w_tail.rowsBetween(Window.unboundedPreceding, -1)) > 0)
        .withColumn("_carry", F.lag("_tail").over(w_tail))
        .filter(F.col("_has_prev"))  # at most one row per partition
        .select(F.col("_pid").alias("_cpid"), *[F.col(k).alias(f"_ck_{k}") for k in keys], "_carry")
    )
    cond = F.col("_pid") == F.col("_cpid")
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_ck_{k}"))
    # the first row of a (partition, key) has a null local lag and takes the carry
    is_first = F.lag(F.lit(1)).over(w_local).isNull()
    fixed = local.withColumn("_is_first", is_first).join(F.broadcast(carry), cond, "left")
    out = fixed.withColumn(
        alias, F.when(F.col("_is_first") & F.col("_cpid").isNotNull(), F.col("_carry")).otherwise(F.col(alias))
    )
    return out.select(*df.columns, alias)


def ordered_runs(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    separator: str = " > ",
    times: str = " x",
    num_partitions: int | None = None,
) -> DataFrame:
    """Per key, the values in ``order`` as run-length-coded text: ``A x3 > B > A``.

    Adds ``rows``, ``runs`` and ``chain`` to the keys.  Each range partition folds the rows
    of a key to one piece: its first run, its last run and the text between them.  Pieces
    are mergeable: two that follow each other join their touching runs where the values
    are equal.  A key has at most one piece per partition, and only those meet in one row;
    its rows never do.  ``order`` must be unique within a key; a null value is a run of the
    text ``null``."""
    keys, order = list(keys), list(order)
    ranged = _ranged(df.withColumn("_value", F.coalesce(F.col(value).cast("string"), F.lit("null"))), keys, order, num_partitions)
    w_local = Window.partitionBy("_pid", *keys).orderBy(*order)
    before = F.lag("_value").over(w_local)
    new = F.when(before.isNull() | (before != F.col("_value")), 1).otherwise(0)
    numbered = _by_part_and_key(ranged, keys).withColumn("_new", new)
    numbered = numbered.withColumn("_run", F.sum("_new").over(w_local.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    runs = numbered.groupBy("_pid", *keys, "_run").agg(F.first("_value").alias("v"), F.count(F.lit(1)).alias("n"))
    listed = runs.groupBy("_pid", *keys).agg(F.sort_array(F.collect_list(F.struct("_run", "v", "n"))).alias("runs"))  # of one partition

    def text(run: Column) -> Column:
        return F.when(run["n"] > 1, F.concat(run["v"], F.lit(times), run["n"].cast("string"))).otherwise(run["v"])

    runs_of = F.col("runs")
    inner = F.transform(F.slice(runs_of, 2, F.greatest(F.size(runs_of) - 2, F.lit(0))), text)
    edge = lambda at: F.struct(F.element_at(runs_of, at)["v"].alias("v"), F.element_at(runs_of, at)["n"].alias("n"))
    pieces = listed.select(
        *keys,
        F.struct(
            F.col("_pid").alias("pid"),
            F.size(runs_of).cast("long").alias("runs"),
            F.aggregate(runs_of, F.lit(0).cast("long"), lambda total, r: total + r["n"]).alias("rows"),
            edge(1).alias("first"),
            F.array_join(inner, separator).alias("between"),
            edge(-1).alias("last"),
        ).alias("piece"),
    )
    joined = pieces.groupBy(*keys).agg(F.sort_array(F.collect_list("piece")).alias("pieces"))  # one per partition at most
    start = F.struct(
        F.lit(0).cast("long").alias("rows"),
        F.lit(0).cast("long").alias("runs"),
        F.lit("").alias("done"),
        F.lit(None).cast("struct<v:string,n:bigint>").alias("open"),
    )

    def append(done: Column, *more: Column) -> Column:
        """Texts behind each other, empty ones left out."""
        parts = F.filter(F.array(done, *more), lambda t: t != "")
        return F.array_join(parts, separator)

    def fold(acc: Column, p: Column) -> Column:
        touches = F.coalesce(acc["open"]["v"] == p["first"]["v"], F.lit(False))
        first = F.struct(p["first"]["v"].alias("v"), (p["first"]["n"] + F.when(touches, acc["open"]["n"]).otherwise(0)).alias("n"))
        closed = F.when(touches | acc["open"].isNull(), acc["done"]).otherwise(append(acc["done"], text(acc["open"])))
        single = p["runs"] == 1
        return F.struct(
            (acc["rows"] + p["rows"]).alias("rows"),
            (acc["runs"] + p["runs"] - F.when(touches, 1).otherwise(0)).alias("runs"),
            F.when(single, closed).otherwise(append(closed, text(first), p["between"])).alias("done"),
            F.when(single, first).otherwise(p["last"]).alias("open"),
        )

    folded = joined.select(*keys, F.aggregate("pieces", start, fold).alias("all"))
    chain = append(F.col("all.done"), text(F.col("all.open")))
    return folded.select(*keys, F.col("all.rows").alias("rows"), F.col("all.runs").alias("runs"), chain.alias("chain"))
