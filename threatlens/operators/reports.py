"""Report queries over the scored results: distributions, key figures, filters,
ordering, paging, highlighting and text conversion.

Every distribution is a hash aggregate with partial aggregation; the small results
are ordered afterwards.  Row-level reports order on a unique key so that a page is
deterministic and the sort range-partitions evenly (a bare score has five values).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from threatlens.config import PRIORITY_ORDER, TIME_RANGES, PipelineConfig, TrafficRules
from threatlens.functions.scoring import priority_rank
from threatlens.functions.selection import rows_between
from threatlens.operators.traffic import traffic_anomalies

#: Reference order per result kind, followed by a unique tie-break: (column, descending).
ORDER_SPECS: dict[str, list[tuple[str, bool]]] = {
    "failed_logins": [("risk_score", True), ("username", False), ("ip_address", False)],
    "suspicious_traffic": [
        ("anomaly_score", True),
        ("timestamp", False),
        ("traffic_id", False),
        ("source_ip", False),
        ("destination_ip", False),
        ("port", False),
    ],
    "enriched_alerts": [("severity_score", True), ("is_resolved", False), ("alert_id", False)],
    # dashboard table order for alerts
    "alerts_table": [("severity_score", True), ("action_required", True), ("alert_id", False)],
}


def order_of(kind: str) -> list[Column]:
    return [F.desc(c) if desc else F.asc(c) for c, desc in ORDER_SPECS[kind]]


RANGES = dict(TIME_RANGES)


def ordered(df: DataFrame, kind: str) -> DataFrame:
    return df.orderBy(*order_of(kind))


def distribution(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))


def risk_distribution(failed: DataFrame, lo: int | None = None, hi: int | None = None) -> DataFrame:
    """Counts per risk score, optionally for ``lo <= risk_score <= hi`` (inclusive)."""
    if lo is not None or hi is not None:
        failed = failed.filter(
            F.col("risk_score").between(lo if lo is not None else -(2**31), hi if hi is not None else 2**31 - 1)
        )
    return distribution(failed, "risk_score")


def anomaly_distribution(scored: DataFrame) -> DataFrame:
    return distribution(scored, "anomaly_score")


def select_priorities(enriched: DataFrame, selected: Iterable[str] | None = None) -> DataFrame:
    """``priority IN (selected)``; None means all four, an empty selection no rows."""
    selected = list(PRIORITY_ORDER if selected is None else selected)
    if not selected:
        return enriched.filter(F.lit(False))
    return enriched.filter(F.col("priority").isin(*selected))


def priority_distribution(enriched: DataFrame, selected: Iterable[str] | None = None) -> DataFrame:
    """Counts per priority with the fixed report rank (CRITICAL=0 ... LOW=3)."""
    counts = distribution(select_priorities(enriched, selected), "priority")
    return counts.withColumn("sort_order", priority_rank(F.col("priority")))


def priority_share(enriched: DataFrame, selected: Iterable[str] | None = None) -> DataFrame:
    """Share of each priority in the selection (the donut's percent labels).  The
    window runs over the at most four aggregated rows."""
    counts = priority_distribution(enriched, selected)
    total = F.sum("count").over(Window.partitionBy())
    return counts.withColumn("share", F.col("count") / total)


def alert_type_distribution(enriched: DataFrame, selected: Iterable[str] | None = None) -> DataFrame:
    return distribution(select_priorities(enriched, selected), "alert_type")


def action_summary(enriched: DataFrame) -> DataFrame:
    return distribution(enriched, "action_required")


def _rows(agg: DataFrame, rows: Sequence[tuple[str, ...]], names: Sequence[str]) -> DataFrame:
    """Turn the single row of ``agg`` into one row per entry of ``rows`` (each entry
    names the literal label and the aggregate columns to take), without another pass."""
    label, *values = names
    structs = [
        F.struct(F.lit(r[0]).alias(label), *[F.col(c).alias(v) for c, v in zip(r[1:], values)])
        for r in rows
    ]
    return agg.select(F.explode(F.array(*structs)).alias("r")).select("r.*")


def kpi_cards(
    failed: DataFrame, scored: DataFrame, enriched: DataFrame, cfg: PipelineConfig = PipelineConfig()
) -> DataFrame:
    """The four dashboard cards, one row each: (card, total, flagged).

    ``failed_logins`` counts (user, address) groups and ``suspicious_traffic`` counts
    every scored connection — what the cards show.  One aggregate per dataset."""
    logins = failed.agg(
        F.count(F.lit(1)).alias("t"), F.count_if(F.col("risk_score") >= cfg.high_risk).alias("f")
    )
    traffic = scored.agg(
        F.count(F.lit(1)).alias("t"), F.count_if(F.col("anomaly_score") >= cfg.high_anomaly).alias("f")
    )
    alerts = enriched.agg(
        F.count(F.lit(1)).alias("t"),
        F.count_if(F.col("priority") == "CRITICAL").alias("f"),
        F.count_if(F.col("action_required")).alias("a"),
    )
    names = ("card", "total", "flagged")
    return (
        _rows(logins, [("failed_logins", "t", "f")], names)
        .unionByName(_rows(traffic, [("suspicious_traffic", "t", "f")], names))
        .unionByName(
            _rows(alerts, [("security_alerts", "t", "f"), ("actions_required", "a", "a")], names)
        )
    )


def risk_bounds(failed: DataFrame) -> DataFrame:
    """Slider bounds: min(min(risk), 0) and max(max(risk), 100); 0 and 100 when empty."""
    return failed.agg(
        F.least(F.coalesce(F.min("risk_score"), F.lit(0)), F.lit(0)).alias("slider_min"),
        F.greatest(F.coalesce(F.max("risk_score"), F.lit(100)), F.lit(100)).alias("slider_max"),
    )


def _chart(cells: DataFrame, charts: Mapping[str, tuple[str, str]], totals: Mapping[str, tuple[str, str]]) -> DataFrame:
    """(chart, label, value) from the aggregated ``cells`` of one dataset: a bar for each value
    of a chart's column, ``charts: name -> (column, measure)``, and one value for each of
    ``totals: label -> (chart, measure)``.  All of them are grouping sets of the cells."""
    columns = list(dict.fromkeys(column for column, _ in charts.values()))
    measures = list(dict.fromkeys([m for _, m in charts.values()] + [m for _, m in totals.values()]))
    sets = [[F.col(c)] for c in columns] + [[]]
    grouped = cells.groupingSets(sets, *[F.col(c) for c in columns]).agg(
        F.grouping_id(*columns).alias("_set"), *[F.coalesce(F.sum(m), F.lit(0)).cast("long").alias(m) for m in measures]
    )
    all_sets = (1 << len(columns)) - 1
    bars = [
        F.when(
            F.col("_set") == all_sets - (1 << (len(columns) - 1 - columns.index(column))),
            F.struct(F.lit(name).alias("chart"), F.col(column).cast("string").alias("label"), F.col(measure).alias("value")),
        )
        for name, (column, measure) in charts.items()
    ]
    sums = [
        F.when(F.col("_set") == all_sets, F.struct(F.lit(chart).alias("chart"), F.lit(label).alias("label"), F.col(m).alias("value")))
        for label, (chart, m) in totals.items()
    ]
    rows = grouped.select(F.explode(F.array(*bars, *sums)).alias("r")).filter("r is not null").select("r.*")
    # a bar without rows in the selection is no bar; a total may be 0
    return rows.filter((F.col("value") > 0) | (F.col("chart") == "kpi"))


def refresh_charts(
    failed: DataFrame,
    scored: DataFrame,
    enriched: DataFrame,
    risk_range: tuple[int, int] | None = None,
    priorities: Iterable[str] | None = None,
    cfg: PipelineConfig = PipelineConfig(),
) -> DataFrame:
    """All charts and cards of a refresh as (chart, label, value), with one scan of each
    dataset.  A scan is one partial aggregate to the few cells that the charts share; the
    charts are grouping sets of the cells, not of the rows."""
    one = F.count(F.lit(1)).alias("n")
    low, high = risk_range if risk_range is not None else (-(2**31), 2**31 - 1)
    logins = failed.groupBy("risk_score").agg(one)
    logins = logins.withColumns(
        {
            "shown": F.when(F.col("risk_score").between(low, high), F.col("n")).otherwise(0),
            "high": F.when(F.col("risk_score") >= cfg.high_risk, F.col("n")).otherwise(0),
        }
    )
    traffic = scored.groupBy("anomaly_score").agg(one)
    traffic = traffic.withColumn("high", F.when(F.col("anomaly_score") >= cfg.high_anomaly, F.col("n")).otherwise(0))
    alerts = enriched.groupBy("priority", "alert_type", "action_required").agg(one)
    selected = F.col("priority").isin(*(PRIORITY_ORDER if priorities is None else priorities))
    alerts = alerts.withColumns(
        {
            "shown": F.when(selected, F.col("n")).otherwise(0),
            "critical": F.when(F.col("priority") == "CRITICAL", F.col("n")).otherwise(0),
            "actions": F.when(F.col("action_required"), F.col("n")).otherwise(0),
        }
    )
    return (
        _chart(
            logins,
            {"risk_distribution": ("risk_score", "shown")},
            {"failed_logins": ("kpi", "n"), "high_risk_logins": ("kpi", "high")},
        )
        .unionByName(
            _chart(
                traffic,
                {"anomaly_distribution": ("anomaly_score", "n")},
                {"suspicious_traffic": ("kpi", "n"), "high_anomalies": ("kpi", "high")},
            )
        )
        .unionByName(
            _chart(
                alerts,
                {
                    "priority_distribution": ("priority", "shown"),
                    "alert_type_distribution": ("alert_type", "shown"),
                    "action_summary": ("action_required", "n"),
                },
                {"security_alerts": ("kpi", "n"), "critical_alerts": ("kpi", "critical"), "actions_required": ("kpi", "actions")},
            )
        )
    )


_OPS = {
    "=": lambda c, v: c == v,
    "!=": lambda c, v: c != v,
    "<": lambda c, v: c < v,
    "<=": lambda c, v: c <= v,
    ">": lambda c, v: c > v,
    ">=": lambda c, v: c >= v,
    "contains": lambda c, v: c.cast("string").contains(str(v)),
}


def filter_table(df: DataFrame, filters: Mapping[str, tuple[str, object]]) -> DataFrame:
    """Ad-hoc column filters ``{column: (op, value)}``, ANDed; ops = != < <= > >= contains."""
    for column, (op, value) in filters.items():
        if op not in _OPS:
            raise ValueError(f"unknown filter operator {op!r}; use one of {sorted(_OPS)}")
        df = df.filter(_OPS[op](F.col(column), value))
    return df


def highlight(df: DataFrame, kind: str, cfg: PipelineConfig = PipelineConfig()) -> DataFrame:
    """Row class of the result tables: high risk / high anomaly / critical / high."""
    if kind == "failed_logins":
        cls = F.when(F.col("risk_score") >= cfg.high_risk, "high-risk")
    elif kind == "suspicious_traffic":
        cls = F.when(F.col("anomaly_score") >= cfg.high_anomaly, "high-anomaly")
    elif kind == "enriched_alerts":
        cls = F.when(F.col("priority") == "CRITICAL", "critical").when(F.col("priority") == "HIGH", "high")
    else:
        raise ValueError(f"unknown result kind {kind!r}")
    return df.withColumn("highlight", cls)


def time_range(df: DataFrame, column: str, as_of, range_name: str = "all") -> DataFrame:
    """Rows with ``as_of - range <= column <= as_of`` (``as_of`` is an argument, never now())."""
    if range_name not in RANGES:
        raise ValueError(f"unknown range {range_name!r}; use one of {sorted(RANGES)}")
    span = RANGES[range_name]
    if span is None:
        return df
    if isinstance(as_of, (dt.datetime, dt.date)):
        as_of = as_of.isoformat(sep=" ") if isinstance(as_of, dt.datetime) else as_of.isoformat()
    # as text, the literal is cast to the column's type without a zone conversion
    end = F.lit(as_of).cast(df.schema[column].dataType)
    return df.filter(F.col(column).between(end - F.expr(f"INTERVAL {span}"), end))


def recent_traffic(traffic: DataFrame, as_of, range_name: str, rules: TrafficRules = TrafficRules()) -> DataFrame:
    """Scored traffic of a time range, filtered before it is scored.

    Whether a connection is rapid depends on the rows up to ``rapid_gap_s`` before it,
    so the range is widened by that and by the started second, and trimmed afterwards;
    the filter on the source's own column reaches the scan."""
    if RANGES.get(range_name) is None:
        return time_range(traffic_anomalies(traffic, rules), "timestamp", as_of, range_name)
    end = F.lit(str(as_of)).cast(traffic.schema["timestamp"].dataType)
    start = end - F.expr(f"INTERVAL {RANGES[range_name]}") - F.expr(f"INTERVAL {rules.rapid_gap_s + 1} SECONDS")
    scored = traffic_anomalies(traffic.filter(F.col("timestamp").between(start, end)), rules)
    return time_range(scored, "timestamp", as_of, range_name)


def page(df: DataFrame, order: Sequence[Column], page_no: int = 0, size: int = 10) -> DataFrame:
    """One page of a sorted table.  ``order`` must be unique for stable pages; the
    planner turns sort+offset+limit into a top-k (no full sort)."""
    if page_no < 0 or size <= 0:
        raise ValueError(f"page {page_no} of size {size}: need page >= 0 and size > 0")
    return df.orderBy(*order).offset(page_no * size).limit(size)


#: Rows before a page that a top-k may hold in a task; deeper pages are selected by rank.
SHALLOW_ROWS = 10_000


def table_page(df: DataFrame, kind: str, page_no: int = 0, size: int = 10) -> DataFrame:
    """One page, of any depth, of a result table in its report order.

    A page near the start is a top-k.  A deeper one is found by rank (``rows_between``):
    the ranges before it are counted, not sorted, and only its own range is sorted."""
    if page_no < 0 or size <= 0:
        raise ValueError(f"page {page_no} of size {size}: need page >= 0 and size > 0")
    if page_no * size <= SHALLOW_ROWS:
        return page(df, order_of(kind), page_no, size)
    return rows_between(df, ORDER_SPECS[kind], page_no * size, size)


def preview(df: DataFrame, kind: str, n: int = 3) -> DataFrame:
    return ordered(df, kind).limit(n)


def first_columns(df: DataFrame, n: int = 5) -> DataFrame:
    return df.select(*df.columns[:n])


def timestamps_as_text(df: DataFrame, fmt: str = "yyyy-MM-dd HH:mm:ss") -> DataFrame:
    """Every timestamp column (chosen by type) formatted as text; other columns kept."""
    out = []
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            out.append(F.date_format(F.col(field.name), fmt).alias(field.name))
        else:
            out.append(F.col(field.name))
    return df.select(*out)


def parse_timestamps(df: DataFrame, columns: Sequence[str], fmt: str = "yyyy-MM-dd HH:mm:ss") -> DataFrame:
    """Text back to timestamps, only for the listed columns that exist."""
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: F.to_timestamp_ntz(F.col(c), F.lit(fmt)) for c in present})


def run_summary_counts(
    logins: DataFrame,
    failed: DataFrame,
    scored: DataFrame,
    enriched: DataFrame,
    cfg: PipelineConfig = PipelineConfig(),
) -> DataFrame:
    """The run summary's six counts as (metric, value) rows, one aggregate per
    dataset: every traffic row is kept by the scoring, so the scored result also
    counts the extracted traffic, and the enriched alerts count the extracted ones."""
    names = ("metric", "value")
    login_n = logins.agg(F.count(F.lit(1)).alias("n"))
    failed_n = failed.agg(F.count(F.lit(1)).alias("n"))
    traffic_n = scored.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("anomaly_score") > cfg.summary_anomaly).alias("s"),
    )
    alert_n = enriched.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("priority").isin(*cfg.urgent_priorities)).alias("u"),
    )
    return (
        _rows(login_n, [("login_attempts_extracted", "n")], names)
        .unionByName(_rows(failed_n, [("failed_login_metrics", "n")], names))
        .unionByName(
            _rows(traffic_n, [("traffic_records_extracted", "n"), ("suspicious_traffic_patterns", "s")], names)
        )
        .unionByName(
            _rows(alert_n, [("security_alerts_processed", "n"), ("critical_high_alerts", "u")], names)
        )
    )
