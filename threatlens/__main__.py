"""Command line: run the pipeline, print reports, or start the streams.

    python -m threatlens run    --tables DIR --out DIR [--run-id ID]
    python -m threatlens report --out DIR [--run-id ID] [--risk LO HI] [--priority P ...] [--layout runs|flat]
                                [--range all|24h|7d|30d --as-of TIME]
    python -m threatlens stream --tables DIR --out DIR [--available-now]
    python -m threatlens queries
    python -m threatlens explain NAME --tables DIR        # formatted physical plan

``--tables`` is a folder with ``events``, ``lineitem`` and ``orders`` parquet tables
(the security views are derived from them).
"""

from __future__ import annotations

import argparse
import json

from threatlens.plans import etl as P
from threatlens.session import build_session
from threatlens.sources import views as V
from threatlens.streaming import incremental as ST


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="threatlens")
    sub = ap.add_subparsers(dest="cmd", required=True)
    run = sub.add_parser("run")
    run.add_argument("--tables", required=True)
    run.add_argument("--out", required=True)
    run.add_argument("--run-id")
    run.add_argument("--snapshot-format", choices=("csv", "parquet"), default="csv")
    rep = sub.add_parser("report")
    rep.add_argument("--out", required=True)
    rep.add_argument("--run-id")
    rep.add_argument("--risk", nargs=2, type=int, default=(0, 100))
    rep.add_argument("--priority", nargs="*")
    rep.add_argument("--layout", choices=("runs", "flat"), default="runs")
    rep.add_argument("--snapshot-format", choices=("csv", "parquet"), default="csv")
    rep.add_argument("--range", dest="time_range", choices=("all", "24h", "7d", "30d"), default="all")
    rep.add_argument("--as-of", help="end of the time range, e.g. '2024-01-31 00:00:00'")
    st = sub.add_parser("stream")
    st.add_argument("--tables", required=True)
    st.add_argument("--out", required=True)
    st.add_argument("--available-now", action="store_true")
    st.add_argument("--max-files", type=int, default=64, help="most files in one micro-batch")
    sub.add_parser("queries")
    ex = sub.add_parser("explain")
    ex.add_argument("name")
    ex.add_argument("--tables", required=True)
    args = ap.parse_args(argv)
    if args.cmd == "queries":
        from threatlens.plans.registry import QUERIES

        print("\n".join(QUERIES))
        return

    spark = build_session()
    try:
        if args.cmd == "explain":
            from threatlens.plans.registry import QUERIES

            QUERIES[args.name](spark, args.tables).explain("formatted")
        elif args.cmd == "run":
            s = P.run_pipeline(
                *P.extract(spark, args.tables), out_root=args.out, run_id=args.run_id,
                snapshot_format=args.snapshot_format,
            )
            print(json.dumps({"run_id": s.run_id, "seconds": s.duration_s, **s.counts}))
        elif args.cmd == "report":
            reports = P.report_refresh(
                spark, args.out, args.run_id, tuple(args.risk), args.priority,
                layout=args.layout, time_range=args.time_range, as_of=args.as_of,
                snapshot_format=args.snapshot_format,
            )
            for name, df in reports.items():
                print(f"-- {name}")
                df.show(truncate=False)
        else:
            trig = ST.Trigger(available_now=args.available_now)

            def source(table: str):
                return ST.read_stream(spark, f"{args.tables}/{table}.parquet", max_files_per_trigger=args.max_files)

            qs = [
                ST.failed_logins_stream(
                    V.login_attempts_from_events(source("events")),
                    f"{args.out}/failed_logins", f"{args.out}/_checkpoints/failed_logins", trigger=trig),
                ST.score_traffic_stream(
                    V.network_traffic_from_lineitem(source("lineitem")),
                    f"{args.out}/suspicious_traffic", f"{args.out}/_checkpoints/suspicious_traffic", trigger=trig),
                ST.score_alerts_stream(
                    V.security_alerts_from_orders(source("orders")),
                    f"{args.out}/enriched_alerts", f"{args.out}/_checkpoints/enriched_alerts", trigger=trig),
            ]
            for q in qs:
                q.awaitTermination()
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
