"""Run one job: ``python -m tidemark slices --as-of 2024-01-30 ...``."""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from datetime import date, datetime, time

from pyspark.sql import SparkSession

from tidemark.operators import anomaly
from tidemark.params import Params
from tidemark.plans import jobs
from tidemark.session import configure
from tidemark.sources.loads import load_sources
from tidemark.sources.tables import FEED_ACTIONS, MESSAGE_ACTIONS, read_events, stream_events
from tidemark.streaming import alerts as stream_alerts
from tidemark.streaming.slots import stream_slot_metrics

JOBS = [
    "slices", "feed-report", "app-report", "alerts", "backtest", "alert-stream",
    "alert-corrections", "backtest-grid",
]


def _arguments(argv: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tidemark", description=__doc__)
    parser.add_argument("job", choices=JOBS)
    parser.add_argument("--as-of", type=date.fromisoformat, required=True, help="the run's today")
    parser.add_argument("--at", type=time.fromisoformat, help="time of an alert run, HH:MM")
    parser.add_argument("--feed", required=True, help="folder of the feed events")
    parser.add_argument("--messages", required=True, help="folder of the messages")
    parser.add_argument("--target", required=True, help="folder of the results")
    parser.add_argument("--format", default="parquet", help="format of the event tables")
    parser.add_argument("--store", help="folder for rows per day kept between runs")
    parser.add_argument("--iqr-a", type=float, default=2.0, help="width of a band in IQRs")
    parser.add_argument(
        "--neighbours", type=int, default=3, help="slots to either side of the clock time"
    )
    parser.add_argument(
        "--factors", type=float, nargs="+", default=[1.5, 2.0, 3.0], help="of a backtest-grid"
    )
    parser.add_argument(
        "--widths", type=int, nargs="+", default=[1, 3, 6], help="of a backtest-grid"
    )
    parser.add_argument(
        "--every", help="trigger of a stream, as '15 minutes'; without it, what is there"
    )
    parser.add_argument("--lateness", default="1 hour", help="watermark of a stream")
    parser.add_argument("--cluster", action="store_true", help="use the cluster settings")
    parser.add_argument(
        "--initial-partitions", type=int, default=8192, help="of a cluster's shuffles"
    )
    return parser.parse_args(argv)


def main(argv: Sequence[str] | None = None) -> None:
    args = _arguments(argv)
    builder = SparkSession.builder.appName(f"tidemark-{args.job}")
    spark = configure(builder, args.cluster, args.initial_partitions).getOrCreate()
    p = Params(as_of=args.as_of, iqr_a=args.iqr_a, neighbour_slots=args.neighbours)

    if args.job == "alert-stream":
        feed = stream_events(spark, FEED_ACTIONS, args.feed, args.format)
        messages = stream_events(spark, MESSAGE_ACTIONS, args.messages, args.format)
        stream_alerts.run_alerts(
            stream_slot_metrics(feed, messages, p, args.lateness),
            f"{args.target}/stream_slots",
            f"{args.target}/stream_alerts",
            f"{args.target}/stream_checkpoint",
            p,
            every=args.every,
        ).awaitTermination()
        return

    # An alert run opens the folders of its days only.
    days = p.alert_days if args.job == "alerts" else None
    feed = read_events(spark, FEED_ACTIONS, args.feed, args.format, days)
    messages = read_events(spark, MESSAGE_ACTIONS, args.messages, args.format, days)
    sources = None
    if args.store and args.format == "parquet":
        sources = load_sources(spark, [args.feed, args.messages], days)
    if args.job == "slices":
        jobs.run_daily_slices(feed, messages, p, f"{args.target}/slice_metrics_daily")
    elif args.job == "feed-report":
        jobs.run_feed_report(feed, p, args.target)
    elif args.job == "app-report":
        jobs.run_app_report(feed, messages, p, args.target, args.store, sources)
    elif args.job == "backtest":
        flags = anomaly.anomaly_backtest(anomaly.slot_metrics(feed, messages, p), p)
        flags.write.mode("overwrite").parquet(f"{args.target}/anomaly_backtest")
    elif args.job == "backtest-grid":
        found = anomaly.backtest_grid(
            anomaly.slot_metrics(feed, messages, p), p, args.factors, args.widths
        )
        found.write.mode("overwrite").parquet(f"{args.target}/anomaly_backtest_grid")
    elif args.job == "alert-corrections":
        jobs.run_late_corrections(
            feed,
            messages,
            p,
            f"{args.target}/stream_slots",
            f"{args.target}/stream_alerts",
            args.store or f"{args.target}/stream_store",
            sources,
        )
    else:
        at = datetime.combine(args.as_of, args.at) if args.at else None
        jobs.run_alerts(feed, messages, p, args.target, args.store, at, sources)


if __name__ == "__main__":
    main()
