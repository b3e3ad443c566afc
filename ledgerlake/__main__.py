"""Command line: ``python -m ledgerlake run gold_anomalias --base <folder> --asof 2026-01-01``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from . import jobs


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="ledgerlake")
    commands = parser.add_subparsers(dest="command", required=True)
    one = commands.add_parser("run", help="build, check and publish one table")
    one.add_argument("job", choices=sorted(jobs.JOBS))
    one.add_argument("--base", required=True)
    one.add_argument("--asof", required=True)
    one.add_argument("--ver", type=int)
    hist = commands.add_parser("history", help="add one day to a validity history")
    hist.add_argument("history", choices=sorted(jobs.HISTORIES))
    hist.add_argument("--base", required=True)
    hist.add_argument("--asof", required=True)
    hist.add_argument("--mode", choices=["changes", "snapshot", jobs.ANY_ORDER], default="changes")
    hist.add_argument("--ver", type=int, help="version of the source table; the current one if not given")
    monitor = commands.add_parser("monitor", help="quality metrics of all stored tables")
    monitor.add_argument("--base", required=True)
    monitor.add_argument("--asof", required=True)
    stream = commands.add_parser("stream", help="ingest captured trades")
    stream.add_argument("--base", required=True)
    stream.add_argument("--stamp", required=True)
    stream.add_argument("--every", help='keep running at this pace, for example "1 minute"')
    refresh = commands.add_parser("stream-gold", help="refresh stream gold tables from new trades only")
    refresh.add_argument("--base", required=True)
    refresh.add_argument("--asof", required=True)
    stream.add_argument("--max-files", type=int, default=1000, help="files of one micro-batch")
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName("ledgerlake").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if args.command == "run":
        print(jobs.run(spark, args.job, args.base, args.asof, args.ver))
    elif args.command == "history":
        print(jobs.run_history(spark, args.history, args.base, args.asof, args.mode, args.ver))
    elif args.command == "monitor":
        jobs.run_monitoring(spark, args.base, args.asof).orderBy("qualidade_pct").show(truncate=False)
    elif args.command == "stream-gold":
        print(jobs.run_stream_gold(spark, args.base, args.asof))
    else:
        jobs.run_stream(spark, args.base, args.stamp, args.every, args.max_files).awaitTermination()


if __name__ == "__main__":
    main()
