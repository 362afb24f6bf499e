"""Run one job: `spark-submit ledgerlake/__main__.py <job> --lake <root> --run-date <day>`."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from ledgerlake.functions.money import DIVIDE, MULTIPLY
from ledgerlake.plans import buckets, daily, warehouse
from ledgerlake.plans.layout import LakePaths, WarehousePaths
from ledgerlake.schemas import CHANGES, CHANGES_V1, INGESTION_DATE
from ledgerlake.session import build_session
from ledgerlake.sinks.lake import FILE_BYTES, compact
from ledgerlake.sources.landing import split_change_files


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="ledgerlake")
    jobs = parser.add_subparsers(dest="job", required=True)
    for name in ("fx-ingest", "bronze", "bronze-from-csv", "currency-agg", "silver-detail", "gold"):
        job = jobs.add_parser(name)
        job.add_argument("--run-date", required=True)
        if name == "fx-ingest":
            job.add_argument("--reply", required=True, help="landed JSON of the day's rates")
        if name == "bronze-from-csv":
            job.add_argument("--csv", required=True, help="folder or glob of the day's files")
        if name.startswith("bronze") or name == "silver-detail":
            job.add_argument("--files", type=int, help="shuffle into this many files")
        if name == "gold":
            job.add_argument("--max-lag-days", type=int, default=1)
    for name in ("backfill", "backfill-detail"):
        job = jobs.add_parser(name)
        job.add_argument("--since", required=True, help="first day")
        job.add_argument("--until", required=True, help="day after the last")
        if name == "backfill":
            job.add_argument("--name", help="continue, or start, the sliced backfill of this name")
            job.add_argument("--slice-days", type=int, default=31)
    for name in ("change-feed", "initial-load", "batch", "fact-load", "bucketed-batch", "cleanup"):
        job = jobs.add_parser(name)
        job.add_argument("--warehouse", required=True, help="root of all warehouse tables")
        job.add_argument("--delivery", required=True, help="name of the delivery or version; names sort by date")
        job.add_argument("--tracked", nargs="+", default=["segment"], help="columns with history")
        if name == "change-feed":
            job.add_argument("--changes", required=True, help="folder or glob of the delivery's CSV files")
        if name == "bucketed-batch":
            job.add_argument("--version", help="name to publish; the delivery's by default")
            job.add_argument("--buckets", type=int, default=buckets.BUCKETS, help="of the first version")
        if name == "cleanup":
            job.add_argument("--keep", type=int, required=True, help="published versions to keep")
        if name == "batch":
            job.add_argument("--previous", required=True, help="version to start from")
        if name == "fact-load":
            job.add_argument("--facts", required=True, help="Parquet of the delivered facts")
            job.add_argument("--fact-id", required=True)
            job.add_argument("--fact-date", required=True)
            job.add_argument("--since", required=True, help="first day")
            job.add_argument("--until", required=True, help="day after the last")
    job = jobs.add_parser("compact")
    for name in ("--source", "--destination", "--since", "--until"):
        job.add_argument(name, required=True)
    job.add_argument("--partition", default=INGESTION_DATE)
    job.add_argument("--file-bytes", type=int, default=FILE_BYTES)
    for name, job in jobs.choices.items():
        if any(action.dest in ("warehouse", "source") for action in job._actions):
            continue
        job.add_argument("--lake", required=True, help="root of all layers")
        if not name.startswith(("fx", "bronze")):
            default = DIVIDE if name == "gold" else MULTIPLY
            job.add_argument("--rate-mode", choices=(MULTIPLY, DIVIDE), default=default)
    return parser


def load(spark: SparkSession, args: argparse.Namespace) -> None:
    """One step of the change feed load."""
    paths = WarehousePaths.under(args.warehouse)
    feed = warehouse.Feed(CHANGES, tuple(args.tracked))
    if args.job == "change-feed":
        changes, rejected = split_change_files(spark, args.changes, [CHANGES_V1, CHANGES], CHANGES)
        rejected.write.mode("overwrite").parquet(f"{paths.change_reject}_lines/delivery={args.delivery}")
        warehouse.run_curation(changes, feed, paths, args.delivery)
    elif args.job == "bucketed-batch":
        print(buckets.run_bucketed_batch(spark, feed, paths, args.delivery, args.version, args.buckets).counters)
    elif args.job == "cleanup":
        print(*buckets.run_cleanup(spark, paths, args.keep), sep="\n")
    elif args.job == "initial-load":
        warehouse.run_initial_load(spark, feed, paths, args.delivery)
    elif args.job == "batch":
        warehouse.run_batch(spark, feed, paths, args.delivery, args.previous)
    else:
        facts = spark.read.parquet(args.facts)
        period = (args.since, args.until, args.fact_id, args.fact_date)
        warehouse.run_fact_load(spark, feed, facts, paths, args.delivery, *period)


def main(argv: list[str] | None = None) -> None:
    args = arguments().parse_args(argv)
    spark = build_session(f"ledgerlake {args.job}")
    if args.job == "compact":
        compact(spark, args.source, args.destination, args.since, args.until, args.partition, args.file_bytes)
        return
    if "warehouse" in args:
        load(spark, args)
        return
    paths = LakePaths.under(args.lake)
    if args.job == "fx-ingest":
        daily.run_fx_ingest(spark, args.reply, paths, args.run_date)
    elif args.job == "bronze":
        daily.run_bronze(spark, paths, args.run_date, files=args.files)
    elif args.job == "bronze-from-csv":
        print(daily.run_bronze_from_csv(spark, args.csv, paths, args.run_date, files=args.files, mask=True))
    elif args.job == "currency-agg":
        daily.run_currency_aggregate(spark, paths, args.run_date, args.rate_mode)
    elif args.job == "silver-detail":
        daily.run_silver_detail(spark, paths, args.run_date, args.files, args.rate_mode)
    elif args.job == "gold":
        print(daily.run_gold(spark, paths, args.run_date, args.max_lag_days, args.rate_mode))
    elif args.job == "backfill" and args.name:
        period = (args.since, args.until, args.name, args.slice_days, args.rate_mode)
        print(*daily.run_sliced_backfill(spark, paths, *period), sep="\n")
    elif args.job == "backfill":
        daily.run_backfill(spark, paths, args.since, args.until, args.rate_mode)
    else:
        daily.run_detail_backfill(spark, paths, args.since, args.until, args.rate_mode)


if __name__ == "__main__":
    main()
