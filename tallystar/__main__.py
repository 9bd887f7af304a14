"""Jobs from the command line: ``python -m tallystar <job> --root <dir> ...``."""

from __future__ import annotations

import argparse
from datetime import date, datetime, timezone

from tallystar import schemas
from tallystar.operators.watermark import EPOCH, RAW_TO_SILVER, USER_HISTORY
from tallystar.plans.silver import due_from, silver_run, user_history_run, user_star_run
from tallystar.plans.warehouse import Warehouse, bootstrap
from tallystar.session import build
from tallystar.sources.streams import stream_source
from tallystar.sources.tables import AppendTable
from tallystar.streaming.ingest import RawIngest, ShapeIngest, start_ingest


# Older event shapes and their NOT NULL columns.
SHAPES = {
    "sensor": (schemas.SENSOR_EVENT, ()),
    "live": (schemas.LIVE_EVENT, ()),
    "user": (schemas.USER_EVENT, ("event_id",)),
}


def shape_writer(spark, root: str, shape: str) -> ShapeIngest:
    """Tables ``raw_<shape>``, ``raw_<shape>_rejects`` and ``raw_<shape>_quarantine``."""
    schema, required = SHAPES[shape]

    def table(suffix: str, columns) -> AppendTable:
        return AppendTable(spark, root, f"raw_{shape}{suffix}", columns, ("source", "batch_id"))

    return ShapeIngest(
        table("", schema), table("_rejects", schema), table("_quarantine", schemas.QUARANTINE), schema, required
    )


def arguments(argv=None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tallystar")
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str, text: str) -> argparse.ArgumentParser:
        command = jobs.add_parser(name, help=text)
        command.add_argument("--root", required=True, help="directory of the tables")
        command.add_argument("--run-ts", help="the run's own time, UTC; default now")
        return command

    setup = job("bootstrap", "create and seed the tables")
    setup.add_argument("--overwrite", action="store_true", help="drop existing tables first")
    setup.add_argument("--first-day", default="2025-01-01 00:00:00")
    setup.add_argument("--days", type=int, default=30)
    setup.add_argument("--watermark", default=EPOCH, help="first mark; 'now' skips history")

    ingest = job("ingest", "stream messages into RAW")
    ingest.add_argument("--format", default="kafka")
    ingest.add_argument("--servers", default="localhost:9092")
    ingest.add_argument("--topic", default="live_stream")
    ingest.add_argument("--path", help="directory of a file source")
    ingest.add_argument("--checkpoint", required=True)
    ingest.add_argument("--interval", help="trigger interval; default back to back")
    ingest.add_argument("--starting", default="latest", help="first offset of a new topic query")
    ingest.add_argument("--shape", choices=["org", *SHAPES], default="org", help="shape of the events")
    ingest.add_argument("--register-size", action="store_true", help="keep the last batch's size in the catalog")
    ingest.add_argument("--available-now", action="store_true", help="stop when caught up")

    silver = job("silver", "load new RAW rows into the star schema")
    silver.add_argument("--export", help="directory of the CSV snapshots")
    silver.add_argument("--lateness", help="interval behind the mark to read again")
    silver.add_argument("--register-counts", action="store_true", help="count the tables afterwards")

    silver.add_argument("--declared", action="store_true", help="fill the employee and project tables too")

    users = job("users", "load new RAW rows into the type-2 user star")
    users.add_argument("--mode", choices=["batch", "history"], default="batch", help="grain of the versions")
    users.add_argument("--lateness", help="interval behind the mark to read again (history only)")

    compact = job("compact", "merge the runs of closed days")
    compact.add_argument("--before", type=date.fromisoformat, help="first day that is still open; default none")
    return parser.parse_args(argv)


def run(args: argparse.Namespace) -> object:
    spark = build()
    warehouse = Warehouse(spark, args.root)
    now = f"{datetime.now(timezone.utc):%Y-%m-%d %H:%M:%S}"
    run_ts = args.run_ts or now
    if args.job == "bootstrap":
        mark = run_ts if args.watermark == "now" else args.watermark
        return bootstrap(warehouse, run_ts, args.overwrite, args.first_day, args.days, mark)
    if args.job == "silver":
        return silver_run(
            warehouse, run_ts, args.export, args.lateness, args.register_counts, args.declared
        )
    if args.job == "compact":
        return warehouse.compact(args.before)
    if args.job == "users" and args.mode == "history":
        since = due_from(warehouse, USER_HISTORY, args.lateness)
        return user_history_run(warehouse, warehouse.raw.read(prunable=True, since=since), run_ts, args.lateness)
    if args.job == "users":
        since = due_from(warehouse, RAW_TO_SILVER)
        return user_star_run(warehouse, warehouse.raw.read(prunable=True, since=since), run_ts)
    place = (
        {"topic": args.topic, "servers": args.servers, "starting": args.starting}
        if args.format == "kafka"
        else {"path": args.path}
    )
    query = start_ingest(
        stream_source(spark, args.format, **place),
        RawIngest(warehouse, register_size=args.register_size) if args.shape == "org" else shape_writer(spark, args.root, args.shape),
        args.checkpoint,
        args.interval,
        args.available_now,
    )
    return query.awaitTermination()


if __name__ == "__main__":
    print(run(arguments()))
