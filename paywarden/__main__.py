"""Jobs from the command line: ``spark-submit`` or ``python -m paywarden``."""

from __future__ import annotations

import argparse
import datetime as dt

from paywarden.functions.rules import PROFILES
from paywarden.plans.batch import BatchRun, run_batch
from paywarden.plans.duplicates import DuplicateRun, run_duplicates
from paywarden.plans.report import report
from paywarden.session import build_session, require_utc
from paywarden.sources.readers import read_table, stream_transactions
from paywarden.streaming.jobs import StreamJob, run_streams
from paywarden.streaming.landing import land_messages


def _arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="paywarden")
    jobs = parser.add_subparsers(dest="job", required=True)

    batch = jobs.add_parser("batch", help="check a set of JSON-lines files")
    batch.add_argument("input")
    batch.add_argument("output")
    batch.add_argument("--run-id", required=True)
    batch.add_argument("--profile", choices=sorted(PROFILES), default="batch")
    batch.add_argument("--clustered", action="store_true", help="input files hold few days each")

    duplicates = jobs.add_parser("duplicates", help="find repeated transactions")
    duplicates.add_argument("input")
    duplicates.add_argument("output")

    stream = jobs.add_parser("stream", help="check and score a folder as it fills")
    stream.add_argument("input")
    stream.add_argument("output")
    stream.add_argument("checkpoint")
    stream.add_argument("--max-files", type=int, help="files per micro-batch")
    stream.add_argument("--max-bytes", type=int, help="input bytes per micro-batch")
    stream.add_argument("--once", action="store_true", help="stop when the folder is read")
    stream.add_argument("--keep-late", action="store_true", help="store rows that come after the watermark")
    stream.add_argument("--keep-keys", action="store_true", help="drop copies however late they come")
    stream.add_argument("--compact-every", type=int, help="micro-batches that are brought together")
    stream.add_argument("--tables", help="folder of the result tables to append to")

    land = jobs.add_parser("land", help="land queue messages (Parquet: raw, headers) as JSON lines")
    land.add_argument("input")
    land.add_argument("output")
    land.add_argument("checkpoint")
    land.add_argument("--once", action="store_true", help="stop when the folder is read")

    shown = jobs.add_parser("report", help="figures over a table of alerts and one of transactions")
    shown.add_argument("transactions")
    shown.add_argument("alerts")
    shown.add_argument("output", help="a folder of JSON lines for each figure")
    shown.add_argument("--customer")
    shown.add_argument("--rule")
    shown.add_argument("--dates", nargs=2, type=dt.date.fromisoformat, metavar=("FIRST", "LAST"))
    return parser.parse_args()


def main() -> None:
    args = _arguments()
    spark = build_session(f"paywarden-{args.job}")
    require_utc(spark)
    if args.job == "batch":
        run = BatchRun(args.output, args.run_id, PROFILES[args.profile])
        run_batch(spark, args.input, run, clustered=args.clustered).show()
    elif args.job == "duplicates":
        run_duplicates(spark, args.input, DuplicateRun(args.output)).show()
    elif args.job == "land":
        messages = spark.readStream.schema("raw string, headers map<string,int>").parquet(args.input)
        land_messages(messages, args.output, args.checkpoint, once=args.once).awaitTermination()
    elif args.job == "report":
        figures = report(read_table(spark, args.transactions), read_table(spark, args.alerts),
                         args.customer, args.rule, args.dates)
        for name, rows in figures.items():
            rows.write.mode("overwrite").json(f"{args.output.rstrip('/')}/{name}")
    else:
        trigger = {"availableNow": True} if args.once else {"processingTime": "0 seconds"}
        job = StreamJob(args.output, args.checkpoint, trigger=trigger, keep_late=args.keep_late,
                        keep_keys=args.keep_keys, compact_every=args.compact_every,
                        tables={"folder": args.tables} if args.tables else None)
        raw = stream_transactions(spark, args.input, args.max_files, args.max_bytes)
        run_streams(raw, job)


if __name__ == "__main__":
    main()
