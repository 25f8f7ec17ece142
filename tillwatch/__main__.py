"""Command line: ``python -m tillwatch batch transactions.csv`` or ``... stream folder``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from tillwatch.operators import models
from tillwatch.operators.features import NULL_POLICIES
from tillwatch.plans import program
from tillwatch.streaming.runs import finish


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tillwatch")
    commands = parser.add_subparsers(dest="command", required=True)
    batch = commands.add_parser("batch", help="run the whole program on CSV transactions")
    batch.add_argument("csv")
    batch.add_argument("--classifier", choices=sorted(models.CLASSIFIERS), default="rf")
    batch.add_argument("--out", help="folder to write the reports and the model to")
    batch.add_argument("--rows", type=int, default=20, help="rows to print per report")
    batch.add_argument("--null-policy", choices=NULL_POLICIES, default="fill")
    batch.add_argument("--compat-label", action="store_true")
    batch.add_argument("--refit-index", action="store_true")
    batch.add_argument("--seeded-split", action="store_true")
    stream = commands.add_parser("stream", help="score arriving CSV files with a saved model")
    stream.add_argument("csv_folder")
    stream.add_argument("--model", required=True)
    stream.add_argument("--out", required=True)
    stream.add_argument("--every", help="processing interval, such as '1 minute'; else run once")
    stream.add_argument("--timeout", type=int, help="seconds, when run once; none by default")
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName("tillwatch").getOrCreate()
    if args.command == "batch":
        with program.run(
            spark,
            args.csv,
            args.classifier,
            null_policy=args.null_policy,
            compat_label=args.compat_label,
            refit_index=args.refit_index,
            seeded_split=args.seeded_split,
        ) as outcome:
            if args.out:
                program.save_reports(outcome, args.out)
            for name, report in outcome.reports.items():
                # What was written is shown, not made a second time.
                shown = spark.read.parquet(program.report_path(args.out, name)) if args.out else report
                print(name)
                shown.show(args.rows, truncate=False)
        return
    trigger = {"processingTime": args.every} if args.every else {}
    policy = models.load_policy(args.model)
    model = models.load(args.model)
    query = program.watch(spark, args.csv_folder, model, args.out, policy, **trigger)
    if args.every:
        query.awaitTermination()
    else:
        finish(query, args.timeout)


if __name__ == "__main__":
    main()
