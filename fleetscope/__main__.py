"""Command line: ``python -m fleetscope --help`` lists the commands.

Runs in whatever session spark-submit or the Spark defaults describe.
"""

from __future__ import annotations

import argparse
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from fleetscope.operators import quality
from fleetscope.plans import catalog, results, runs
from fleetscope.schema import TELEMETRY, TELEMETRY_V1
from fleetscope.sinks.writers import Receipt
from fleetscope.sources import readers

NAMED = {
    **results.RESULTS,
    **catalog.ANALYSES,
    **catalog.CHECKS,
    # against a reading every three seconds
    "cadence_completeness": quality.cadence_completeness,
}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="fleetscope", description=__doc__)
    commands = top.add_subparsers(dest="command", required=True)

    def command(name: str, text: str, reads: bool = True) -> argparse.ArgumentParser:
        sub = commands.add_parser(name, help=text)
        if reads:
            sub.add_argument("--input", required=True)
            sub.add_argument("--format", choices=("csv", "parquet", "json"), default="parquet")
            sub.add_argument(
                "--start", type=date.fromisoformat, help="first day, for input without day columns"
            )
        return sub

    load = command("load", "validate, load by day (or in full) and report")
    load.add_argument("--target", required=True)
    load.add_argument("--full", action="store_true", help="replace the whole table")
    load.add_argument("--versioned", action="store_true", help="publish the table's next version")
    analyse = command("analyse", "write all result tables and a report")
    analyse.add_argument("--target", required=True)
    export = command("export", "write every result as CSV")
    export.add_argument("--target", required=True)
    publish = command("publish", "load CSV results into their collections", reads=False)
    publish.add_argument("--input", required=True, help="folder written by export")
    publish.add_argument("--target", required=True)
    publish.add_argument("--append", action="store_true", help="keep what is there")
    review = command("review", "report on stored result tables", reads=False)
    review.add_argument("--target", required=True)
    command("validate", "fail on telemetry that is not fit to be loaded")
    query = command("query", "show a named query")
    query.add_argument("--name", required=True, choices=sorted(NAMED))
    return top


def read(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    schema = TELEMETRY_V1 if args.start else TELEMETRY
    if args.format == "json":
        df = readers.read_documents(spark, args.input)
        df = df.select(*schema.fieldNames())
    else:
        reader = readers.read_csv if args.format == "csv" else readers.read_parquet
        df = reader(spark, args.input, schema)
    return runs.prepare(df, args.start)


def show(receipts: dict[str, Receipt]) -> None:
    for name, receipt in receipts.items():
        print(f"{name}: {receipt.stored} rows at {receipt.path}")


def main(arguments: list[str] | None = None) -> None:
    args = parser().parse_args(arguments)
    spark = SparkSession.builder.appName("fleetscope").getOrCreate()
    if args.command == "review":
        runs.review(spark, args.target)
        return
    if args.command == "publish":
        show(results.publish_csv_results(spark, args.input, args.target, append=args.append))
        return
    df = read(spark, args)
    if args.command == "load":
        print(runs.load(df, args.target, by_day=not args.full, versioned=args.versioned))
    elif args.command == "analyse":
        show(runs.analyse(df, args.target))
    elif args.command == "export":
        show(results.write_csv_results(df, args.target))
    elif args.command == "validate":
        quality.validate(df, unique=True)
        print("Validation passed")
    else:
        NAMED[args.name](df).show(truncate=False)


if __name__ == "__main__":
    main()
