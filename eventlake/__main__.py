"""Command line: runs the layer jobs in one session and prints the findings."""

from __future__ import annotations

import argparse
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from eventlake.plans import daily, jobs
from eventlake.schema import BRONZE_SCHEMA
from eventlake.sources.layers import partition_layout, read_layer
from eventlake.sources.raw import missing_files, raw_glob

STEPS = ("bronze", "silver", "gold", "findings")


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="eventlake", description=__doc__)
    parser.add_argument("--raw", help="folder of hourly *.json.gz files")
    parser.add_argument("--lake", required=True, help="folder that holds the layers")
    parser.add_argument("--start", type=date.fromisoformat, help="first day, YYYY-MM-DD")
    parser.add_argument("--end", type=date.fromisoformat, help="last day (default: --start)")
    parser.add_argument(
        "--steps", nargs="+", default=list(STEPS),
        choices=[*STEPS, "missing", "layout", "profile"],
    )
    args = parser.parse_args(argv)
    args.end = args.end or args.start
    if args.end and not args.start:
        parser.error("--end needs --start")
    if args.start and args.end < args.start:
        parser.error("--end must not lie before --start")
    if {"bronze", "missing"} & set(args.steps) and not args.raw:
        parser.error("--raw is needed to read raw files")
    if "missing" in args.steps and not args.start:
        parser.error("--start is needed to look for missing files")
    return args


#: All rows: every report printed here has a row per hour, date, field or rank.
ALL = 2**31 - 2


def show(title: str, df: DataFrame) -> None:
    print(f"\n{title}")
    df.show(ALL, truncate=False)


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    dates = (args.start, args.end)
    if "missing" in args.steps:
        show("hours without a raw file", missing_files(spark, args.raw, *dates))
    if "bronze" in args.steps:
        path = raw_glob(args.raw, *dates) if args.start else f"{args.raw}/*.json.gz"
        print("bronze:", jobs.run_bronze(spark, [path], args.lake, *dates))
    if "layout" in args.steps:
        show("bronze layout", partition_layout(spark, f"{args.lake}/bronze"))
    if "profile" in args.steps:
        rows = read_layer(spark, f"{args.lake}/bronze", *dates, BRONZE_SCHEMA)
        rows.printSchema()
        for title, table in jobs.profile(rows).items():
            show(title, table)
    if "silver" in args.steps:
        print("silver:", jobs.run_silver(spark, args.lake, *dates))
    if "gold" in args.steps:
        # By day, only the dates that have changed are read.
        (daily.run_gold_by_day if args.start else jobs.run_gold)(spark, args.lake)
    if "findings" in args.steps:
        for title, table in jobs.findings(jobs.read_gold(spark, args.lake)).items():
            show(title, table)


def main(argv: list[str] | None = None) -> None:
    args = parse_args(argv)
    spark = SparkSession.builder.appName("eventlake").getOrCreate()
    try:
        run(spark, args)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
