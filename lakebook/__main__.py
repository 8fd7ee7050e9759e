"""``spark-submit`` entry: a whole month, or one of its three steps.

    spark-submit --py-files lakebook.zip lakebook/__main__.py run \\
        --root s3a://bucket/lake --flow s3a://bucket/in/flow --accidents s3a://bucket/in/acc
"""

from __future__ import annotations

import argparse
from datetime import date

from pyspark.sql import SparkSession

from lakebook.plans.month import (
    LakePaths,
    conform_month,
    ingest_month,
    load_stamp,
    refine_month,
    run_month,
)
from lakebook.runwindow import RunWindow


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="lakebook")
    parser.add_argument("step", choices=("run", "ingest", "conform", "refine"))
    parser.add_argument("--root", required=True, help="root folder of the lake")
    parser.add_argument("--flow", default="", help="flow files (run, ingest)")
    parser.add_argument("--accidents", default="", help="accident files (run, ingest)")
    parser.add_argument("--as-of", type=date.fromisoformat, default=None, help="default: today")
    parser.add_argument("--dt-proc", default=None, help="load stamp, yyyyMMddHHmmss; default: now")
    parser.add_argument("--mode", choices=("overwrite", "append"), default="overwrite")
    parser.add_argument("--conform", choices=("pending", "all"), default="pending")
    parser.add_argument("--id-mode", choices=("hash", "md5"), default="hash")
    args = parser.parse_args(argv)
    if args.step in ("run", "ingest") and not (args.flow and args.accidents):
        parser.error(f"{args.step} needs --flow and --accidents")
    return args


def main(argv: list[str] | None = None) -> dict[str, int]:
    args = parse(argv)
    spark = SparkSession.builder.appName(f"lakebook-{args.step}").getOrCreate()
    lake = LakePaths(args.root, args.flow, args.accidents)
    as_of = args.as_of or date.today()
    stamp = args.dt_proc or load_stamp()
    if args.step == "ingest":
        rows = ingest_month(spark, lake, stamp)
    elif args.step == "conform":
        rows = conform_month(spark, lake, stamp, args.conform, args.id_mode)
    elif args.step == "refine":
        run = RunWindow.of(as_of)
        rows = refine_month(spark, lake, run, stamp, mode=args.mode, id_mode=args.id_mode)
    else:
        rows = run_month(
            spark, lake, as_of, stamp, None, args.mode, args.conform, args.id_mode
        ).rows
    for table, count in rows.items():
        print(f"{table}: {count}")
    return rows


if __name__ == "__main__":
    main()
