"""Command line for schedulers: run the job for a date or a range of dates.

    spark-submit tilepulse/cli.py --date 2025-12-01
    spark-submit tilepulse/cli.py --start 2025-11-01 --end 2025-11-30 --target-db reporting_db
    spark-submit tilepulse/cli.py --dates 2025-11-03,2025-11-17

The session comes from ``spark-submit`` (master, resources, ``spark.checkpoint.dir``); settings
the job relies on that the session leaves unset are applied (UTC day boundary, AQE). Prints one
JSON line with the run report.
"""

from __future__ import annotations

import argparse
import json
import logging
import os
import sys

if __package__ in (None, ""):  # run as a file by spark-submit
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from tilepulse.config import JobOptions, TableNames  # noqa: E402
from tilepulse.plans.daily import run_daily, run_dates, run_range  # noqa: E402
from tilepulse.session import JOB_CONF  # noqa: E402


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="tilepulse", description=__doc__.split("\n\n")[0])
    when = p.add_mutually_exclusive_group(required=True)
    when.add_argument("--date", help="process date (YYYY-MM-DD)")
    when.add_argument("--start", help="first date of a range (with --end)")
    when.add_argument("--dates", help="comma-separated dates to re-run (e.g. after late data)")
    p.add_argument("--end", help="last date of a range")
    p.add_argument("--source-db", help="database of the three source tables")
    p.add_argument("--target-db", help="database of the two target tables")
    p.add_argument("--distinct-method", choices=["two_level", "count_distinct"], default="two_level")
    p.add_argument("--on-duplicate-metadata", choices=["latest", "fail"], default="latest")
    p.add_argument("--zero-fill", action="store_true", help="also write active tiles without events")
    p.add_argument("--drop-null-tiles", action="store_true", help="leave out events without a tile_id")
    p.add_argument("--missing-tiles-table", help="table that receives every tile without metadata")
    p.add_argument("--no-enrich", action="store_true", help="write the v1.0 summary (no labels)")
    p.add_argument("--category-only", action="store_true", help="write tile_category only")
    args = p.parse_args(argv)
    if args.start and not args.end:
        p.error("--start needs --end")
    return args


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    args = parse(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(name)s: %(message)s")
    if spark is None:
        spark = SparkSession.builder.appName("tilepulse").getOrCreate()
        submitted = dict(spark.sparkContext.getConf().getAll())
        for key, value in JOB_CONF.items():  # job settings the submitter left unset
            if key not in submitted and spark.conf.isModifiable(key):
                spark.conf.set(key, value)
    tables = TableNames()
    if args.source_db or args.target_db:
        src = args.source_db or tables.tile_events.split(".")[0]
        tgt = args.target_db or tables.daily_summary.split(".")[0]
        tables = tables.in_databases(src, tgt)
    options = JobOptions(
        distinct_method=args.distinct_method,
        on_duplicate_metadata=args.on_duplicate_metadata,
        zero_fill=args.zero_fill,
        drop_null_tiles=args.drop_null_tiles,
        missing_tiles_table=args.missing_tiles_table,
        enrich=not args.no_enrich,
        label_columns=("tile_category",) if args.category_only else ("tile_name", "tile_category"),
    )
    if args.date:
        report = run_daily(spark, args.date, tables, options)
    elif args.dates:
        report = run_dates(spark, [d.strip() for d in args.dates.split(",") if d.strip()], tables, options)
    else:
        report = run_range(spark, args.start, args.end, tables, options)
    out = {
        "dates": [d.isoformat() for d in report.dates],
        "metadata_available": report.metadata_available,
        "metadata_rows": report.metadata_rows,
        "missing_metadata_tiles": report.missing_metadata_tiles,
        "emptied_dates": [d.isoformat() for d in report.emptied_dates],
    }
    print(json.dumps(out))
    return out


if __name__ == "__main__":
    main()
