"""Command line for the three jobs, for use with ``spark-submit``.

    spark-submit --py-files tidemark.zip tidemark/cli.py initial-load --history s3a://.../feed/ \\
        --current s3a://.../current/ --archive s3a://.../archive/ --version-key version,version_time
    spark-submit --py-files tidemark.zip tidemark/cli.py merge --delta s3a://.../daily/ --current ... [same keys]
    spark-submit --py-files tidemark.zip tidemark/cli.py version-increment \\
        --daily-table db.daily --archive-table db.archive --out s3a://.../out/

Keys default to the property feed's (``property_id``, ``city``, ``version``).  ``--current-table`` /
``--archive-table`` select the catalog form (tables whose partitions the catalog tracks).  The session
comes from ``spark-submit``; recommended SQL settings are applied only where the submitter set nothing.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from tidemark.plans import (
    incremental_merge,
    incremental_merge_table,
    initial_load,
    initial_load_run,
    initial_load_table,
    merge_run,
    version_job,
)
from tidemark.property_feed import (
    LOAD_TIME_COLUMN,
    DAILY_SCHEMA,
    DEFAULT_PARTITION_KEY,
    DEFAULT_PRIMARY_KEY,
    DEFAULT_VERSION_KEY,
    HISTORY_SCHEMA,
)
from tidemark.property_feed import stored_schema as property_stored_schema
from tidemark.session import RECOMMENDED_CONF
from tidemark.sources import scan
from tidemark.spec import TableSpec


def _names(text: str) -> tuple[str, ...]:
    return tuple(n.strip() for n in text.split(",") if n.strip())


def _spec(args) -> TableSpec:
    normalizer = None
    if args.title_case_partitions:
        from tidemark.functions import title_case as normalizer
    return TableSpec(_names(args.primary_key), _names(args.version_key), args.partition_key,
                     load_ts_col=args.load_ts_col or (LOAD_TIME_COLUMN if args.property_schema else "load_ts"), partition_normalizer=normalizer)


def _table_args(p: argparse.ArgumentParser, feed: str) -> None:
    p.add_argument(f"--{feed}", required=True, help=f"folder of the {feed} feed")
    p.add_argument("--format", default="parquet", help="format of the feed (parquet, orc, json, csv, avro)")
    p.add_argument("--current", help="folder of the current table")
    p.add_argument("--archive", help="folder of the archive table")
    p.add_argument("--current-table", help="catalog name of the current table (catalog form)")
    p.add_argument("--archive-table", help="catalog name of the archive table (catalog form)")
    p.add_argument("--property-schema", action="store_true",
                   help="read the feed with the property feed's columns and types, in file order (CSV, JSON)")
    p.add_argument("--header", action="store_true", help="CSV feed files start with a header line")
    p.add_argument("--primary-key", default=DEFAULT_PRIMARY_KEY, help="key column(s), comma separated")
    p.add_argument("--version-key", default=DEFAULT_VERSION_KEY,
                   help="newest-first order column(s), comma separated; add tie-breaks")
    p.add_argument("--partition-key", default=DEFAULT_PARTITION_KEY, help="partition column")
    p.add_argument("--load-ts-col", default=None, help="column storing the load time")
    p.add_argument("--load-ts", help="load time of this run (default: now, once)")
    p.add_argument("--runs", action="store_true",
                   help="catalog form whose swaps commit in one step and whose archive names its runs (both jobs of a table, or neither)")
    p.add_argument("--title-case-partitions", action="store_true",
                   help="title-case partition values of every incoming row")


def parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="tidemark", description="versioned current + archive tables on Spark")
    sub = ap.add_subparsers(dest="job", required=True)
    i = sub.add_parser("initial-load", help="history feed -> current (newest per key) + archive")
    _table_args(i, "history")
    i.add_argument("--buckets", type=int, help="with --runs: bucket current by the primary key")
    m = sub.add_parser("merge", help="daily delta -> touched partitions of current, archive snapshot")
    _table_args(m, "delta")
    m.add_argument("--archive-once", action="store_true",
                   help="skip the archive append if archive holds rows of --load-ts in a touched partition "
                        "(re-running a failed job archives once)")
    v = sub.add_parser("version-increment", help="daily LEFT JOIN archive, inc_version = coalesce(version,0)+1")
    v.add_argument("--daily-table", required=True)
    v.add_argument("--archive-table", required=True)
    v.add_argument("--out", required=True, help="JSON output folder")
    v.add_argument("--daily-key", default="id")
    v.add_argument("--version-col", default="version")
    return ap


def apply_recommended(spark: SparkSession) -> None:
    """Recommended SQL settings, only where the submitter set nothing."""
    submitted = spark.sparkContext.getConf()
    for key, value in RECOMMENDED_CONF.items():
        if not submitted.contains(key):
            spark.conf.set(key, value)


def run(spark: SparkSession, argv: Sequence[str]) -> None:
    args = parser().parse_args(list(argv))
    if args.job == "version-increment":
        version_job(spark, args.daily_table, args.archive_table, args.out, daily_key=args.daily_key,
                    version_col=args.version_col)
        return
    spec = _spec(args)
    initial = args.job == "initial-load"
    schema = (HISTORY_SCHEMA if initial else DAILY_SCHEMA) if args.property_schema else None
    # bad rows fail the run, and a header must name the columns in the schema's order
    options = {"mode": "FAILFAST"} if schema is not None and args.format in ("csv", "json") else {}
    options |= {"header": "true", "enforceSchema": "false"} if args.header else {}
    feed = scan(spark, args.history if initial else args.delta, args.format, schema=schema, **options)
    catalog = args.current_table is not None
    if not catalog and args.current is None:
        raise SystemExit("give --current (folder) or --current-table (catalog name)")
    if args.runs:
        if not catalog or args.archive_table is None:
            raise SystemExit("--runs needs --current-table and --archive-table")
        if not initial:
            merge_run(spark, feed, spec, args.current_table, args.archive_table, load_ts=args.load_ts)
        elif args.current is None or args.archive is None:
            raise SystemExit("initial-load --runs needs --current and --archive (the table folders) too")
        else:
            initial_load_run(spark, feed, spec, args.current_table, args.current, args.archive_table, args.archive,
                             load_ts=args.load_ts, buckets=args.buckets)
        return
    if initial:
        if catalog:
            if args.current is None:
                raise SystemExit("the catalog form of initial-load needs --current (the table folder) too")
            initial_load_table(spark, feed, spec, args.current_table, args.current, args.archive_table,
                               args.archive, load_ts=args.load_ts, fmt="parquet")
        else:
            initial_load(feed, spec, args.current, args.archive, load_ts=args.load_ts)
    elif args.archive_once and args.load_ts is None:
        raise SystemExit("--archive-once needs --load-ts, the load time that names the run")
    elif catalog:
        incremental_merge_table(spark, feed, spec, args.current_table, args.archive_table, load_ts=args.load_ts,
                                archive_once=args.archive_once)
    else:
        stored = property_stored_schema(spec.load_ts_col) if args.property_schema else None
        incremental_merge(spark, feed, spec, args.current, args.archive, load_ts=args.load_ts, current_schema=stored,
                          archive_once=args.archive_once)


def main(argv: Sequence[str] | None = None) -> None:
    import sys

    spark = SparkSession.builder.appName("tidemark").getOrCreate()
    apply_recommended(spark)
    run(spark, sys.argv[1:] if argv is None else argv)


if __name__ == "__main__":
    main()
