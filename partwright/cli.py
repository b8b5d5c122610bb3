"""V5 — ``spark-submit`` entry point.

    spark-submit partwright/cli.py --source_table T --extract_date 2026-03-01 \
        --output_path s3a://bucket/export_sales [--format parquet] \
        [--keys terr_cd,store_id,extract_date] [--overwrite all|partitions] \
        [--verify | --verify_only]

Prints the run report (and, with ``--verify``, the layout and reconciliation
records) as JSON lines.  Exit status 1 when verification fails.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

if __package__ in (None, ""):  # run as a script by spark-submit
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from partwright.plans.reconcile import verify_export  # noqa: E402
from partwright.plans.report import DEFAULT_SLA_SECONDS, run_export  # noqa: E402
from partwright.session import build_session  # noqa: E402
from partwright.sources.warehouse import read_source  # noqa: E402


def parse_args(argv=None) -> argparse.Namespace:
    p = argparse.ArgumentParser(description="Export a table as Hive-partitioned Parquet.")
    p.add_argument("--source_table", required=True, help="table name, path or connector table id")
    p.add_argument("--extract_date", required=True, help="YYYY-MM-DD")
    p.add_argument("--output_path", required=True)
    p.add_argument("--format", default="parquet", help="source data source (parquet, orc, table, ...)")
    p.add_argument("--option", action="append", default=[], help="source option key=value")
    p.add_argument("--filter_option", default=None, help="reader option taking a text row filter (connectors)")
    p.add_argument("--keys", default="terr_cd,store_id,extract_date")
    p.add_argument("--date_column", default="extract_date")
    p.add_argument("--amount_column", default="total_amt", help="decimal column summed by the checks")
    p.add_argument("--overwrite", choices=["all", "partitions"], default="all")
    p.add_argument("--strategy", choices=["split", "hash", "rebalance"], default="split")
    p.add_argument("--max_rows_per_file", type=int, default=None)
    p.add_argument("--sort_within", default="", help="comma-separated columns to cluster rows by inside each file")
    p.add_argument("--sla_seconds", type=int, default=DEFAULT_SLA_SECONDS)
    p.add_argument("--verify", action="store_true")
    p.add_argument("--verify_only", action="store_true", help="check an existing export, write nothing")
    return p.parse_args(argv)


def _json(df) -> str:
    return json.dumps(df.first().asDict(), default=str)


def main(argv=None) -> int:
    args = parse_args(argv)
    spark = build_session(app_name="partwright-export")
    keys = tuple(k.strip() for k in args.keys.split(",") if k.strip())
    options = dict(o.split("=", 1) for o in args.option)
    if not args.verify_only:
        report = run_export(
            spark,
            args.source_table,
            args.output_path,
            args.extract_date,
            fmt=args.format,
            options=options,
            filter_option=args.filter_option,
            keys=keys,
            date_column=args.date_column,
            overwrite=args.overwrite,
            strategy=args.strategy,
            max_rows_per_file=args.max_rows_per_file,
            sort_within=tuple(c.strip() for c in args.sort_within.split(",") if c.strip()),
            amount=args.amount_column,
            sla_seconds=args.sla_seconds,
        )
        print(_json(report))
        if not args.verify:
            return 0
    source = read_source(
        spark,
        args.source_table,
        fmt=args.format,
        options=options,
        extract_date=args.extract_date,
        date_column=args.date_column,
        filter_option=args.filter_option,
    )
    check = verify_export(
        spark,
        source,
        args.output_path,
        args.extract_date,
        keys=keys,
        date_column=args.date_column,
        amount=args.amount_column,
        max_rows_per_file=args.max_rows_per_file,
    ).first()
    print(json.dumps({"check": "verify", **check.asDict()}, default=str))
    ok = bool(check["verified"])
    return 0 if ok else 1


if __name__ == "__main__":
    sys.exit(main())
