"""Command line: run the lake jobs and reports against a lake root.

    python -m ledgerline refresh  --root ROOT --ds 2024-03-31 --raw-dir RAW [--gate SUITE ... | --no-gates]
                                  [--denylist-format document|lines]
    python -m ledgerline stream   --root ROOT (--inbox DIR | --kafka HOST:PORT --topic NAME)
    python -m ledgerline report   NAME --root ROOT [--rows 50 | --out DIR]
    python -m ledgerline validate SUITE --root ROOT [--ds DS]
    python -m ledgerline constraints --root ROOT
    python -m ledgerline expire   --root ROOT [--keep 7]

Uses the active Spark configuration (``spark-submit`` or ``SPARK_*`` settings);
the session time zone is pinned to UTC.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from ledgerline.operators import quality
from ledgerline.plans import refresh
from ledgerline.plans.catalog import REPORTS
from ledgerline.session import pin_utc
from ledgerline.sources import expiry, lake, raw
from ledgerline.sources.lake import Layout
from ledgerline.streaming import landing


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="ledgerline")
    sub = p.add_subparsers(dest="cmd", required=True)
    r = sub.add_parser("refresh", help="bronze ingest + silver + gold for one run date")
    r.add_argument("--root", required=True)
    r.add_argument("--ds", required=True)
    r.add_argument("--raw-dir", required=True)
    r.add_argument("--gate", action="append", choices=sorted(quality.SUITES), help="only this gate (repeatable); default all")
    r.add_argument("--no-gates", action="store_true", help="publish whatever comes out")
    r.add_argument(
        "--denylist-format",
        choices=["document", "lines"],
        default="document",
        help="denylist.json holds one (pretty-printed) document, or JSON lines of documents",
    )
    s = sub.add_parser("stream", help="land the event topic (availableNow)")
    s.add_argument("--root", required=True)
    s.add_argument("--inbox")
    s.add_argument("--kafka")
    s.add_argument("--topic", default="events")
    q = sub.add_parser("report", help="run a business report over published gold")
    q.add_argument("name", choices=REPORTS)
    q.add_argument("--root", required=True)
    q.add_argument("--rows", type=int, default=50, help="rows of the printed preview")
    q.add_argument("--out", help="write the whole report here as CSV instead of printing a preview")
    v = sub.add_parser("validate", help="run a quality suite")
    v.add_argument("suite", choices=sorted(quality.SUITES))
    v.add_argument("--root", required=True)
    v.add_argument("--ds")
    c = sub.add_parser("constraints", help="gold key and constraint report")
    c.add_argument("--root", required=True)
    e = sub.add_parser("expire", help="remove silver and gold versions that nobody reads any more")
    e.add_argument("--root", required=True)
    e.add_argument("--keep", type=int, default=expiry.KEEP_VERSIONS, help="newest versions that stay in any case")
    return p


def main(argv: list[str] | None = None) -> int:
    parser = _parser()
    args = parser.parse_args(argv)
    if args.cmd == "validate" and args.suite == "bronze_payments" and not args.ds:
        parser.error("validate bronze_payments needs --ds")
    spark = pin_utc(SparkSession.builder.appName("ledgerline").getOrCreate())
    layout = Layout(args.root.rstrip("/"))
    if args.cmd == "refresh":
        landed = raw.read_landing(spark, args.raw_dir, args.denylist_format == "document", rescue=True)
        gates = () if args.no_gates else tuple(args.gate or quality.SUITES)
        out = refresh.full_refresh(spark, layout, args.ds, landed, gates)
        print(json.dumps(out, default=str))
    elif args.cmd == "stream":
        if args.kafka:
            messages = landing.broker_messages(spark, args.kafka, args.topic)
        elif args.inbox:
            messages = landing.file_messages(spark, args.inbox)
        else:
            raise SystemExit("stream needs --inbox or --kafka")
        landing.land_events(messages, layout.stream_landing, layout.stream_checkpoint).awaitTermination()
    elif args.cmd == "report":
        rows = getattr(refresh.published_gold(spark, layout), args.name)()
        if args.out:
            rows.write.option("header", True).csv(args.out)
        else:
            print(f"first {args.rows} rows (--out writes all of them):")
            rows.show(args.rows, truncate=False)
    elif args.cmd == "validate":
        table = {
            "bronze_payments": lambda: lake.read_bronze(spark, layout, "payments", args.ds),
            "silver_payments": lambda: lake.read_silver(spark, layout, "payments"),
            "gold_fct_payments": lambda: lake.read_gold(spark, layout, "fct_payments"),
        }[args.suite]()
        try:
            rows = quality.validate(table, args.suite)
        except quality.SuiteFailed as exc:
            print(exc, file=sys.stderr)
            return 1
        print(f"{args.suite}: {len(rows)}/{len(rows)} expectations passed")
    elif args.cmd == "constraints":
        report = quality.constraint_report(refresh.published_gold(spark, layout).tables)
        report.orderBy("table_name", "kind", "constraint_name").show(200, truncate=False)
    elif args.cmd == "expire":
        for layer, gone in expiry.expire_versions(spark, layout, args.keep).items():
            print(f"{layer}: {len(gone.versions)} versions and {len(gone.folders)} folders removed")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
