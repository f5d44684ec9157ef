"""Command line for scheduled runs (``spark-submit -m editflow ...`` or ``python -m editflow``).

    python -m editflow run     --source DIR --base DIR [--layer L] [--suffix S] [--no-rules] [--namespace N --register]
    python -m editflow history --base DIR [--suffix S]
    python -m editflow capture --capture DIR --landing DIR [--quarantine DIR] [--limit N]

The session comes from ``SparkSession.builder.getOrCreate()`` so the
cluster's own settings (master, checkpoint folder, credentials) apply.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from editflow.plans.runner import run_all_layers, run_layer
from editflow.session import SESSION_DEFAULTS, ensure_checkpoint_dir
from editflow.sources import tables as T
from editflow.sources.feed_capture import land_capture


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="editflow")
    sub = parser.add_subparsers(dest="command", required=True)
    run = sub.add_parser("run", help="build one layer or all layers")
    run.add_argument("--source", help="landing folder of JSON-lines files (landing layer)")
    run.add_argument("--base", required=True, help="folder holding the layer tables")
    run.add_argument("--layer", choices=T.LAYERS, help="only this layer (default: all, in order)")
    run.add_argument("--suffix", default="", help="table-name suffix, e.g. _seq")
    run.add_argument("--no-rules", action="store_true", help="run without data-quality rules")
    run.add_argument("--format", default="parquet")
    run.add_argument("--top-n", type=int, default=100)
    run.add_argument("--time-unit", choices=("ms", "s"), default="ms")
    run.add_argument("--register", action="store_true", help="record tables in the session catalog")
    run.add_argument("--max-files-per-trigger", type=int, help="bound one landing micro-batch")
    run.add_argument("--archive", help="move landed source files here after their batch commits")
    run.add_argument("--full-refresh", action="store_true", help="land all source files anew, into a new generation")
    run.add_argument("--namespace", help="one catalog database for all tables (default: one for each layer); with --register")
    run.add_argument("--wide-ids", action="store_true", help="read revision ids as bigint")
    past = sub.add_parser("history", help="rule counters of every finished build under a base folder, as JSON lines")
    past.add_argument("--base", required=True)
    past.add_argument("--suffix", default="")
    cap = sub.add_parser("capture", help="turn captured feed text into landing files")
    cap.add_argument("--capture", required=True)
    cap.add_argument("--landing", required=True)
    cap.add_argument("--quarantine")
    cap.add_argument("--limit", type=int)
    args = parser.parse_args(argv)
    if args.command == "run" and not args.layer and not args.source:
        parser.error("--source is needed to run all layers")
    if args.command == "run" and args.layer == "landing" and not args.source:
        parser.error("--source is needed for the landing layer")

    builder = SparkSession.builder.appName(f"editflow-{args.command}")
    spark = builder.getOrCreate()
    for key, value in SESSION_DEFAULTS.items():
        if key.startswith("spark.sql.") and spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    ensure_checkpoint_dir(spark)

    if args.command == "history":
        past = T.rule_history(spark, args.base, args.suffix).orderBy("table_name", "run", "rule")
        for row in past.toLocalIterator():  # a few rows a build, one partition at a time
            print(json.dumps(row.asDict()))
        return 0

    if args.command == "capture":
        written = land_capture(spark, args.capture, args.landing, args.quarantine, args.limit)
        print(json.dumps({"files": len(written)}))
        return 0

    options = dict(
        suffix=args.suffix, rules=not args.no_rules, fmt=args.format, top_n=args.top_n,
        time_unit=args.time_unit, register=args.register,
        max_files_per_trigger=args.max_files_per_trigger, archive_dir=args.archive,
        full_refresh=args.full_refresh, wide_ids=args.wide_ids, namespace=args.namespace,
    )
    if args.layer:
        result = run_layer(spark, args.layer, args.base, source_dir=args.source, **options)
    else:
        result = run_all_layers(spark, args.source, args.base, **options)
    report = result.save_rule_report(spark) if result.rule_rows else None
    print(json.dumps({"tables": result.tables, "rules": result.rule_rows, "rule_report": report}))
    return 0


if __name__ == "__main__":
    sys.exit(main())
