"""Command line: ``python -m salesmart rebuild RAW_DIR`` runs the whole build
from the five raw files; ``python -m salesmart answer RUN_DIR`` prints the
six questions and four chart tables of a written warehouse.

Under ``spark-submit`` the active session and its configuration are used;
otherwise a local session is started.
"""

from __future__ import annotations

import argparse
import json
import sys

from salesmart.params import Params


def _session():
    """The cluster session under ``spark-submit`` (its master and sizing
    untouched; only our SQL defaults are added where unset), else local."""
    import os

    from pyspark.sql import SparkSession

    from salesmart.session import SESSION_DEFAULTS, local_session
    active = SparkSession.getActiveSession()
    if active is None and not os.environ.get("PYSPARK_GATEWAY_PORT"):
        return local_session("*")
    spark = active or SparkSession.builder.getOrCreate()
    for key, value in SESSION_DEFAULTS.items():
        if key.startswith("spark.sql.") and spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


def _params(args) -> Params:
    return Params(high_tier_min=args.high, medium_tier_min=args.medium, growth_min_prev_revenue=args.min_prev,
                  late_states_min_orders=args.min_orders)


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="python -m salesmart")
    sub = ap.add_subparsers(dest="cmd", required=True)
    rb = sub.add_parser("rebuild", help="clean, model, aggregate and answer from raw files")
    rb.add_argument("raw_dir")
    rb.add_argument("--format", default="csv", choices=["csv", "parquet"])
    rb.add_argument("--line-breaks", nargs="*", default=[], metavar="SOURCE",
                    help="CSV sources whose quoted fields may hold line breaks")
    rb.add_argument("--out", default=None, help="run folder (default: new folder under spark.checkpoint.dir)")
    rb.add_argument("--root", default=None, help="folder of builds: a new one goes there and becomes the current one")
    rb.add_argument("--keep", type=int, default=None, help="with --root: remove builds older than the last KEEP")
    rb.add_argument("--preview", type=int, default=5, help="rows of each mart shown")
    rb.add_argument("--no-answers", action="store_true")
    an = sub.add_parser("answer", help="print the questions and chart tables of a written warehouse")
    an.add_argument("run_dir", help="folder of a build, or a folder of builds: its current one")
    an.add_argument("--rows", type=int, default=None, help="rows printed per answer (default: the whole answer)")
    for p in (rb, an):
        d = Params()
        p.add_argument("--high", type=float, default=d.high_tier_min)
        p.add_argument("--medium", type=float, default=d.medium_tier_min)
        p.add_argument("--min-prev", type=float, default=d.growth_min_prev_revenue)
        p.add_argument("--min-orders", type=int, default=d.late_states_min_orders)
    args = ap.parse_args(argv)
    spark = _session()

    if args.cmd == "rebuild":
        from salesmart.plans.pipeline import rebuild
        from salesmart.sources import read_sources
        report = rebuild(spark, read_sources(spark, args.raw_dir, args.format, line_breaks=args.line_breaks), _params(args), args.out,
                         answers=not args.no_answers, root=args.root, keep=args.keep, preview_rows=args.preview)
        print(json.dumps({"out_dir": report.out_dir, "rows": report.rows, "seconds": report.seconds,
                          "profile": report.profile, "duplicates": report.duplicates, "accounting": report.accounting,
                          "checks": report.checks, "previews": report.previews}, indent=2, default=str))
        return 0

    from salesmart.plans.warehouse import Warehouse
    w = Warehouse.from_written(spark, args.run_dir, _params(args))
    for name, df in {**w.questions(), **w.charts()}.items():
        print(f"\n== {name}")
        rows = df.count()  # answers are top-n tables, bounded by their parameters and the calendar
        shown = rows if args.rows is None else min(rows, args.rows)
        df.show(max(shown, 1), truncate=False)
        if shown < rows:
            print(f"({rows - shown} more rows)")
    return 0


if __name__ == "__main__":
    sys.exit(main())
