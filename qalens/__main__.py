"""Command line: convert a CSV dump once, then run (and cross-check) the analyses.

    python -m qalens convert SRC_DIR DST_DIR [--files N] [--null-value NA] [--rejects]
                                             [--no-cluster] [--path TABLE=PATH ...]
    python -m qalens run DATA_DIR [--format parquet|csv.gz|csv] [--out DIR] [--out-format parquet|csv]
                                  [--check] [--time N] [--explain] [--null-value NA] [--show N]
                                  [--prune]
                                  [--path TABLE=PATH ...]
"""

from __future__ import annotations

import argparse
import sys

from qalens.session import get_session


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="qalens")
    sub = p.add_subparsers(dest="cmd", required=True)
    c = sub.add_parser("convert", help="gzip CSV exports -> typed Parquet")
    c.add_argument("src")
    c.add_argument("dst")
    c.add_argument("--files", type=int, default=None, help="Parquet files per table")
    c.add_argument("--format", default="csv.gz")
    c.add_argument("--null-value", default=None, help="CSV null marker, e.g. NA for R exports")
    c.add_argument("--path", action="append", default=[], metavar="TABLE=PATH",
                   help="location of one source table when not SRC_DIR/<Table>.<format>")
    c.add_argument("--rejects", action="store_true",
                   help="keep the records that lost values beside the table, and count what was lost")
    c.add_argument("--no-cluster", action="store_true",
                   help="deal the rows evenly instead of by the columns that analyses filter on")
    r = sub.add_parser("run", help="run the five analyses")
    r.add_argument("data")
    r.add_argument("--format", default="parquet")
    r.add_argument("--out", default=None, help="write each result here (default: print)")
    r.add_argument("--out-format", default="parquet")
    r.add_argument("--check", action="store_true", help="cross-check DataFrame and SQL forms")
    r.add_argument("--explain", action="store_true",
                   help="print each analysis's physical plan instead of running it")
    r.add_argument("--prune", action="store_true",
                   help="group only the keys that can be among the first (Q2, Q4, Q5), found by a sketch")
    r.add_argument("--time", type=int, default=0, metavar="N",
                   help="median seconds of N runs per analysis, DataFrame and SQL forms")
    r.add_argument("--null-value", default=None, help="CSV null marker, e.g. NA for R exports")
    r.add_argument("--path", action="append", default=[], metavar="TABLE=PATH",
                   help="location of one table when not DATA_DIR/<Table>.<format> (repeatable)")
    r.add_argument("--show", type=int, default=0, metavar="N",
                   help="print at most N rows of a result and say how many follow (default: all)")
    args = p.parse_args(argv)

    spark = get_session()
    from qalens.plans.report import cross_check, run_analyses, time_forms, write_analyses
    from qalens.sources import convert_to_parquet, load_tables, rejected_rows

    csv_options = {"nullValue": args.null_value} if args.null_value else None
    paths = dict(item.split("=", 1) for item in args.path)
    if args.cmd == "convert":
        for name, path in convert_to_parquet(
            spark, args.src, args.dst, fmt=args.format, files_per_table=args.files,
            csv_options=csv_options, paths=paths, cluster=not args.no_cluster, rejects=args.rejects,
        ).items():
            print(f"{name}\t{path}")
        if args.rejects:
            lost = rejected_rows(spark, args.dst).groupBy("table", "column").count().orderBy("table", "column")
            for row in lost.collect():  # a row for each typed column at most
                print("\t".join(("rejected", *map(str, row))))
        return 0
    tables = load_tables(spark, args.data, args.format, csv_options=csv_options, paths=paths)
    if args.explain:
        from qalens.plans.inspect import plan_text

        for name, df in run_analyses(tables, args.prune).items():
            print(f"== {name}\n{plan_text(df)}")
        return 0
    if args.out:
        for name, path in write_analyses(tables, args.out, args.out_format, args.prune).items():
            print(f"{name}\t{path}")
    else:
        for name, df in run_analyses(tables, args.prune).items():
            print(f"== {name}")
            print("\t".join(df.columns))
            hidden = 0
            for i, row in enumerate(df.toLocalIterator()):  # one partition at a time
                if args.show and i >= args.show:
                    hidden += 1
                else:
                    print("\t".join("NULL" if v is None else str(v) for v in row))
            if hidden:
                print(f"... and {hidden} more rows")
    if args.time:
        for name, frame_sec, sql_sec in time_forms(spark, tables, args.time):
            print(f"{name}\tdataframe {frame_sec:.3f} s\tsql {sql_sec:.3f} s")
    if args.check:
        rows = cross_check(spark, tables).collect()
        for row in rows:
            print("\t".join(str(v) for v in row))
        if any(row.rows_differing for row in rows):
            return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
