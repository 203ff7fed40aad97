"""Run the batch from the command line: ``spark-submit`` this file, or ``python -m tillstar``.

    python -m tillstar /data/shop /data/out --format parquet --by-month

Settings such as ``spark.checkpoint.dir`` come from the Spark configuration.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from tillstar.plans import BatchOutput, refresh_months, run_batch
from tillstar.sources import load_tables


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tillstar", description=__doc__.splitlines()[0])
    parser.add_argument("source", help="folder with the four tables, as <table>.<format>")
    parser.add_argument("destination", help="folder for the fact table and the results")
    parser.add_argument("--source-format", choices=["csv", "parquet"], default="csv")
    parser.add_argument("--format", choices=["csv", "parquet"], default="csv")
    parser.add_argument("--by-month", action="store_true", help="lay the fact table out by month")
    parser.add_argument(
        "--refresh", nargs="+", metavar="YYYY-MM",
        help="bring these months of an earlier Parquet run by month up to date; the fact stays Parquet",
    )
    parser.add_argument("--results", nargs="*", metavar="NAME", help="results to store (default: all)")
    parser.add_argument(
        "--size", nargs="*", default=[], metavar="NAME=N", help="length of a list, depth of a ranking"
    )
    parser.add_argument("--index", action="store_true", help="first column row_index in results")
    parser.add_argument("--counted", action="store_true", help="count rows while writing; print the audit")
    parser.add_argument("--keep-staged", action="store_true", help="keep the Parquet fact of a CSV run")
    parser.add_argument("--multi-line", action="store_true", help="line breaks within CSV cells")
    parser.add_argument("--normalize-status-first", action="store_true")
    parser.add_argument("--null-totals", choices=["keep", "zero"], default="keep")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> BatchOutput:
    """Run with the given session, or with one of its own that it stops at the end."""
    args = parse_args(argv)
    session = spark or SparkSession.builder.appName("tillstar").getOrCreate()
    try:
        read = {"multi_line": args.multi_line} if args.source_format == "csv" else {}
        tables = load_tables(session, args.source, args.source_format, **read)
        common = dict(
            fmt=args.format,
            names=args.results,
            sizes={name: int(n) for name, n in (s.split("=", 1) for s in args.size)},
            with_index=args.index,
            normalize_status_first=args.normalize_status_first,
            null_totals=args.null_totals,
        )
        if args.refresh:
            months = [tuple(map(int, month.split("-"))) for month in args.refresh]
            out = refresh_months(session, tables, args.destination, months, **common)
        else:
            out = run_batch(
                session,
                tables,
                args.destination,
                by_month=args.by_month,
                keep_staged=args.keep_staged,
                counted=args.counted,
                **common,
            )
        for path in (out.fact, out.staged_fact, *out.results.values()):
            if path:
                print(path)
        for table in (out.audit, out.row_counts):
            if table is None:
                continue
            for row in table.toLocalIterator():
                print(*row, sep="\t")
        return out
    finally:
        if spark is None:
            session.stop()


if __name__ == "__main__":
    main()
