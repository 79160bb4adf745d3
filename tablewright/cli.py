"""Run the table jobs from the command line (``spark-submit`` friendly).

    spark-submit --py-files tablewright.zip tablewright/cli.py filter-csv --source s3a://b/in --target s3a://b/out \
        --column Code --value CAE
    python -m tablewright.cli positional --source in/ --position 20=type1 --position 31=region \
        --position 61=type2 --target out/
    python -m tablewright.cli limits-load --table limits --data-file f.data \
        --location s3a://b/tables/limits --charset windows-1251
    python -m tablewright.cli snapshot --source db.documents_table --target db.archive \
        --location s3a://b/tables/archive [--sequence]
    python -m tablewright.cli filter-table --source db.category --target db.category_after \
        --predicate "catid < :limit" --param limit=7

Every job prints one line: the target and the number of rows it now holds
(a count of the written target, computed on the cluster).
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence

from pyspark.sql import SparkSession

from tablewright.params import JobParam
from tablewright.plans import jobs
from tablewright.schemas import LIMITS_COLUMNS, WIDE_DOCUMENT_COLUMNS
from tablewright.sinks.csv import write_csv
from tablewright.sources.csv import read_csv_header


def _pairs(items: Sequence[str] | None) -> dict[str, str]:
    out = {}
    for item in items or ():
        key, sep, value = item.partition("=")
        if not sep:
            raise SystemExit(f"expected key=value, got {item!r}")
        out[key] = value
    return out


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tablewright", description="Batch table jobs on Spark.")
    sub = p.add_subparsers(dest="job", required=True)

    j1 = sub.add_parser("filter-csv", help="J1: headed CSV → rows where column = value → CSV")
    j1.add_argument("--source", required=True)
    j1.add_argument("--target", required=True)
    j1.add_argument("--column", default="Code")
    j1.add_argument("--value", default="CAE")
    j1.add_argument("--multiline", action="store_true")

    j2 = sub.add_parser("filter-table", help="J2: table → parameterised filter → other table")
    j2.add_argument("--source", required=True)
    j2.add_argument("--target", required=True)
    j2.add_argument("--location")
    j2.add_argument("--predicate", default="catid < :limit")
    j2.add_argument("--param", action="append", help="name=value (int if it parses)")

    j4 = sub.add_parser("positional", help="J4: headerless CSV → columns by position → CSV")
    j4.add_argument("--source", required=True)
    j4.add_argument("--target", required=True)
    j4.add_argument("--position", action="append", required=True, help="index=name")

    j6 = sub.add_parser("limits-load", help="J6: delimited text in a charset → text table")
    j6.add_argument("--table", required=True)
    j6.add_argument("--data-file", required=True)
    j6.add_argument("--location", required=True)
    j6.add_argument("--charset", default="windows-1251")
    j6.add_argument("--local", action="store_true", help="the data file is on this machine (LOAD DATA LOCAL)")

    j7 = sub.add_parser("snapshot", help="J7: positional overwrite of the archive table")
    j7.add_argument("--source", required=True)
    j7.add_argument("--target", required=True, help="table name, or a folder with --sequence")
    j7.add_argument("--location")
    j7.add_argument("--sequence", action="store_true", help="block-compressed SequenceFile target")
    j7.add_argument("--hive-records", action="store_true", help="Hive text layout in the SequenceFile")
    j7.add_argument("--compression", help="Parquet table compression, e.g. zstd")
    j7.add_argument("--by-position", action="store_true",
                    help="pair columns by position even where names differ (types are still checked)")
    return p


def _typed(value: str):
    try:
        return int(value)
    except ValueError:
        return value


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"tablewright-{args.job}").getOrCreate()
    if args.job == "filter-csv":
        out = jobs.filter_csv_copy(spark, args.source, args.target, column=args.column,
                                   params={"value": args.value}, multiline=args.multiline)
        target = args.target
    elif args.job == "filter-table":
        values = {k: _typed(v) for k, v in _pairs(args.param).items()}
        params = [JobParam(k, "int" if isinstance(v, int) else "string") for k, v in values.items()]
        _, out = jobs.filter_copy(spark, jobs.CatalogTable(args.source),
                                  jobs.CatalogTable(args.target, args.location),
                                  predicate=args.predicate, params=params, values=values)
        target = args.target
    elif args.job == "positional":
        positions = {int(k): v for k, v in _pairs(args.position).items()}
        projected = jobs.positional_projection(spark, args.source, positions)
        write_csv(projected, args.target, header=True, sources=[args.source])
        out = read_csv_header(spark, args.target, multiline=True)
        target = args.target
    elif args.job == "limits-load":
        out = jobs.limits_load(spark, args.table, args.data_file, args.location,
                               charset=args.charset, columns=LIMITS_COLUMNS, local=args.local)
        target = args.table
    else:  # snapshot
        if args.sequence:
            dest = jobs.SequenceTable(args.target, WIDE_DOCUMENT_COLUMNS,
                                      record_format="hive" if args.hive_records else "csv")
            out = jobs.snapshot_copy(spark, args.source, dest, match_names=not args.by_position)
        else:
            out = jobs.snapshot_copy(spark, args.source, args.target, columns=WIDE_DOCUMENT_COLUMNS,
                                     location=args.location, compression=args.compression,
                                     match_names=not args.by_position)
        target = args.target
    print(f"{target}\t{out.count()} rows")
    return 0


if __name__ == "__main__":
    sys.exit(main())
