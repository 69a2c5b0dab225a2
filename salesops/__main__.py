"""python -m salesops clean RAW CLEAN --audit FOLDER | load CLEAN TABLES | report TABLES [NAME ...] --out FOLDER"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession

from salesops.operators.integrity import IntegrityError
from salesops.plans import model, verify
from salesops.plans.clean import clean_model
from salesops.plans.reports import REPORTS
from salesops.session import build_session, clear_scratch, size_for
from salesops.sources import (
    bucket_number,
    discard,
    load_catalog,
    lost_in_catalog,
    open_set,
    open_tables,
    publish,
    read_catalog,
    rebuild,
    register_tables,
    staging_folder,
)


PREVIEW = 20


def _preview(result: DataFrame, path: str) -> None:
    """The first rows on the screen; all of them are in the table at ``path``."""
    print(f"first {PREVIEW} rows; all rows are in {path}")
    result.show(PREVIEW, truncate=False)


def _check_lost(lost: DataFrame, allowed: bool) -> None:
    """Values that typing would turn into NULL: one row per column that has any."""
    found = lost.orderBy("table", "column").collect()
    text = "; ".join(f"{r['table']}.{r['column']}: {r['lost']}" for r in found)
    if found and not allowed:
        raise IntegrityError(f"values that do not fit their type: {text}")
    if found:
        print(f"lost values: {text}", file=sys.stderr)


def _load(spark: SparkSession, clean: str, tables: str, buckets: int) -> None:
    """Typed tables beside the current ones, checked there, and published only if every constraint holds."""
    layout = {name: {"key": key, "buckets": buckets} for name, key in model.BUCKET_KEYS.items()}
    staged = staging_folder(tables)
    try:
        for name, rows in rebuild(load_catalog(spark, clean, model.SCHEMAS, model.DEFAULTS), staged, layout=layout).items():
            print(f"{name}: {rows} rows")
        verify.require_constraints(verify.constraint_report(open_set(spark, staged, model.SCHEMAS, layout)))
        publish(spark, tables, staged, layout)
    except BaseException:
        discard(spark, staged)
        raise


def main() -> int:
    parser = argparse.ArgumentParser(prog="salesops", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    clean = commands.add_parser("clean", help="raw CSV folder -> clean CSV folder")
    clean.add_argument("raw")
    clean.add_argument("clean")
    clean.add_argument("--audit", required=True, help="folder for the audit log, as a table")
    load = commands.add_parser("load", help="clean CSV folder -> typed tables, every constraint checked")
    load.add_argument("clean")
    load.add_argument("tables")
    load.add_argument("--allow-lost", action="store_true", help="go on where texts do not fit their column's type")
    report = commands.add_parser("report", help="answer the business questions")
    report.add_argument("tables")
    report.add_argument("names", nargs="*", choices=[[], *REPORTS])
    report.add_argument("--out", required=True, help="folder for the complete results, a table per report")
    args = parser.parse_args()

    spark = build_session()
    try:
        if args.command == "clean":
            size_for(spark, args.raw)
            tables, audit = clean_model(read_catalog(spark, args.raw, ordinal=True))
            rebuild(tables, args.clean, "csv")
            audit.write.mode("overwrite").parquet(args.audit)
            _preview(spark.read.parquet(args.audit).orderBy("step", "table", "metric"), args.audit)
        elif args.command == "load":
            size = size_for(spark, args.clean)
            _check_lost(lost_in_catalog(spark, args.clean, model.SCHEMAS), args.allow_lost)
            _load(spark, args.clean, args.tables, bucket_number(size, spark.sparkContext.defaultParallelism))
        else:
            size_for(spark, args.tables)
            tables = open_tables(spark, args.tables, model.SCHEMAS)
            register_tables(tables)
            for name in args.names or REPORTS:
                path = f"{args.out.rstrip('/')}/{name}.parquet"
                result = REPORTS[name](tables)
                result.write.mode("overwrite").parquet(path)
                print(name)
                _preview(result, path)
    except IntegrityError as error:
        print(error, file=sys.stderr)
        return 1
    finally:
        clear_scratch(spark)
    return 0


if __name__ == "__main__":
    sys.exit(main())
