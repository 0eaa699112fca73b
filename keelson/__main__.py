"""Command line: the two batch programs.

    python -m keelson load --hull H7001 --start 2025-11-03 --end 2025-11-09 [--clear]
    python -m keelson sync-catalog --path catalogs/tugs.csv --catalog <folder>

``load`` reads ``<catalog-dir>/<hull>_metadata.csv``, scans the catalogued source
tables (database named in the catalog) for the inclusive date range, and upserts
the raw and calc tables: catalog tables ``<db>.<hull>_raw`` / ``<db>.<hull>_calc``
by default, or Parquet folders ``<storage>/<hull>/raw`` and ``.../calc`` with
``--storage``. ``--clear`` drops both targets first (stored history is lost).
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from keelson.plans.jobs import run_hull, sync_catalog_file
from keelson.session import build_session, prepare
from keelson.sources.scans import table_reader
from keelson.sources.tagcatalog import catalog_rows, read_catalog, validate


def _day(text: str) -> str:
    return dt.datetime.strptime(text, "%Y-%m-%d").strftime("%Y%m%d")


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="python -m keelson", description=__doc__.split("\n\n")[0])
    sub = p.add_subparsers(dest="command", required=True)
    load = sub.add_parser("load", help="load a date range of one hull into its raw and calc tables")
    load.add_argument("--hull", required=True, help="hull id, e.g. H7001")
    load.add_argument("--start", required=True, type=_day, help="first day, YYYY-MM-DD")
    load.add_argument("--end", required=True, type=_day, help="last day (included), YYYY-MM-DD")
    load.add_argument("--catalog-dir", default="resources/csv", help="folder of <hull>_metadata.csv files")
    load.add_argument("--db", default="dv", help="database of the raw / calc tables (catalog-table targets)")
    load.add_argument("--storage", help="root folder for Parquet targets instead of catalog tables")
    load.add_argument("--every", default="15 seconds", help="bucket width")
    load.add_argument("--table-format", default="parquet", choices=("parquet", "iceberg", "delta"),
                      help="format of catalog-table targets (iceberg / delta need that format's catalog)")
    load.add_argument("-c", "--clear", action="store_true", help="drop the hull's raw and calc targets first")
    sync = sub.add_parser("sync-catalog", help="bring the stored tag catalog in line with one catalog file")
    sync.add_argument("--path", required=True, help="catalog CSV of one hull, or a folder of them (one hull per file)")
    sync.add_argument("--catalog", required=True, help="folder of the stored catalog (Parquet, by hull)")
    return p.parse_args(argv)


def main(argv: list[str] | None = None, spark=None) -> int:
    args = parse_args(argv)
    spark = prepare(spark) if spark is not None else build_session()
    if args.command == "sync-catalog":
        print(f"catalog of {sync_catalog_file(spark, args.path, args.catalog)} synchronised")
        return 0
    hull = args.hull.strip().upper()
    tags = catalog_rows(read_catalog(spark, f"{args.catalog_dir}/{hull}_metadata.csv"))
    if validate(tags) != hull:
        raise SystemExit(f"catalog file describes {validate(tags)}, not {hull}")
    read = table_reader(spark, tags[0].db_name)
    if args.storage:
        base = f"{args.storage.rstrip('/')}/{hull}"
        run_hull(spark, read, tags, args.start, args.end, raw_path=f"{base}/raw", calc_path=f"{base}/calc",
                 every=args.every, clear=args.clear)
    else:
        name = hull.lower()
        run_hull(spark, read, tags, args.start, args.end, raw_table=f"{args.db}.{name}_raw",
                 calc_table=f"{args.db}.{name}_calc", every=args.every, clear=args.clear,
                 table_format=args.table_format)
    print(f"{hull}: {args.start}..{args.end} loaded")
    return 0


if __name__ == "__main__":
    sys.exit(main())
