"""Command line: build the warehouse, run a query, refresh the raw zone.

    python -m hourmart list
    python -m hourmart build --driver-tables DIR --warehouse PATH
    python -m hourmart build --raw-weather P --raw-prices P --raw-generation P --warehouse PATH
    python -m hourmart query KEY --warehouse PATH [--city NAME] [--out PATH]
    python -m hourmart refresh [--feed weather|prices|generation] --landing DIR --table PATH
"""

from __future__ import annotations

import argparse
import hashlib
import json
import sys


def _session(args):
    from hourmart.session import get_session

    return get_session(args.master)


def cmd_list(args) -> int:
    from hourmart.plans.registry import QUERIES

    for key, fn in QUERIES.items():
        doc = (fn.__doc__ or "").strip().splitlines()
        print(f"{key:45s} {doc[0] if doc else ''}")
    return 0


def cmd_build(args) -> int:
    from hourmart.sinks.writer import build_warehouse
    from hourmart.sources.catalog import DerivedTables, RawFiles

    spark = _session(args)
    if args.driver_tables:
        source = DerivedTables(spark, args.driver_tables)
    else:
        source = RawFiles(spark, {"raw_weather": args.raw_weather, "raw_prices": args.raw_prices,
                                  "raw_generation": args.raw_generation})
    counts = build_warehouse(spark, source, args.warehouse, period=args.period)
    print(json.dumps(counts))
    return 0


def cmd_query(args) -> int:
    import inspect

    from hourmart.plans.registry import QUERIES
    from hourmart.sources.catalog import StoredTables

    spark = _session(args)
    fn = QUERIES[args.key]
    t = StoredTables(spark, args.warehouse)
    if args.city and "city" not in inspect.signature(fn).parameters:
        raise SystemExit(f"{args.key} takes no city")
    df = fn(t, city=args.city) if args.city else fn(t)
    if args.out:
        df.write.mode("overwrite").parquet(args.out)
    else:
        df.show(args.rows, truncate=False)
    return 0


def cmd_refresh(args) -> int:
    from hourmart.sources.catalog import StoredTables
    from hourmart.streaming import refresh as R

    spark = _session(args)
    if args.warehouse:
        table = f"raw_{args.feed}"
        path = StoredTables(spark, args.warehouse).path(table)
        # a stream's state belongs to one landing folder and one warehouse
        name = hashlib.sha256(f"{args.landing} {path}".encode()).hexdigest()
        query = R.start_refresh(spark, args.feed, args.landing, path, R.default_checkpoint(spark, name), period=args.period,
                                multi_line=False if args.json_lines else None, warehouse=args.warehouse,
                                new_stations=args.new_stations, rejects=args.rejects)
        query.awaitTermination()
        print(StoredTables(spark, args.warehouse).table(table).count())
        return 0
    if args.feed == "weather":
        n = R.load_weather_files(spark, args.landing, args.table, period=args.period, multi_line=False if args.json_lines else None,
                                 rejects=args.rejects)
    elif args.feed == "prices":
        n = R.load_price_files(spark, args.landing, args.table, period=args.period, rejects=args.rejects)
    else:
        n = R.load_generation_files(spark, args.landing, args.table, period=args.period, rejects=args.rejects)
    print(n)
    return 0


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="hourmart")
    p.add_argument("--master", default=None, help="Spark master (default: the submitting environment's)")
    sub = p.add_subparsers(dest="cmd", required=True)

    sub.add_parser("list", help="registered queries")

    b = sub.add_parser("build", help="raw -> cleaned -> star warehouse")
    b.add_argument("--warehouse", required=True)
    b.add_argument("--driver-tables")
    b.add_argument("--raw-weather")
    b.add_argument("--raw-prices")
    b.add_argument("--raw-generation")
    b.add_argument("--period", default="year", choices=["year", "month", "date"])

    q = sub.add_parser("query", help="run one registered query on a stored warehouse")
    q.add_argument("key")
    q.add_argument("--warehouse", required=True)
    q.add_argument("--city")
    q.add_argument("--out")
    q.add_argument("--rows", type=int, default=50)

    r = sub.add_parser("refresh", help="merge a day's landed feed into its raw table")
    r.add_argument("--feed", default="weather", choices=["weather", "prices", "generation"])
    r.add_argument("--landing", required=True)
    r.add_argument("--table", help="the raw table alone")
    r.add_argument("--warehouse", help="a whole warehouse: cleaned and star tables follow")
    r.add_argument("--rejects", help="table for bad responses; without it one stops the refresh")
    r.add_argument("--new-stations", default="renumber", choices=["renumber", "append"])
    r.add_argument("--period", default=None, choices=["year", "month", "date"])
    r.add_argument("--json-lines", action="store_true")

    args = p.parse_args(argv)
    if args.cmd == "build" and not args.driver_tables and not all(
            [args.raw_weather, args.raw_prices, args.raw_generation]):
        p.error("build needs --driver-tables or all three --raw-* paths")
    if args.cmd == "refresh" and bool(args.table) == bool(args.warehouse):
        p.error("refresh needs either --table or --warehouse")
    return {"list": cmd_list, "build": cmd_build, "query": cmd_query, "refresh": cmd_refresh}[args.cmd](args)


if __name__ == "__main__":
    sys.exit(main())
