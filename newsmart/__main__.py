"""spark-submit entry point.

    land --base URI --lake URI --period 201901 [--kind export …] [--manifest URI …]
    mart --lake URI | --base URI  --period 2019 --out URI [--format csv] [querya …]
    mart --lake URI --period 2019 --format CONNECTOR --mode append --option table={mart} [querya …]
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from newsmart.plans.jobs import BUILDERS, archive_records, lake_records, store_marts
from newsmart.plans.landing import PARSERS, land_period
from newsmart.sources import read_manifest, select_period


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="newsmart")
    commands = parser.add_subparsers(dest="command", required=True)
    land = commands.add_parser("land", help="archives → Parquet lake")
    land.add_argument("--base", required=True)
    land.add_argument("--lake", required=True)
    land.add_argument("--period", required=True)
    land.add_argument("--kind", nargs="+", choices=list(PARSERS), default=list(PARSERS))
    land.add_argument("--manifest", nargs="+", default=[], help="land only what these lists promise, at its size")
    mart = commands.add_parser("mart", help="lake or archives → marts")
    source = mart.add_mutually_exclusive_group(required=True)
    source.add_argument("--lake")
    source.add_argument("--base")
    mart.add_argument("--period", required=True)
    mart.add_argument("--out", default="")
    mart.add_argument("--format", default="parquet")
    mart.add_argument("--mode", default="overwrite")
    mart.add_argument("--allow-empty", action="store_true", help="store a period without rows")
    mart.add_argument("--option", action="append", default=[], metavar="KEY=VALUE")
    mart.add_argument("names", nargs="*", metavar="mart", help=f"of {', '.join(BUILDERS)}; default all")
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName(f"newsmart-{args.command}").getOrCreate()
    if args.command == "land":
        manifest = select_period(read_manifest(spark, args.manifest), args.period) if args.manifest else None
        for kind in args.kind:
            landed = land_period(spark, args.base, args.lake, kind, args.period, manifest)
            print(f"{kind}: {len(landed.days)} days written")
            for name, problem in landed.rejected:
                print(f"{kind}: {name} left out: {problem}")
        return
    records = (lake_records(spark, args.lake, args.period) if args.lake
               else archive_records(spark, args.base, args.period))
    options = dict(option.split("=", 1) for option in args.option)
    store_marts(records, args.names or list(BUILDERS), args.out, args.format, args.mode, args.period, args.allow_empty,
                **options)


if __name__ == "__main__":
    main()
