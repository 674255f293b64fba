"""python -m atlasmill run | verify | replay | intent: the pipeline over a registry of saved sources."""

from __future__ import annotations

import argparse
import json
import sys
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from atlasmill.functions.intent import intent, vocabulary
from atlasmill.plans.pipeline import Request, replay, run, verify_run, write_run
from atlasmill.sources.records import collect
from atlasmill.sources.registry import load_registry
from atlasmill.sources.taxonomy import taxonomy


def read_sources(spark: SparkSession, registry: str, chosen: list[str] | None) -> tuple[DataFrame, DataFrame]:
    """(records, registry rows) of the chosen sources; an unknown or empty choice is an error. Paths are relative to the registry."""
    table = load_registry(spark, registry)
    rows = [r for r in table.collect() if not chosen or r["name"] in chosen]
    unknown = set(chosen or ()) - {r["name"] for r in rows}
    if unknown or not rows:
        raise ValueError(f"unknown sources: {sorted(unknown)}" if unknown else "no sources")
    parts = [collect(spark, r["kind"], str(Path(registry).parent / r["path"]), r["name"]) for r in rows if r["path"]]
    return reduce(DataFrame.unionByName, parts), table.filter(table["name"].isin([r["name"] for r in rows]))


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="atlasmill", description=__doc__)
    sub = p.add_subparsers(dest="command", required=True)
    r = sub.add_parser("run")
    r.add_argument("--registry", required=True)
    r.add_argument("--sources", nargs="*")
    r.add_argument("--categories", nargs="+", required=True)
    r.add_argument("--use", default="internal")
    where = r.add_mutually_exclusive_group(required=True)
    where.add_argument("--box", nargs=4, type=float, metavar=("S", "W", "N", "E"))
    where.add_argument("--area", help="a GeoJSON file")
    r.add_argument("--previous", help="a saved run whose ids are kept")
    r.add_argument("--out", required=True)
    for name in ("verify", "replay"):
        sub.add_parser(name).add_argument("path")
    sub.add_parser("intent").add_argument("text")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    """Exit code: 0 done, 1 a check failed, 2 a bad request."""
    args = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("atlasmill").getOrCreate()
    leaves = taxonomy(spark)
    try:
        if args.command == "intent":
            words = vocabulary([(r["id"], r["label_en"]) for r in leaves.select("id", "label_en").collect()])
            print(json.dumps(intent(args.text, words), ensure_ascii=False))
        elif args.command == "verify":
            changed = verify_run(spark, args.path)
            print(json.dumps({"intact": not changed, "changed": changed}))
            return int(bool(changed))
        elif args.command == "replay":
            same = replay(spark, args.path, leaves)
            print(json.dumps({"identical": same}))
            return int(not same)
        else:
            previous = None
            if args.previous:
                if verify_run(spark, args.previous):
                    raise ValueError("the previous run is not intact")
                previous = spark.read.parquet(f"{args.previous}/records")
            known = tuple(r["id"] for r in leaves.select("id").collect())
            area = Path(args.area).read_text(encoding="utf-8") if args.area else tuple(args.box)
            raw, registry = read_sources(spark, args.registry, args.sources)
            result = run(raw, registry, leaves, Request(area, tuple(args.categories), args.use, known=known), previous)
            write_run(result, args.out)
            print(json.dumps({"status": "completed", "out": args.out, "places": spark.read.parquet(f"{args.out}/records").count()}))
    except ValueError as e:
        print(json.dumps({"status": "failed", "reason": str(e)}), file=sys.stderr)
        return 2
    return 0


if __name__ == "__main__":
    sys.exit(main())
