"""Command line: run the layers, the extracts and the gold refresh.

    python -m strata.cli medallion --source LANDING --target LAKE [--format json]
                                   [--trigger availableNow|processingTime] [--interval "1 minute"]
    python -m strata.cli gold --silver LAKE/silver --target LAKE/gold [--per-table]
    python -m strata.cli extract --source SONGS_PARQUET --out DIR
                                 --kind complete|recent|top-artists|sample [--single-file]
    python -m strata.cli probe --source SONGS_PARQUET

The session comes from the environment (``spark-submit`` settings on a
cluster); ``--master`` is only for local runs.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def _session(master: str | None) -> SparkSession:
    from strata.session import apply_defaults
    builder = SparkSession.builder.appName("strata")
    if master:                      # local runs: no web UI
        builder = builder.master(master).config("spark.ui.enabled", "false")
    return apply_defaults(builder.getOrCreate())


def register_layers(spark: SparkSession, silver_path: str, gold_root: str | None = None,
                    bronze_path: str | None = None) -> list[str]:
    """Expose the layers to SQL as temporary views (songs_bronze, songs_silver,
    and every gold table found under ``gold_root``)."""
    from strata.plans.gold import GOLD_TABLES
    from strata.sinks import versions
    names = []
    if bronze_path:
        spark.read.parquet(bronze_path).createOrReplaceTempView("songs_bronze")
        names.append("songs_bronze")
    spark.read.parquet(silver_path).createOrReplaceTempView("songs_silver")
    names.append("songs_silver")
    for name in GOLD_TABLES if gold_root else []:
        try:
            table = versions.read(spark, f"{gold_root.rstrip('/')}/{name}")
        except FileNotFoundError:
            continue                      # not refreshed yet
        table.createOrReplaceTempView(name)
        names.append(name)
    return names


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="strata", description="Layered song analytics on Spark.")
    ap.add_argument("--master", default=None)
    sub = ap.add_subparsers(dest="cmd", required=True)

    m = sub.add_parser("medallion", help="landed files -> bronze -> silver streams (+ gold)")
    m.add_argument("--source", required=True)
    m.add_argument("--target", required=True)
    m.add_argument("--format", default="json")
    m.add_argument("--trigger", default="availableNow", choices=["availableNow", "processingTime"])
    m.add_argument("--interval", default="1 minute")
    m.add_argument("--max-files-per-trigger", type=int, default=None)
    m.add_argument("--max-bytes-per-trigger", type=int, default=None)
    m.add_argument("--incremental-gold", action="store_true")

    g = sub.add_parser("gold", help="recompute the seven gold tables from silver")
    g.add_argument("--silver", required=True)
    g.add_argument("--target", required=True)
    g.add_argument("--per-table", action="store_true")

    x = sub.add_parser("extract", help="write a JSON extract of a songs Parquet source")
    x.add_argument("--source", required=True)
    x.add_argument("--out", required=True)
    x.add_argument("--kind", required=True, choices=["complete", "recent", "top-artists", "sample"])
    x.add_argument("--single-file", action="store_true")
    x.add_argument("--seed", type=int, default=None)

    p = sub.add_parser("probe", help="rows, files, first and last file of a Parquet source")
    p.add_argument("--source", required=True)

    args = ap.parse_args(argv)
    spark = _session(args.master)

    if args.cmd == "medallion":
        from strata.streaming.layers import run_medallion
        res = run_medallion(spark, args.source, args.target, fmt=args.format,
                            trigger=args.trigger, max_files_per_trigger=args.max_files_per_trigger,
                            max_bytes_per_trigger=args.max_bytes_per_trigger,
                            incremental_gold=args.incremental_gold, interval=args.interval)
        if args.trigger == "processingTime":
            for q in res["queries"]:
                q.awaitTermination()
        print(json.dumps({"paths": res["paths"], "expectations": res.get("expectations", {})}))
    elif args.cmd == "gold":
        from strata.streaming.layers import refresh_gold
        print(json.dumps(refresh_gold(spark, args.silver, args.target,
                                      shared_scan=not args.per_table)))
    elif args.cmd == "extract":
        from strata.plans import extracts as X
        from strata.sinks.files import write_json, write_partitioned_json
        from strata.sources.files import read_parquet
        songs = read_parquet(spark, args.source, with_source_file=args.kind == "complete")
        if args.kind == "complete":
            write_json(X.extract_complete(songs, source_file=F.col("source_file")), args.out,
                       single_file=args.single_file)
        elif args.kind == "recent":
            write_partitioned_json(X.extract_recent(songs), args.out, "year")
        elif args.kind == "top-artists":
            write_partitioned_json(X.extract_top_artists(songs), args.out, "artist_name")
        else:
            write_json(X.extract_sample(songs, seed=args.seed), args.out,
                       single_file=args.single_file)
        print(json.dumps({"written": args.out}))
    elif args.cmd == "probe":
        from strata.plans.extracts import source_probe
        from strata.sources.files import read_parquet
        row = source_probe(read_parquet(spark, args.source, with_source_file=True)).first()
        print(json.dumps(row.asDict(), default=str))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
