"""Command line: ``python -m tillbook build|land --input DIR --out DIR``."""

from __future__ import annotations

import argparse
import json


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="tillbook")
    ap.add_argument("command", choices=["build", "land", "macro"])
    ap.add_argument("--input", help="folder with the source tables (Parquet); build and land")
    ap.add_argument("--out", required=True, help="output folder (shared storage on a cluster)")
    ap.add_argument("--telemetry", help="run telemetry table (default <out>/ops/run_telemetry)")
    ap.add_argument("--master", default=None, help="Spark master for a local run, e.g. local[8]")
    ap.add_argument("--from-bronze", action="store_true", help="--input holds landed Bronze tables")
    ap.add_argument("--assumptions", help="build: CSV seed of thresholds and rates")
    ap.add_argument("--now", default=None, help="run clock (ISO time; default: current time) for freshness/heartbeat")
    ap.add_argument("--cbp", help="macro: landed CBP county text file")
    ap.add_argument("--cpi", help="macro: landed BLS response body (JSON)")
    ap.add_argument("--fred", nargs="*", default=[], help="macro: SERIES=path of landed FRED bodies")
    ap.add_argument("--frps-cells", help="macro: FRPS Table 1 cell rows (Parquet)")
    args = ap.parse_args(argv)
    from datetime import datetime
    now = datetime.fromisoformat(args.now) if args.now else datetime.now().replace(microsecond=0)

    from pyspark.sql import SparkSession
    from tillbook.session import build_session, ensure_checkpoint_dir

    if args.master:
        spark = build_session(args.master)
    else:
        spark = SparkSession.builder.getOrCreate()
        ensure_checkpoint_dir(spark)
    if args.command == "build":
        from tillbook.plans.build import BuildFailed, daily_build
        try:
            res = daily_build(spark, args.input, args.out, args.telemetry or f"{args.out}/ops/run_telemetry",
                              now=now, from_bronze=args.from_bronze, assumptions_path=args.assumptions)
        except BuildFailed as exc:
            print(json.dumps({"nodes": len(exc.results), "failed": exc.failed}))
            raise SystemExit(1) from exc
        print(json.dumps({"nodes": len(res), "failed": []}))
    elif args.command == "macro":
        import uuid

        from tillbook.sources import macro
        fred = dict(x.split("=", 1) for x in args.fred) or None
        cells = spark.read.parquet(args.frps_cells) if args.frps_cells else None
        out = macro.land_all(spark, f"{args.out}/bronze", str(uuid.uuid4()), now, cbp_path=args.cbp,
                             cpi_path=args.cpi, fred_paths=fred, frps_cells=cells)
        print(json.dumps(out))
    else:
        from tillbook.plans.build import land_bronze
        from tillbook.plans.pipeline import Pipeline
        rows = land_bronze(Pipeline(spark, args.input), f"{args.out}/bronze", now=now)
        print(json.dumps({r.table: r.row_count for r in rows}))


if __name__ == "__main__":
    main()
