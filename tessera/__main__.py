"""Command line: run the layered batch job or the KYC stream.

    spark-submit -m tessera batch --tables <dir> --out <dir> [--as-of 2002-01-01]
    python -m tessera batch --local --tables /root/testdata/sf0.01 --out /tmp/run
    python -m tessera stream-kyc --tables <dir> --out <dir>

Under spark-submit the session (master, executors, ``spark.checkpoint.dir``)
comes from the cluster configuration; ``--local`` builds a local session.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from tessera.plans import pipeline
from tessera.session import build_session, tune
from tessera.streaming import kyc_stream, purchase_stream


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="tessera")
    ap.add_argument("job", choices=["batch", "stream-kyc", "stream-purchases"])
    ap.add_argument("--tables", required=True, help="folder holding the supplied parquet tables")
    ap.add_argument("--out", required=True, help="output root (a shared folder on a cluster)")
    ap.add_argument("--as-of", default=None, help="reference date for ages (default: now)")
    ap.add_argument("--workers", type=int, default=4, help="concurrent table builds per layer")
    ap.add_argument("--local", action="store_true", help="build a local[*] session")
    ap.add_argument("--tune", action="store_true", help="size partitions from the input volume")
    args = ap.parse_args(argv)

    spark = build_session(master="local[*]") if args.local else SparkSession.builder.appName("tessera").getOrCreate()
    if args.tune:
        tune(spark, args.tables)
    if args.job == "batch":
        paths = pipeline.run_batch(spark, args.tables, args.out, as_of=args.as_of, max_workers=args.workers)
    elif args.job == "stream-kyc":
        paths = kyc_stream.publish(spark, args.tables, args.out)
    else:
        paths = purchase_stream.publish(spark, args.tables, args.out)
    print(json.dumps(paths, indent=1))


if __name__ == "__main__":
    main()
