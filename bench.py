"""Benchmark: the batch medallion pipeline and the KYC stream at one scale.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Phases, timed on a warm session (wall clock):

* ``phase_bronze_silver`` -- for each of the six tables: adapter joins +
  faults written as bronze parquet, then derivations + rules + filter written
  as silver parquet with the rule counters observed on the same write. The six
  chains are independent and run as concurrent jobs.
* ``phase_gold`` -- the 20 gold tables from silver parquet, concurrently.
* ``share_broadcast`` / ``share_window`` -- WIN1 in both forms over bronze
  holdings (the window form moves every row through one task).
* ``stream_kyc`` -- events -> bronze -> silver with ``availableNow``.
* ``skew_hot_key`` (reported apart, not in ``value``) -- a third of silver
  holdings and a third of silver profiles re-keyed to one client name, then
  ``client_portfolio_performance`` through the adaptive join aggregation: the
  literal join would emit ~7e8 pairs at sf0.1; the pair-free plan does not.

``queries`` holds the duration of every step (steps of one phase overlap);
the gold phase runs ``BENCH_REPEAT`` times (default 3) and reports medians.
``value`` is the wall time of all phases together. Shuffle bytes written and
bytes spilled per phase come from Spark's event log, written to the scratch
folder (no UI or server is involved).
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from tessera.operators import quality  # noqa: E402
from tessera.operators.joins import join_aggregate, join_stats  # noqa: E402
from tessera.operators.share import with_share, with_share_window  # noqa: E402
from tessera.plans import gold, pipeline  # noqa: E402
from tessera.plans.bronze import bronze  # noqa: E402
from tessera.session import build_session, fresh_path  # noqa: E402
from tessera.sources import schemas  # noqa: E402
from tessera.streaming import kyc_stream  # noqa: E402

BATCH_AS_OF = "2002-01-01"
TABLES = ("holdings", "market", "transactions", "profiles", "kyc", "purchases")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    workers = int(os.environ.get("BENCH_WORKERS", str(cpus)))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    import tempfile

    log_dir = tempfile.mkdtemp(prefix="tessera-bench-events-")
    spark = build_session(
        master=f"local[{cpus}]",
        shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(max(8, cpus * 2)))),
        app_name="tessera-bench",
        extra_conf={
            "spark.eventLog.enabled": "true",
            "spark.eventLog.dir": log_dir,
            "spark.eventLog.compress": "false",
            "spark.scheduler.mode": os.environ.get("BENCH_SCHEDULER", "FAIR"),
        },
    )
    root = fresh_path(spark, "bench")
    times: dict[str, float] = {}
    phases: dict[str, float] = {}
    rule_counts: dict[str, dict] = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        out = fn()
        times[name] = round(time.perf_counter() - t0, 3)
        return out

    def phase(name, fn):
        spark.sparkContext.setJobGroup(f"phase:{name}", name)
        t0 = time.perf_counter()
        fn()
        phases[name] = round(time.perf_counter() - t0, 3)

    # warm-up: JIT, file listing, codegen caches (not counted)
    bronze(spark, sf_dir, "kyc").write.mode("overwrite").parquet(f"{root}/warmup")

    def chain(t):
        def run():
            bpath, spath = f"{root}/bronze/{t}", f"{root}/silver/{t}"
            timed(f"bronze_{t}", lambda: bronze(spark, sf_dir, t).write.parquet(bpath))
            b = spark.read.schema(schemas.BRONZE[t]).parquet(bpath)
            as_of = BATCH_AS_OF if t in pipeline.BATCH_TABLES else None
            derived, obs = quality.observe_rules(pipeline.DERIVE[t](b, as_of), quality.RULES[t], t)
            timed(f"silver_{t}", lambda: quality.enforce(derived, quality.RULES[t]).write.parquet(spath))
            rule_counts[t] = obs.get
        return run

    # longest chains first
    order = ("market", "holdings", "transactions", "profiles", "kyc", "purchases")
    phase("phase_bronze_silver",
          lambda: pipeline.run_concurrently(spark, {t: chain(t) for t in order}, workers))
    silver_df = {t: spark.read.parquet(f"{root}/silver/{t}") for t in TABLES}

    def gold_job(name, run):
        return lambda: timed(f"gold_{name}#{run}",
                             lambda: gold.build(name, silver_df).write.parquet(f"{root}/gold{run}/{name}"))

    gold_walls = []
    for run in range(repeat):
        phase(f"phase_gold#{run}", lambda r=run: pipeline.run_concurrently(
            spark, {n: gold_job(n, r) for n in gold.build_order()}, workers))
        gold_walls.append(phases.pop(f"phase_gold#{run}"))
    phases["phase_gold"] = round(statistics.median(gold_walls), 3)
    for n in gold.SPECS:
        runs = [times.pop(f"gold_{n}#{r}") for r in range(repeat)]
        times[f"gold_{n}"] = round(statistics.median(runs), 3)

    hb = spark.read.schema(schemas.BRONZE["holdings"]).parquet(f"{root}/bronze/holdings")
    phase("share_broadcast", lambda: timed(
        "share_broadcast", lambda: with_share(hb, "market_value", "s").agg(F.sum("s")).collect()))
    phase("share_window", lambda: timed(
        "share_window", lambda: with_share_window(hb, "market_value", "s").agg(F.sum("s")).collect()))
    phase("stream_kyc", lambda: timed(
        "stream_kyc", lambda: kyc_stream.run_pipeline(spark, sf_dir, f"{root}/stream")))

    # hot-key demonstration on data derived from the silver tables
    def hot(df, key):
        return df.withColumn("client_name_clean", F.when(
            F.pmod(F.xxhash64(key), F.lit(3)) == 0, F.lit("HOT")).otherwise(F.col("client_name_clean")))

    spark.sparkContext.setJobGroup("phase:skew_hot_key", "skew_hot_key")
    hs, ps = hot(silver_df["holdings"], "holding_id"), hot(silver_df["profiles"], "client_id")
    spec = gold.SPECS["client_portfolio_performance"]
    skew_pairs = join_stats(hs, ps, spec.on)["pairs"]
    skew = {}
    for run in range(2):  # first run warms the code paths
        t0 = time.perf_counter()
        join_aggregate(hs, ps, spec.on, spec.keys, spec.measures, ("h", "p"), spec.order).write.mode(
            "overwrite").parquet(f"{root}/skew")
        skew[f"run{run}"] = round(time.perf_counter() - t0, 3)
    skew["logical_pairs"] = skew_pairs

    spark.sparkContext.setJobGroup("other", "other")
    stream_rows = spark.read.parquet(f"{root}/stream/bronze").count()
    rows_per_sec = round(stream_rows / max(times["stream_kyc"], 1e-9), 1)
    spark.stop()
    out = {
        "metric": "pipeline_wall_sec",
        "value": round(sum(phases.values()), 3),
        "unit": "sec",
        "queries": times,
        "phases": phases,
        "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
        "cpus": cpus,
        "workers": workers,
        "gold_phase_runs": gold_walls,
        "stream_kyc_rows_per_sec": rows_per_sec,
        "skew_hot_key": skew,
        "shuffle_and_spill_bytes": _io_by_phase(log_dir),
        "rows_failed": {t: {k: v for k, v in c.items() if v} for t, c in rule_counts.items()},
    }
    print(json.dumps(out))


def _io_by_phase(log_dir: str) -> dict[str, dict[str, int]]:
    """Sum shuffle-write and spill bytes of finished tasks per job group."""
    stage_group: dict[int, str] = {}
    out: dict[str, dict[str, int]] = {}
    for path in glob.glob(f"{log_dir}/**/*", recursive=True):
        if os.path.isdir(path):
            continue
        with open(path, errors="replace") as fh:
            for line in fh:
                try:
                    e = json.loads(line)
                except ValueError:
                    continue
                kind = e.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (e.get("Properties") or {}).get("spark.jobGroup.id", "other")
                    for sid in e.get("Stage IDs", []):
                        stage_group[sid] = group.replace("phase:", "").split("#")[0]
                elif kind == "SparkListenerTaskEnd":
                    m = e.get("Task Metrics") or {}
                    g = out.setdefault(stage_group.get(e.get("Stage ID"), "other"),
                                       {"shuffle_write": 0, "spill_memory": 0, "spill_disk": 0})
                    g["shuffle_write"] += (m.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0)
                    g["spill_memory"] += m.get("Memory Bytes Spilled", 0)
                    g["spill_disk"] += m.get("Disk Bytes Spilled", 0)
    return out


if __name__ == "__main__":
    main()
