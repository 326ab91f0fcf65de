"""KYC feed: STR1 (bronze -> silver, stateless, append), STR2 (gold tables
recomputed over the silver sink) and EXT1 (event-time hourly metrics)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import quality
from tessera.operators.aggregate import avg, cd, grouped, n
from tessera.plans import gold, silver
from tessera.plans.bronze import finish
from tessera.session import fresh_path
from tessera.sources import adapters, schemas
from tessera.streaming import checked, event_time, merged
from tessera.streaming.common import event_stream, file_stream, run_to_parquet
from tessera.streaming.incremental import refresh_dates, run_date_refresh

HOURLY = (
    n("kyc_records_processed"), cd("unique_customers", "customer_id"),
    avg("avg_annual_income", "annual_income", 2), avg("avg_net_worth", "net_worth", 2),
)


def bronze_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """BRZ5: events -> KYC bronze, with the (deterministic) fault rules."""
    return finish(adapters.kyc_from_events(event_stream(spark, sf_dir)), "kyc", faults=True)


def run_pipeline(
    spark: SparkSession, sf_dir: str, root: str | None = None, partition_silver: bool = False
) -> dict:
    """Events -> bronze sink -> SLV5 per record (no state): silver, rejected rows
    and rule counters (``streaming.checked``); returns the paths and, as
    ``quality``, the counters over all batches. ``partition_silver`` writes the
    silver table in ``processing_date`` folders (needed by
    ``run_incremental_gold``)."""
    root = root or fresh_path(spark, "kyc-stream")
    bronze_path = f"{root}/bronze"
    run_to_parquet(bronze_stream(spark, sf_dir), bronze_path, f"{root}/_checkpoints/bronze")
    derived = silver.derive_kyc(file_stream(spark, bronze_path, schemas.KYC))
    paths = checked.run(derived, quality.KYC, "kyc", root, f"{root}/_checkpoints/silver",
                        ["processing_date"] if partition_silver else [])
    totals = checked.counts(spark, paths["counters"]).collect()  # a row for each rule
    counters = {r.rule: r.failed_count for r in totals} | {"total_count": max((r.total_count for r in totals), default=0)}
    return {"bronze": bronze_path, **paths, "quality": counters}


def run_incremental_gold(
    spark: SparkSession, sf_dir: str, root: str | None = None, name: str = "realtime_kyc_metrics"
) -> str:
    """STR2 without full recomputation for a date-keyed gold table: a second
    stream over the date-partitioned silver sink refreshes only the dates
    each micro-batch touched (see ``streaming.incremental``)."""
    root = root or fresh_path(spark, "kyc-incremental")
    paths = run_pipeline(spark, sf_dir, root, partition_silver=True)
    gold_path = f"{root}/gold/{name}"
    run_date_refresh(spark, paths["silver"], gold_path, name, "kyc", f"{root}/_checkpoints/gold_{name}")
    return gold_path


def publish(spark: SparkSession, sf_dir: str, root: str) -> dict:
    """The whole feed: sinks as ``run_pipeline`` writes them, then every KYC
    gold table once over the silver sink."""
    paths = run_pipeline(spark, sf_dir, root)
    rows = checked.read(spark, paths["silver"])
    paths["gold"] = {}
    for name, spec in gold.SPECS.items():
        if spec.inputs == ("kyc",):
            paths["gold"][name] = f"{root}/gold/{name}"
            gold.build(name, {"kyc": rows}).write.mode("overwrite").parquet(paths["gold"][name])
    return paths


def run_silver(spark: SparkSession, sf_dir: str, root: str | None = None) -> DataFrame:
    paths = run_pipeline(spark, sf_dir, root)
    return checked.read(spark, paths["silver"])


def run_rejected(spark: SparkSession, sf_dir: str, root: str | None = None) -> DataFrame:
    """RA4 on the stream: the rows silver does not take, with the rules they fail."""
    return checked.read(spark, run_pipeline(spark, sf_dir, root)["rejected"])


def run_counters(spark: SparkSession, sf_dir: str, root: str | None = None) -> DataFrame:
    """RA3 on the stream: the rules' counters over all micro-batches."""
    return checked.counts(spark, run_pipeline(spark, sf_dir, root)["counters"])


def run_merged(spark: SparkSession, sf_dir: str, name: str, root: str | None = None) -> DataFrame:
    """STR2 from mergeable state: a run costs its new rows, whatever the keys."""
    root = root or fresh_path(spark, "kyc-merged")
    silver_path = run_pipeline(spark, sf_dir, root)["silver"]
    merged.run(spark, silver_path, f"{root}/state", "kyc", f"{root}/_checkpoints/state")
    return merged.table(spark, silver_path, f"{root}/state", "kyc", name)


def run_gold(spark: SparkSession, sf_dir: str, name: str, root: str | None = None) -> DataFrame:
    """STR2: a gold table recomputed in batch over the streaming silver sink
    (exact distinct counts are not available on a stream)."""
    return gold.build(name, {"kyc": run_silver(spark, sf_dir, root)})


def hourly(silver_rows: DataFrame) -> DataFrame:
    """EXT1: KYC metrics by event hour, exact for any order of files."""
    ts = F.col("kyc_timestamp").cast("timestamp")
    rows = silver_rows.withColumn("window_start", F.date_trunc("hour", ts))
    return grouped(rows, ["window_start"], HOURLY)


def run_hourly(spark: SparkSession, sf_dir: str, root: str | None = None) -> DataFrame:
    """``hourly`` over the streaming silver sink."""
    return hourly(run_silver(spark, sf_dir, root))


def run_event_time(spark: SparkSession, sf_dir: str, root: str | None = None, max_files: int = 4) -> DataFrame:
    """EXT1 as an event-time stream over silver in date folders, a few files per
    micro-batch (``streaming.event_time``)."""
    root = root or fresh_path(spark, "kyc-event-time")
    silver_path = run_pipeline(spark, sf_dir, root, partition_silver=True)["silver"]
    return event_time.run(
        spark, silver_path, f"{root}/event-time", "kyc_timestamp", "customer_id",
        [("avg_annual_income", "annual_income", 2), ("avg_net_worth", "net_worth", 2)], max_files=max_files)


__all__ = [
    "bronze_stream",
    "refresh_dates",
    "run_incremental_gold",
    "hourly",
    "run_gold",
    "run_hourly",
    "run_pipeline",
    "run_silver",
]
