"""Purchase feed: BRZ6 as a stream into a bronze sink; SLV6 and AGG18-20 are
batch reads of that sink (the purchase silver table is recomputed from the
whole stream table, not incrementally)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.operators import quality
from tessera.plans import gold, silver
from tessera.plans.bronze import finish
from tessera.session import fresh_path
from tessera.sources import adapters, schemas
from tessera.streaming import checked, merged
from tessera.streaming.common import event_stream, file_stream, run_to_parquet
from tessera.streaming.incremental import run_date_refresh


def bronze_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finish(adapters.purchases_from_events(event_stream(spark, sf_dir)), "purchases", faults=False)


def run_bronze(spark: SparkSession, sf_dir: str, root: str | None = None) -> str:
    root = root or fresh_path(spark, "purchase-stream")
    sink = f"{root}/bronze"
    run_to_parquet(bronze_stream(spark, sf_dir), sink, f"{root}/_checkpoints/bronze")
    return sink


def run_silver(spark: SparkSession, sf_dir: str, root: str | None = None) -> DataFrame:
    sink = run_bronze(spark, sf_dir, root)
    return silver.purchases(spark.read.schema(schemas.PURCHASES).parquet(sink))


def publish(spark: SparkSession, sf_dir: str, root: str) -> dict:
    """The whole feed: bronze sink, silver table and every purchase gold table."""
    paths: dict = {"bronze": run_bronze(spark, sf_dir, root), "silver": f"{root}/silver", "gold": {}}
    silver.purchases(spark.read.schema(schemas.PURCHASES).parquet(paths["bronze"])).write.mode(
        "overwrite").parquet(paths["silver"])
    rows = spark.read.parquet(paths["silver"])
    for name, spec in gold.SPECS.items():
        if spec.inputs == ("purchases",):
            paths["gold"][name] = f"{root}/gold/{name}"
            gold.build(name, {"purchases": rows}).write.mode("overwrite").parquet(paths["gold"][name])
    return paths


def run_gold(spark: SparkSession, sf_dir: str, name: str, root: str | None = None) -> DataFrame:
    return gold.build(name, {"purchases": run_silver(spark, sf_dir, root)})


def _stream_silver(spark: SparkSession, sf_dir: str, root: str, partition_by: list[str]) -> str:
    """Events -> bronze sink -> silver, rejected rows and counters per batch."""
    derived = silver.derive_purchases(file_stream(spark, run_bronze(spark, sf_dir, root), schemas.PURCHASES))
    return checked.run(derived, quality.PURCHASES, "purchases", root, f"{root}/_checkpoints/silver",
                       partition_by)["silver"]


def run_merged(spark: SparkSession, sf_dir: str, name: str, root: str | None = None) -> DataFrame:
    """A purchase gold table from mergeable state (``streaming.merged``)."""
    root = root or fresh_path(spark, "purchase-merged")
    silver_path = _stream_silver(spark, sf_dir, root, [])
    merged.run(spark, silver_path, f"{root}/state", "purchases", f"{root}/_checkpoints/state")
    return merged.table(spark, silver_path, f"{root}/state", "purchases", name)


def run_incremental_gold(
    spark: SparkSession, sf_dir: str, root: str | None = None, name: str = "realtime_metrics"
) -> str:
    """Purchases as a fully incremental chain: events -> bronze sink ->
    silver sink (stateless, in ``processing_date`` folders) -> refresh of the
    touched dates of the date-keyed gold table."""
    root = root or fresh_path(spark, "purchase-incremental")
    silver_sink = _stream_silver(spark, sf_dir, root, ["processing_date"])
    gold_path = f"{root}/gold/{name}"
    run_date_refresh(spark, silver_sink, gold_path, name, "purchases", f"{root}/_checkpoints/gold_{name}")
    return gold_path
