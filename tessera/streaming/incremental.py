"""Incremental refresh of gold tables keyed by the processing date.

The silver sink is written in ``processing_date`` folders. A stream over
that sink hands each micro-batch to ``refresh_dates``, which recomputes the
gold table for the dates the batch touched -- every group of such a date from
all of its silver rows -- and replaces only those date partitions of the gold
table. The batch's dates (at most one per calendar day) become literals of a
partition filter, so the silver scan lists and reads only those dates' folders;
exact distinct counts stay exact, and a replayed micro-batch rewrites the same
partitions with the same rows. Work per trigger follows the touched dates, not
the length of the history.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.plans import gold
from tessera.streaming.common import file_stream


def touched_rows(spark: SparkSession, silver_path: str, changed: DataFrame) -> DataFrame | None:
    """All silver rows of the dates in ``changed``; None when it has no rows."""
    dates = sorted(r[0] for r in changed.select("processing_date").distinct().collect() if r[0])
    if not dates:
        return None
    return spark.read.parquet(silver_path).filter(F.col("processing_date").isin(dates))


def refresh_dates(
    spark: SparkSession, silver_path: str, gold_path: str, name: str, changed: DataFrame,
    table: str = "kyc",
) -> None:
    touched = touched_rows(spark, silver_path, changed)
    if touched is None:
        return
    (
        gold.build(name, {table: touched}, ordered=False)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("processing_date")
        .parquet(gold_path)
    )


def run_date_refresh(
    spark: SparkSession, silver_path: str, gold_path: str, name: str, table: str, checkpoint: str
) -> None:
    """Consume the silver sink's new files with ``availableNow`` and refresh
    the touched dates of ``name`` after each micro-batch."""
    source = file_stream(spark, silver_path, spark.read.parquet(silver_path).schema)
    query = (
        source.writeStream.foreachBatch(
            lambda batch, _epoch: refresh_dates(spark, silver_path, gold_path, name, batch, table)
        )
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
