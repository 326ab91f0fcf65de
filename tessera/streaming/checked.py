"""Quality rules on a stream: clean rows, rejected rows and counters of each batch.

One ``foreachBatch`` writes three tables under a root: ``silver`` (rows that pass
every drop and filter rule), ``rejected`` (the others, with the names of the rules
they fail as an array) and ``counters`` (per rule how many rows were seen and
failed). Each micro-batch has its own ``batch=<id>`` folder in all three, written
before Spark commits the batch and overwritten when the batch is replayed. So
whatever dies when: rows in = clean + rejected, counters add up to both, and
nothing of it is kept in the driver.

Readers of these folders run after the stream has come to rest (``availableNow``),
or read complete batches only (``merged.batches``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import quality

BATCH = "batch"


def write_batch(root: str, rules: Sequence[quality.Rule], table: str, query: str, partition_by: Sequence[str] = ()):
    """``foreachBatch`` function over derived rows."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()  # read and derived once for the three writes
        try:
            for name, rows in (
                ("silver", quality.enforce(batch, rules)),
                ("rejected", quality.quarantine(batch, rules)),
            ):
                if partition_by:  # a folder's rows meet in a few files, not in one of each task
                    rows = rows.hint("rebalance", *[F.col(c) for c in partition_by])
                rows.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{root}/{name}/{BATCH}={batch_id}")
            counters = quality.rule_metrics(batch, rules, table).select(
                F.lit(query).alias("query"), F.lit(batch_id).cast("long").alias("batch_id"), "*")
            counters.write.mode("overwrite").parquet(f"{root}/counters/{BATCH}={batch_id}")
        finally:
            batch.unpersist()

    return write


def run(
    derived: DataFrame, rules: Sequence[quality.Rule], table: str, root: str, checkpoint: str,
    partition_by: Sequence[str] = (),
) -> dict[str, str]:
    """Consume what is there now; the three tables' paths."""
    writer = write_batch(root, rules, table, f"{table}_silver", partition_by)
    query = (
        derived.writeStream.foreachBatch(writer).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return {name: f"{root}/{name}" for name in ("silver", "rejected", "counters")}


def read(spark: SparkSession, path: str) -> DataFrame:
    """A table of ``run`` without its batch column."""
    return spark.read.parquet(path).drop(BATCH)


def counts(spark: SparkSession, path: str) -> DataFrame:
    """Counters over all batches, with the columns of ``quality.rule_metrics``."""
    return read(spark, path).groupBy("table_name", "rule", "action").agg(
        F.sum("total_count").alias("total_count"), F.sum("failed_count").alias("failed_count"))
