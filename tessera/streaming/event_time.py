"""EXT1: hourly metrics as a stateful event-time stream that loses no row.

Step 1, ``route`` (no state): each micro-batch is split at the watermark as of the
batches before it, the latest event time seen less the delay. Rows whose hour has
passed it, and rows without event time, go to the ``late`` table, the others to
``ontime``; the event time reached is kept with the batch in ``clock``.

Step 2, ``aggregate``: ``withWatermark`` and hourly ``window`` per customer, in
update mode over the on-time rows. Spark drops the state of hours behind the
watermark, so it does not grow with the history; updates go to ``windows`` and
replace what an earlier batch said about the same hour and customer. All on-time
rows of a run are one micro-batch, whose watermark is at most the one step 1 used
for any of them, so the aggregation meets no late row; if it ever did, it fails.

Step 3, ``hourly``: the last word on each hour and customer, with the late rows
added, as hourly counts, exact distinct customers and exact averages.

Every table has a ``batch=<id>`` folder per micro-batch that a replay overwrites;
folders without Spark's success mark are not read.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.aggregate import DEC_IN, exact_ratio
from tessera.streaming.common import file_stream
from tessera.streaming.merged import batches

DELAY_HOURS = 2
_HOUR = "1 hour"


def _finish(query) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


def _complete(spark: SparkSession, folder: str) -> list[str]:
    return [f"{folder}/batch={b}" for b in batches(spark, folder)]


def route(
    source: DataFrame, root: str, checkpoint: str, event_time: str, delay_hours: int = DELAY_HOURS
) -> None:
    """Split the rows that are there now into ``ontime`` and ``late``."""
    hour_end = F.date_trunc("hour", F.col("_event_time")) + F.expr("INTERVAL 1 HOUR")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = [b for b in batches(spark, f"{root}/clock") if b < batch_id]
        reached = spark.read.parquet(f"{root}/clock/batch={before[-1]}") if before else None
        rows = batch.withColumn("_event_time", F.col(event_time).cast("timestamp")).persist()
        try:
            clock = rows.agg(F.max("_event_time").alias("reached"))
            late = F.col("_event_time").isNull()
            if reached is not None:
                clock = clock.union(reached).agg(F.max("reached").alias("reached"))
                mark = reached.first()[0]  # one value
                if mark is not None:
                    late = late | (hour_end <= F.lit(mark) - F.expr(f"INTERVAL {delay_hours} HOURS"))
            rows.filter(~late).write.mode("overwrite").parquet(f"{root}/ontime/batch={batch_id}")
            rows.filter(late).write.mode("overwrite").parquet(f"{root}/late/batch={batch_id}")
            clock.write.mode("overwrite").parquet(f"{root}/clock/batch={batch_id}")
        finally:
            rows.unpersist()

    _finish(source.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def _sums(averages: Sequence[tuple[str, str]]) -> list[Column]:
    """Row count, exact sum and non-null count of each averaged column."""
    parts = [F.count(F.lit(1)).alias("_rows")]
    for i, (_, column) in enumerate(averages):
        parts += [F.sum(F.col(column).cast(DEC_IN)).alias(f"_s{i}"), F.count(column).alias(f"_n{i}")]
    return parts


def aggregate(
    spark: SparkSession, root: str, checkpoint: str, customer: str, averages: Sequence[tuple[str, str]],
    delay_hours: int = DELAY_HOURS,
) -> None:
    """Bring ``windows`` up to the on-time rows that are there now."""
    folders = _complete(spark, f"{root}/ontime")
    if not folders:
        return
    schema = spark.read.parquet(folders[0]).schema.add("batch", "integer")
    # no limit of files: all that is there is one micro-batch
    rows = spark.readStream.schema(schema).parquet(f"{root}/ontime")
    grouped = rows.withWatermark("_event_time", f"{delay_hours} hours").groupBy(
        F.window("_event_time", _HOUR).alias("_w"), F.col(customer).alias("_who")).agg(*_sums(averages))
    out = grouped.select(F.col("_w.start").alias("_hour"), *[c for c in grouped.columns if c != "_w"])

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/windows/batch={batch_id}")

    query = (out.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    _finish(query)
    dropped = sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])
    if dropped:
        raise RuntimeError(f"{dropped} groups of on-time rows fell behind the watermark")


def hourly(
    spark: SparkSession, root: str, customer: str, averages: Sequence[tuple[str, str, int]],
    names: tuple[str, str, str] = ("window_start", "kyc_records_processed", "unique_customers"),
) -> DataFrame:
    """Hour, rows, distinct customers and averages (name, column, scale)."""
    columns = [(name, column) for name, column, _ in averages]
    values = ["_rows", *[f"_{p}{i}" for i in range(len(columns)) for p in ("s", "n")]]
    parts = []
    folders = _complete(spark, f"{root}/windows")
    if folders:
        said = spark.read.option("basePath", f"{root}/windows").parquet(*folders)
        last = said.groupBy("_hour", "_who").agg(F.max_by(F.struct(*values), F.col("batch")).alias("_v"))
        parts.append(last.select("_hour", "_who", "_v.*"))
    late = _complete(spark, f"{root}/late")
    if late:
        rows = spark.read.parquet(*late)
        parts.append(rows.groupBy(F.date_trunc("hour", "_event_time").alias("_hour"), F.col(customer).alias("_who"))
                     .agg(*_sums(columns)))
    both = reduce(DataFrame.unionByName, parts)
    each = both.groupBy("_hour", "_who").agg(*[F.sum(v).alias(v) for v in values])
    hours = each.groupBy("_hour").agg(F.count("_who").alias("_who"), *[F.sum(v).alias(v) for v in values])
    return hours.select(
        F.col("_hour").cast("timestamp").alias(names[0]), F.col("_rows").alias(names[1]),
        F.col("_who").alias(names[2]),
        *[exact_ratio(F.col(f"_s{i}"), F.col(f"_n{i}"), scale).alias(name)
          for i, (name, _, scale) in enumerate(averages)])


def run(
    spark: SparkSession, silver_path: str, root: str, event_time: str, customer: str,
    averages: Sequence[tuple[str, str, int]], delay_hours: int = DELAY_HOURS, max_files: int = 64,
) -> DataFrame:
    """All three steps over the files of ``silver_path`` that are there now."""
    source = file_stream(spark, silver_path, spark.read.parquet(silver_path).schema, max_files)
    route(source.drop("batch"), root, f"{root}/_checkpoints/route", event_time, delay_hours)
    columns = [(name, column) for name, column, _ in averages]
    aggregate(spark, root, f"{root}/_checkpoints/windows", customer, columns, delay_hours)
    return hourly(spark, root, customer, averages)
