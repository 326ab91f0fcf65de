"""Gold tables of a feed kept as mergeable state, whatever their keys.

A stream over the silver sink turns each micro-batch into the state of its rows
(``operators.shared_groups``: exact sums, counts, least and largest values, and
the distinct (key, value) pairs, for all tables of the feed in one pass) and
writes it to ``delta/batch=<id>``, replacing what an earlier try of that batch
left. Every ``compact_every`` batches the deltas are folded into ``base/batch=<id>``.
The tables are published from the last base and the deltas after it.

So a run reads the new silver files and, at a compaction, the state; never the
history. A replayed batch adds nothing: its delta is replaced, and a base is made
again from the base before it. Folders without Spark's success mark are ignored,
so a job that dies while writing leaves the state as it was. ``vacuum`` removes
what no reader needs any more.

Defined cases: an empty silver sink gives empty tables; null keys are groups and
null values are not counted, as in the tables built from rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.operators import shared_groups
from tessera.plans import gold
from tessera.streaming.common import file_stream

COMPACT_EVERY = 16
_BATCH = "batch="


def _filesystem(spark: SparkSession, path: str):
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath, hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def batches(spark: SparkSession, folder: str) -> list[int]:
    """Ids of the complete ``batch=<id>`` folders, ascending."""
    path, fs = _filesystem(spark, folder)
    if not fs.exists(path):
        return []
    found = []
    for status in fs.listStatus(path):
        name = status.getPath().getName()
        if name.startswith(_BATCH) and fs.exists(_filesystem(spark, f"{folder}/{name}/_SUCCESS")[0]):
            found.append(int(name[len(_BATCH):]))
    return sorted(found)


def _current(spark: SparkSession, root: str, upto: int | None = None, before: bool = False) -> list[str]:
    """Folders that make up the state: the last base and the deltas after it.
    ``upto``: as of that batch; ``before``: without a base made by it."""
    bases = [b for b in batches(spark, f"{root}/base") if upto is None or b < upto or (b == upto and not before)]
    base = bases[-1] if bases else None
    deltas = [d for d in batches(spark, f"{root}/delta")
              if (base is None or d > base) and (upto is None or d <= upto)]
    return ([f"{root}/base/{_BATCH}{base}"] if bases else []) + [f"{root}/delta/{_BATCH}{d}" for d in deltas]


def _state(spark: SparkSession, folders: list[str], specs: list[gold.GoldSpec], empty: DataFrame) -> DataFrame:
    if not folders:
        return shared_groups.state(empty, specs)
    schema = shared_groups.state(empty, specs).schema
    return shared_groups.merge([spark.read.schema(schema).parquet(*folders)], specs)


def add_batch(root: str, specs: list[gold.GoldSpec], compact_every: int):
    """``foreachBatch`` function that adds a micro-batch to the state under ``root``."""
    def add(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        shared_groups.state(batch, specs).write.mode("overwrite").parquet(f"{root}/delta/{_BATCH}{batch_id}")
        if (batch_id + 1) % compact_every == 0:
            folders = _current(spark, root, batch_id, before=True)
            empty = spark.createDataFrame([], batch.schema)
            _state(spark, folders, specs, empty).write.mode("overwrite").parquet(f"{root}/base/{_BATCH}{batch_id}")

    return add


def run(
    spark: SparkSession, silver_path: str, root: str, feed: str, checkpoint: str,
    compact_every: int = COMPACT_EVERY, max_files: int = 64,
) -> None:
    """Bring the state under ``root`` up to the silver files present now."""
    schema = spark.read.parquet(silver_path).schema
    query = (
        file_stream(spark, silver_path, schema, max_files).writeStream
        .foreachBatch(add_batch(root, gold.undated(feed), compact_every))
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


def table(spark: SparkSession, silver_path: str, root: str, feed: str, name: str, ordered: bool = True) -> DataFrame:
    """A gold table from the state; of ``silver_path`` only the schema is used."""
    specs = gold.undated(feed)
    empty = spark.createDataFrame([], spark.read.parquet(silver_path).schema)
    merged = _state(spark, _current(spark, root), specs, empty)
    types = dict(empty.dtypes)
    return shared_groups.table_of(shared_groups.publish(merged, specs), specs, name, types, ordered)


def vacuum(spark: SparkSession, root: str) -> list[str]:
    """Remove deltas behind the last base but one, and the bases before it (a
    replay of the last compaction still needs these two)."""
    bases = batches(spark, f"{root}/base")
    if len(bases) < 2:
        return []
    keep = bases[-2]
    old = [f"{root}/base/{_BATCH}{b}" for b in bases if b < keep]
    old += [f"{root}/delta/{_BATCH}{d}" for d in batches(spark, f"{root}/delta") if d <= keep]
    for folder in old:
        path, fs = _filesystem(spark, folder)
        fs.delete(path, True)
    return old
