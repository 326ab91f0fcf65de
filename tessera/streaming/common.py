"""Structured Streaming plumbing shared by the feeds.

Sources are file streams with an explicit schema; sinks are parquet folders
with a checkpoint, written in append mode. ``availableNow`` processes every
file present at start (in several micro-batches when ``maxFilesPerTrigger``
is set) and stops; a rerun with the same checkpoint processes only new files,
so a restarted or retried job never duplicates rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tessera.sources import schemas
from tessera.sources.tables import table_path


def file_stream(
    spark: SparkSession,
    path: str,
    schema: StructType,
    max_files: int = 64,
    glob: str | None = None,
) -> DataFrame:
    """A file stream over a directory; ``glob`` selects the files of one
    table when several tables share the directory."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(path)


def _is_folder(spark: SparkSession, path: str) -> bool:
    """Whether a table is a folder of part files; fails when it is absent."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.getFileStatus(hpath).isDirectory())


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a stream. A table folder is streamed itself, so part
    files dropped into it are picked up by the next trigger; a single file is
    selected by name from the folder it shares with other tables."""
    path = table_path(sf_dir, "events")
    if _is_folder(spark, path):
        return file_stream(spark, path, schemas.EVENTS)
    return file_stream(spark, sf_dir, schemas.EVENTS, glob=path.rsplit("/", 1)[1])


def run_to_parquet(
    df: DataFrame,
    sink: str,
    checkpoint: str,
    name: str | None = None,
    partition_by: list[str] | None = None,
) -> None:
    """Append ``df`` to ``sink`` until the input present now is consumed."""
    writer = (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("path", sink)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    if name:
        writer = writer.queryName(name)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    query = writer.start()
    query.awaitTermination()
    if query.exception() is not None:  # surface failures instead of returning partial sinks
        raise RuntimeError(str(query.exception()))
