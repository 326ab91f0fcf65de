"""SRC1 / SNK1 for stored tables: explicit-schema reads of bronze data in
parquet, CSV or JSON, typing of raw text, and full-refresh writes.

Raw text feeds carry every field as a string. ``typed`` converts them to the
bronze schema with ``try_cast`` / ``try_to_timestamp``, so a malformed number
or date becomes NULL -- which the quality rules then count or drop -- instead
of failing the job (Spark 4 runs with ANSI casts, where ``cast`` raises).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampNTZType

from tessera.sources import schemas


def text_schema(table: str) -> StructType:
    """The bronze schema with every field as a string (raw text layout)."""
    return StructType([StructField(f.name, StringType(), True) for f in schemas.BRONZE[table].fields])


def typed(raw: DataFrame, table: str) -> DataFrame:
    """Raw string columns -> bronze types; malformed values become NULL."""
    cols = []
    for f in schemas.BRONZE[table].fields:
        c = F.col(f.name)
        if isinstance(f.dataType, StringType):
            cols.append(c.alias(f.name))
        elif isinstance(f.dataType, TimestampNTZType):
            cols.append(F.try_to_timestamp(c).cast("timestamp_ntz").alias(f.name))
        else:
            cols.append(c.try_cast(f.dataType).alias(f.name))
    return raw.select(*cols)


def read_bronze(spark: SparkSession, path: str, table: str, fmt: str = "parquet") -> DataFrame:
    """Read a stored bronze table with its declared schema. Parquet carries
    types; CSV (with header) and JSON are read as text and typed."""
    if fmt == "parquet":
        return spark.read.schema(schemas.BRONZE[table]).parquet(path)
    reader = spark.read.schema(text_schema(table))
    if fmt == "csv":
        raw = reader.option("header", "true").option("mode", "PERMISSIVE").csv(path)
    elif fmt == "json":
        raw = reader.option("mode", "PERMISSIVE").json(path)
    else:
        raise ValueError(f"unsupported format {fmt!r}")
    return typed(raw, table)


def write_table(
    df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] | None = None
) -> None:
    """SNK1: full refresh of a table folder (optionally partitioned, e.g. by
    ``processing_date`` so date-bounded readers prune whole folders)."""
    writer = df.write.mode("overwrite").format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
