"""Bronze tables: adapter output, optionally corrupted by the fault rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.operators.faults import FAULTS, inject_faults
from tessera.session import compile_methods
from tessera.sources import adapters


def bronze(spark: SparkSession, sf_dir: str, table: str, faults: bool = True) -> DataFrame:
    df = adapters.ADAPTERS[table](spark, sf_dir)
    return finish(df, table, faults)


def finish(adapted: DataFrame, table: str, faults: bool = True) -> DataFrame:
    """Apply the table's fault rules (one projection) and drop the row key. The
    rules' arithmetic and what silver derives from it make long generated methods."""
    compile_methods(adapted.sparkSession)
    df = inject_faults(adapted, FAULTS[table], adapters.ROW_KEY) if faults and FAULTS[table] else adapted
    return df.select(*adapters.bronze_columns(table))
