"""WIN1: a row's share of a whole-table total.

``SUM(x) OVER ()`` has no partition key, so Spark plans it as an exchange to a
single partition: one task would hold every row. The same value comes from an
uncorrelated scalar subquery: a global aggregate (partial sums per task, one row
to the final stage) whose value the projection reads. Unlike a join it
disappears from the plan when the share is not read, and filters that follow can
be pushed below it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def with_share(df: DataFrame, value: str, out: str, scale: int = 4) -> DataFrame:
    total = df.agg(F.sum(value)).scalar()
    return df.withColumn(out, F.round(F.col(value) / total, scale))


def with_share_window(df: DataFrame, value: str, out: str, scale: int = 4) -> DataFrame:
    """The literal window form, kept for the equivalence test and the bench
    comparison only; it funnels all rows through one partition."""
    return df.withColumn(out, F.round(F.col(value) / F.sum(value).over(Window.partitionBy()), scale))
