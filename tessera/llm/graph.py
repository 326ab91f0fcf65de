"""Connected components of a large sparse graph, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import stage


def components(edges: DataFrame) -> DataFrame:
    """(v, label) for every end of ``edges`` (a, b): the smallest vertex that
    can be reached. Each round takes the least label of the neighbours and then
    the label's own label, so paths halve; every round is a written table."""
    both = stage(
        edges.select("a", "b").union(edges.select("b", "a")).filter("a <> b").distinct(), "cc-edges"
    )
    labels = stage(
        both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("v"), F.least("a", "m").alias("label")),
        "cc-labels",
    )
    while True:
        near = both.join(labels.select(F.col("v").alias("b"), "label"), "b").groupBy("a").agg(
            F.min("label").alias("m")
        )
        step = labels.join(near, F.col("v") == F.col("a")).select("v", "label", F.least("label", "m").alias("next"))
        step = stage(step, "cc-step")
        jump = step.select(F.col("v").alias("_v"), F.col("next").alias("_next"))
        new = stage(
            step.join(jump, F.col("next") == F.col("_v"), "left").select(
                "v", "label", F.least("next", F.coalesce("_next", "next")).alias("next")
            ), "cc-labels",
        )
        if new.filter("label <> next").isEmpty():
            return labels
        labels = new.select("v", F.col("next").alias("label"))
