"""A training corpus from raw documents, in five stages.

Each stage takes (spark, docs, sf_dir) and returns the documents it keeps with
the columns of ``documents``; the last returns the mix. ``run`` writes every
stage as Parquet in the shared folder and reads it back for the next, so a lost
executor costs a re-read and later stages plan on real sizes.

Texts go to Python in small batches: a worker, and the buffers on both sides of
it, live through all stages and keep the size of the largest batch. A stage's
result is computed after the stage has returned, so each stage lowers the
session's batch size for what it returns; ``run`` sets it back at its end.

Rows with null columns, empty texts, repeated ids or further columns pass
through the stages as the operators' modules define; an empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import decontaminate, jaccard, mixing, rules, secrets
from tessera.llm.common import stage, table

Step = Callable[[SparkSession, DataFrame, str], DataFrame]

# The most of a batch: rows, and bytes where rows are long.
BATCH = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
}


def _small_batches(step: Step) -> Step:
    @wraps(step)
    def run_step(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        for setting, most in BATCH.items():
            spark.conf.set(setting, most)
        return step(spark, docs, sf_dir)

    return run_step


@_small_batches
def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble does not reject. It learns from the
    labelled rows among ``docs``."""
    return rules.keep_good(docs, table(spark, sf_dir, "labels"))


@_small_batches
def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a Jaccard similarity of 0.8 or more
    on five-word shingles: the one with the smallest id."""
    return jaccard.one_of_each(docs, size=5, percent=80)


@_small_batches
def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


@_small_batches
def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced by a mark and n_chars
    counted anew."""
    return secrets.redact(docs)


@_small_batches
def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents as often as it takes them, numbered by ``copy``."""
    return mixing.repeated(docs)


STAGES = [
    ("quality classifier", good_quality),
    ("n-gram Jaccard join", one_of_each),
    ("benchmark decontamination", decontaminated),
    ("secret scans", without_secrets),
    ("source mix", mixed),
]

# Model fitting, component search and seed matching are no SQL; the stages are
# tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    own = {setting: spark.conf.get(setting) for setting in BATCH}
    try:  # every stage is written before the next one begins
        for name, step in STAGES:
            docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    finally:
        for setting, value in own.items():
            spark.conf.set(setting, value)
    return docs
