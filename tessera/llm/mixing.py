"""Mixing sources to target weights by capped water-filling.

Every source gets a share of the word budget by weight; a source whose share
exceeds ``max_epochs`` times its own size is clamped there and the excess is
shared again by weight among the others until no source is above. Documents
then realise their source's target by whole repetitions plus one seeded
fraction.

Plan: sizes are computed once and staged (id, source, size). Sources are
ranked by a distributed sort. The water level is found by a loop of small
aggregates over the source table: only two sums reach the driver each round.
The fractional repetition takes documents in the order of md5(seed:id) until
the fraction's words are reached. The running sum over a source, which may
hold a third of all rows, is taken in two steps: sums per (source, first three
hex digits), then a row-wise sum only inside the one digit group that the
boundary falls into, so no task holds a whole source.

Defined cases: null text has size 0; a null source is a source of its own and
ranks last; a null id sorts as the empty text; empty tables give empty results;
a mix without words has targets 0. Rows with the same id and source sort by
size, equal rows are interchangeable. Other columns pass by unread.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import WORD, apart, stage

WEIGHTS = (5, 2, 1)
BUDGET = 1.5
MAX_EPOCHS = 2
SEED = "mix-1"
DIGITS = 3


def _ranked(sources: DataFrame) -> DataFrame:
    """Position of each source in code-point order, null last, from 0."""
    ordered = sources.orderBy(F.col("source").asc_nulls_last()).checkpoint()
    local = ordered.select(
        "*",
        F.spark_partition_id().alias("_part"),
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("_at"),
    )
    # one row per sort partition
    sizes = sorted(local.groupBy("_part").count().collect())
    base, pairs = 0, []
    for part, n in sizes:
        pairs += [F.lit(part), F.lit(base)]
        base += n
    offset = F.create_map(*pairs)[F.col("_part")] if pairs else F.lit(0)
    return local.withColumn("rank", offset + F.col("_at")).drop("_part", "_at")


def _level(src: DataFrame, budget: float) -> tuple[float, float]:
    """Words and weight left for the sources below their cap."""
    total = src.agg(F.sum("source_size")).first()[0] or 0
    level = (0.0, 1.0)
    while True:
        capped = F.col("weight") * level[0] > F.col("cap") * level[1]
        got = src.agg(
            F.coalesce(F.sum(F.when(capped, F.col("cap"))), F.lit(0)).alias("cap"),
            F.coalesce(F.sum(F.when(~capped, F.col("weight"))), F.lit(0)).alias("weight"),
        ).first()
        new = (budget * total - got["cap"], float(got["weight"]))
        if got["weight"] == 0 or new == level:
            return level
        level = new


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    budget: float = BUDGET,
    max_epochs: int = MAX_EPOCHS,
    seed: str = SEED,
    digits: int = DIGITS,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies,
    taken, and the columns ``carry``, which also order rows that are equal else."""
    sized = stage(
        docs.select(
            "doc_id", "source", *carry,
            F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
            F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
                  .cast("binary")).alias("_key"),
        ).withColumn("_bucket", F.substring("_key", 1, digits)),
        "mix-sizes",
    )
    buckets = stage(sized.groupBy("source", "_bucket").agg(F.sum("size").alias("words")), "mix-buckets")
    src = _ranked(buckets.groupBy("source").agg(F.sum("words").alias("source_size")))
    weight = F.element_at(
        F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int")
    )
    src = stage(src.select("source", "source_size", weight.alias("weight"),
                           (F.col("source_size") * max_epochs).alias("cap")), "mix-sources")
    words, left = _level(src, budget)
    share = F.lit(words) * F.col("weight") / F.lit(left)
    src = src.withColumn("target", F.least(share, F.col("cap").cast("double")))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    src = src.withColumn("whole", whole.cast("long")).withColumn(
        "rest", F.col("target") - F.col("whole") * F.col("source_size")
    )
    before = Window.partitionBy("source").orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    dealt = buckets.withColumn("_before", F.coalesce(F.sum("words").over(before), F.lit(0))).join(
        src.drop("weight", "cap").withColumnRenamed("source", "_source"),
        F.col("source").eqNullSafe(F.col("_source")),
    ).select(
        F.col("_source"), F.col("_bucket").alias("_b"), "source_size", "target", "whole", "rest",
        "_before", (F.col("_before") + F.col("words")).alias("_after"),
    )
    rows = sized.join(
        dealt, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_bucket") == F.col("_b"))
    ).drop("_source", "_b")
    # a document belongs to the fraction when its middle word does
    inside = (F.col("_before") < F.col("rest")) & (F.col("rest") < F.col("_after"))
    along = Window.partitionBy("source", "_bucket").orderBy("_key", "size", *carry).rowsBetween(
        Window.unboundedPreceding, -1
    )
    far = rows.filter(~inside).withColumn("_extra", F.col("_after") <= F.col("rest"))
    edge = rows.filter(inside).withColumn(
        "_extra",
        F.col("_before") + F.coalesce(F.sum("size").over(along), F.lit(0)) + F.col("size") / 2
        < F.col("rest"),
    )
    copies = F.least(F.col("whole") + F.col("_extra").cast("long"), F.lit(max_epochs).cast("long"))
    return far.unionByName(edge).select(
        "doc_id", "source", "size", "source_size", "target", copies.alias("copies"),
        (copies * F.col("size")).alias("taken"), *carry,
    )


def repeated(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: documents' columns with each row as often as it is
    taken, plus ``copy`` (from 1; it replaces a column of that name). Documents the mix does not take are absent.

    Rows are numbered and written once, so equal rows have copies of their own.
    """
    inner, back = apart(docs, "doc_id", "text", "source")
    inner = stage(inner.withColumn("_row", F.monotonically_increasing_id()), "mix-rows")
    counts = mix(inner, carry=("_row",), **options).filter("copies > 0").select(
        F.col("_row").alias("_at"), F.col("copies").alias("_n"))
    joined = inner.join(counts, F.col("_row") == F.col("_at"))
    return back(joined.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("_n").cast("int")))), "copy")


def query(spark, sf_dir: str) -> DataFrame:
    from tessera.llm.common import table

    return mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


ORACLE_SQL = f"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
         md5('{SEED}:' || coalesce(doc_id::VARCHAR, '')) AS k
  FROM documents),
src AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         CASE (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3
           WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM sized GROUP BY source),
-- sources reach their cap in the order of cap / weight
ord AS (
  SELECT *, 2 * source_size AS cap,
         sum(2 * source_size) OVER w - 2 * source_size AS cap_before,
         sum(weight) OVER () - (sum(weight) OVER w - weight) AS weight_left
  FROM src WINDOW w AS (ORDER BY source_size::DOUBLE / weight, source ASC NULLS LAST)),
lev AS (
  SELECT 1.5::DOUBLE * (SELECT sum(source_size) FROM src) - cap_before AS words,
         weight_left::DOUBLE AS left_w
  FROM ord
  WHERE weight * (1.5::DOUBLE * (SELECT sum(source_size) FROM src) - cap_before) <= cap * weight_left::DOUBLE
  ORDER BY cap::DOUBLE / weight LIMIT 1),
tgt AS (
  SELECT source, source_size,
         least((SELECT words FROM lev) * weight / (SELECT left_w FROM lev), (2 * source_size)::DOUBLE) AS target
  FROM src),
parts AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS whole FROM tgt),
run AS (
  SELECT d.doc_id, d.size, p.source_size, p.target, p.whole,
         p.target - p.whole * p.source_size AS rest,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.size ROWS UNBOUNDED PRECEDING) - d.size AS before
  FROM sized d JOIN parts p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target,
       (size * least(whole + CASE WHEN before + size / 2.0::DOUBLE < rest THEN 1 ELSE 0 END, 2))::BIGINT AS taken
FROM run
"""
