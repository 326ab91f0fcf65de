"""Exact top-k inner-product search by distributed histogram selection.

Every pass scores all candidates against a block of queries. A pass keeps, per
query, a histogram over the range that still holds its k-th score; the summed
histogram narrows the range to one bucket, and passes repeat until the range is
one integer, the k-th score itself. The last pass keeps rows at or above it.

What moves: a task reports a query's buckets from the top only until it has
counted k candidates itself, since the k-th score over all is at least that of
any part; so histograms are a few rows per query and task, however many ties.
Of rows at or above the k-th score a task sends its own first k by (score
descending, vec_id), which is exact for any number of equal scores. Queries are
broadcast in blocks of at most ``block``; further blocks are further passes.

Vectors: component x becomes floor(scale * x), x as double. Inner products are
exact: in doubles while they fit 53 bits, else in whole numbers, held to the
64-bit range. Defined cases: vectors that are null or hold null or non-finite
components, and rows without id, take no part; a query meets only vectors of
its own length; rows with the query's id are its own and no candidates; other
repeated rows each count; repeated query ids are one query (the smallest
vector); fewer than k candidates are all returned; empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import stage, table

SCALE = 256
BUCKETS = 1024
BLOCK = 2048
_SIGN = np.uint64(1 << 63)


def _vectors(batch: pa.RecordBatch, scale: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, whole components) of a batch's rows that take part, per length."""
    ids, col = batch.column(0), batch.column(1)
    size = np.asarray(col.value_lengths().fill_null(-1))
    ok = np.asarray(ids.is_valid()) & (size >= 0)
    for n in np.unique(size[ok]):
        rows = np.flatnonzero(ok & (size == n))
        flat = col.take(pa.array(rows)).flatten()
        x = flat.cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(len(rows), n)
        x = np.floor(scale * x)
        good = np.isfinite(x).all(axis=1)
        if good.any():
            yield np.asarray(ids.take(pa.array(rows[good]))).astype(np.int64), x[good]


def _scores(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products in order-keeping unsigned form, one row per query."""
    top = lambda m: float(np.abs(m).max(initial=0))
    if top(queries) * top(vectors) * max(1, queries.shape[1]) < 2.0**53:
        s = (queries @ vectors.T).astype(np.int64)
    else:
        whole = lambda m: np.array([[int(v) for v in r] for r in m], dtype=object).reshape(m.shape)
        s = np.clip(whole(queries) @ whole(vectors).T, -(2**63), 2**63 - 1).astype(np.int64)
    return s.view(np.uint64) ^ _SIGN


def _scored(batches, block, scale):
    """(positions of queries, candidate ids, scores, own) chunk by chunk."""
    for batch in batches:
        for at in range(0, batch.num_rows, 4096):
            for ids, x in _vectors(batch.slice(at, 4096), scale):
                n = x.shape[1]
                where, qids, q = block.get(n, (None, None, None))
                for a in range(0, 0 if where is None else len(where), 256):
                    part = slice(a, a + 256)
                    yield where[part], ids, _scores(q[part], x), qids[part, None] == ids[None, :]


def _histogram(batches, block, scale, low, high, width, need, buckets):
    counts = np.zeros((len(low), buckets), np.int64)
    for where, _, s, own in _scored(batches, block, scale):
        at = (s - low[where, None]) // width[where, None]
        use = (s >= low[where, None]) & (s <= high[where, None]) & ~own
        row = np.broadcast_to(np.arange(len(where))[:, None], s.shape)[use]
        flat = np.bincount(row * buckets + at[use].astype(np.int64), minlength=len(where) * buckets)
        counts[where] += flat.reshape(-1, buckets)
    # from the top until the task has the k-th of its own
    before = np.cumsum(counts[:, ::-1], axis=1)[:, ::-1] - counts
    q, b = np.nonzero((counts > 0) & (before < need[:, None]))
    yield pa.RecordBatch.from_arrays(
        [pa.array(q.astype(np.int32)), pa.array(b.astype(np.int32)), pa.array(counts[q, b])],
        names=["q", "bucket", "n"],
    )


def _best(batches, block, scale, least, k):
    n = len(least)
    none_s, none_i = np.zeros((n, 0), np.uint64), np.zeros((n, 0), np.int64)
    held = {i: (none_s[i], none_i[i]) for i in range(n)}
    for where, ids, s, own in _scored(batches, block, scale):
        use = (s >= least[where, None]) & ~own
        for j in np.flatnonzero(use.any(axis=1)):
            old_s, old_i = held[where[j]]
            new_s, new_i = np.append(old_s, s[j, use[j]]), np.append(old_i, ids[use[j]])
            first = np.lexsort((new_i, ~new_s))[:k]
            held[where[j]] = new_s[first], new_i[first]
    for i, (s, ids) in held.items():
        if len(s):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(s), i, np.int32)), pa.array(ids), pa.array((s ^ _SIGN).view(np.int64))],
                names=["q", "vec_id", "score"],
            )


def _block(spark, rows: list, vectors: DataFrame, k: int, scale: int, buckets: int, peak: float) -> DataFrame:
    """Top k of one block of queries."""
    by_size: dict[int, list[int]] = {}
    xs = [np.floor(scale * np.asarray(r["embedding"], np.float64)) for r in rows]
    for i, x in enumerate(xs):
        by_size.setdefault(len(x), []).append(i)
    qids = np.array([r["vec_id"] for r in rows], np.int64)
    block = {n: (np.array(p), qids[p], np.stack([xs[i] for i in p])) for n, p in by_size.items()}
    sent = spark.sparkContext.broadcast(block)

    # |score| is at most the sum of the query's sizes times the largest component
    reach = [min(2**63 - 1, int(np.abs(x).sum() * peak * 1.000001) + 1) for x in xs]
    low, high = [2**63 - r for r in reach], [2**63 + r for r in reach]
    need = np.full(len(rows), k, np.int64)
    source = vectors.select("vec_id", "embedding")
    while any(a < b for a, b in zip(low, high)):
        width = [(b - a) // buckets + 1 for a, b in zip(low, high)]
        lo, hi, wi = (np.array(v, np.uint64) for v in (low, high, width))
        task = lambda it, a=(lo, hi, wi, need.copy()): _histogram(it, sent.value, scale, *a, buckets)
        found = source.mapInArrow(task, "q int, bucket int, n long").groupBy("q", "bucket").agg(F.sum("n").alias("n"))
        # only the bucket that holds the k-th score comes back
        above = F.sum("n").over(Window.partitionBy("q").orderBy(F.col("bucket").desc()))
        wanted = spark.createDataFrame([(i, int(v)) for i, v in enumerate(need)], "q int, need long")
        hit = found.withColumn("upto", above).join(F.broadcast(wanted), "q").filter(
            (F.col("upto") >= F.col("need")) & (F.col("upto") - F.col("n") < F.col("need"))
        )
        got = {r["q"]: (r["bucket"], r["upto"] - r["n"]) for r in hit.collect()}
        for i in range(len(rows)):
            if i in got:
                b, passed = got[i]
                a = low[i] + b * width[i]
                low[i], high[i] = a, min(high[i], a + width[i] - 1)
                need[i] -= passed
            else:  # fewer candidates than k: all of them
                low[i] = high[i] = 0
    least = np.array(low, np.uint64)
    best = source.mapInArrow(
        lambda it: _best(it, sent.value, scale, least, k), "q int, vec_id long, score long"
    )
    names = spark.createDataFrame([(i, int(v)) for i, v in enumerate(qids)], "q int, query_id long")
    first = Window.partitionBy("q").orderBy(F.col("score").desc(), "vec_id")
    return best.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= k).join(
        F.broadcast(names), "q"
    ).select("query_id", "rank", "vec_id", "score")


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int = 5, scale: int = SCALE,
    buckets: int = BUCKETS, block: int = BLOCK,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score of each query's k best rows.

    Both frames have vec_id (long) and embedding (array of float or double).
    """
    spark = vectors.sparkSession
    finite = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    asked = stage(
        queries.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & finite)
        .groupBy("vec_id").agg(F.min("embedding").alias("embedding")), "topk-queries",
    )
    n = asked.count()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if not n:
        return empty
    edge = F.greatest(F.abs(F.array_max("embedding")), F.abs(F.array_min("embedding"))).cast("double")
    peak = vectors.select(edge.alias("e")).filter(~F.isnan("e") & (F.col("e") < float("inf"))).agg(
        F.max("e")
    ).first()[0]
    peak = scale * (peak or 0.0) + 1
    blocks = -(-n * 5 // (block * 4)) if n > block else 1
    out = empty
    for b in range(blocks):
        rows = asked.filter(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == b).collect()
        if rows:
            found = _block(spark, rows, vectors, k, scale, buckets, peak)
            out = found if blocks == 1 else out.unionByName(stage(found, "topk-block"))
    return out


def query(spark, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.filter("vec_id % 50 = 0"))


ORACLE_SQL = """
WITH v AS (
  SELECT vec_id, [floor(256 * x::DOUBLE) for x in embedding] AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)),
r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
