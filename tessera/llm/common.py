"""Helpers shared by the operators: table access, staging, tokens."""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Callable, Iterable, Iterator
from typing import Any

import numpy as np
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import scratch_root

# A token is a run of anything but these seven ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts lineage: a lost executor costs a re-read of the written table, not a
    recomputation. The folder is the cluster's ``spark.checkpoint.dir``.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/llm-{label}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def passing(df: DataFrame, label: str, by: str | None = None) -> tuple[DataFrame, Callable[[], None]]:
    """``stage``, and a function that deletes the table when nothing will read it again.

    With ``by`` the table is bucketed by this column, in as many buckets as a shuffle
    has partitions, so a join on it shuffles the other side only.
    """
    spark = df.sparkSession
    name = f"llm-{label}-{uuid.uuid4().hex[:12]}"
    path = f"{scratch_root(spark)}/{name}"
    entry = "tessera_" + name.replace("-", "_")
    if by is None:
        df.write.parquet(path)
        table = spark.read.schema(df.schema).parquet(path)
    else:
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        df.write.format("parquet").bucketBy(buckets, by).option("path", path).saveAsTable(entry)
        table = spark.table(entry)

    def delete() -> None:
        if by is not None:
            spark.sql(f"DROP TABLE IF EXISTS {entry}")
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)

    return table, delete


def apart(docs: DataFrame, *used: str) -> tuple[DataFrame, Callable[..., DataFrame]]:
    """``docs`` with its columns but ``used`` under names that clash with no
    operator's, and a function that gives them their names back; columns named
    in its further arguments are added and replace those of ``docs``."""
    names = {c: f"_d{i}" for i, c in enumerate(docs.columns) if c not in used}

    def back(df: DataFrame, *added: str) -> DataFrame:
        own = [F.col(names.get(c, c)).alias(c) for c in docs.columns if c not in added]
        return df.select(*own, *added)

    return docs.withColumnsRenamed(names), back


def share(spark: SparkSession, value: Any) -> Callable[[], Any]:
    """Broadcast an object of this package; tasks call the result to get it.
    Callers vouch for the object's size."""
    sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: pickle.loads(sent.value)


def crc_mod(doc_id: str | Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; a null id counts as ''."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % n


def words_of(text: str | None) -> list[bytes]:
    """Tokens of a text with A-Z lower-cased; other letters stay as they are."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


class WordHash(dict):
    """Cache word -> 64-bit hash; emptied when it holds ``limit`` words, so a
    task's memory does not follow its vocabulary."""

    def __init__(self, limit: int = 400_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    h = h.copy()
    h ^= h >> np.uint64(30)
    h *= _M1
    h ^= h >> np.uint64(27)
    h *= _M2
    h ^= h >> np.uint64(31)
    return h


def window_hashes(h: np.ndarray, offsets: Iterable[int]) -> np.ndarray:
    """Hash of the tokens at ``offsets`` for every start that has them all."""
    offsets = list(offsets)
    n = len(h) - offsets[-1]
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.full(n, np.uint64(0x9E3779B97F4A7C15))
    for o in offsets:
        out = mix(out ^ h[o : o + n]) + np.uint64(0x632BE59BD9B4E019)
    return out


def shingles(h: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of the ``size``-token shingles of one text;
    fewer tokens give the whole sequence as one, none gives none."""
    if not len(h):
        return np.empty(0, np.uint64)
    return np.unique(window_hashes(h, range(min(size, len(h)))))


def rows_of(batches: Iterator, columns: list[str]) -> Iterator[list[list]]:
    """Arrow batches as plain Python columns, a bounded slice at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, 2_000):
            part = batch.slice(at, 2_000)
            yield [part.column(c).to_pylist() for c in columns]
