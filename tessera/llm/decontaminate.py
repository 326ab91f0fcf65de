"""Benchmark decontamination by spaced-seed hashing.

A mask reads some positions of a token window and ignores the others, so a
passage with substituted words still agrees under some mask at some place. The
masks' hashes of the benchmark items are joined with those of every document;
each hit names an item and a diagonal (document position minus item position),
and the texts are compared along that diagonal: every stretch of it with
``PIECE`` equal tokens or more, at a share of ``IDENTITY`` or more, counts, and
the item's tokens covered by such stretches, over all diagonals, must be enough
(words inserted into a passage move its rest to another diagonal). The masks
are such that each of these stretches holds a hit, so none is missed.

Tokens are words in lower case (of all scripts) without ASCII punctuation at their ends; words of
punctuation alone are skipped. An item shorter than a mask is hashed whole.

The benchmark is broadcast in blocks of at most about ``BLOCK`` tokens, each a
pass over the documents; one block is the usual case. Documents are compared
where they are read: nothing is shuffled.

Defined cases: null or empty texts and items without tokens match nothing;
repeated items are reported each; repeated documents are each reported; null
ids are carried as they are.
"""

from __future__ import annotations

import string

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import apart, share, stage, table

# every pattern of PIECE equal tokens or more of which IDENTITY agree has one of these
MASKS = ("11111", "101111", "110111", "111011", "111101", "1100111", "11010011", "11100011")
PIECE = 5         # least equal tokens of a stretch
LEAST = 10        # covered tokens of an item, or
PART = 0.5        # this part of the item if that is more; all of a shorter item
LONG = 32         # equal tokens of one stretch that are enough in an item of any length
IDENTITY = 0.75   # equal tokens of all in the stretch
BLOCK = 2_000_000
_EDGE = string.punctuation.encode()
# odd; a hash is the sum of a window's places times these, and hits are compared anyway
_FACTORS = np.random.default_rng(7).integers(0, 2**64, 256, np.uint64) | np.uint64(1)


def _words(text: str | None) -> list[bytes]:
    return text.lower().encode("utf-8", "surrogatepass").split() if text else []


def tokens(text: str | None) -> list[bytes]:
    return [w for w in (x.strip(_EDGE) for x in _words(text)) if w]


class _Places(dict):
    """Cache raw word -> place in the vocabulary, -1 if none, -2 to skip."""

    def __init__(self, vocabulary: dict[bytes, int]):
        super().__init__()
        self.vocabulary = vocabulary

    def __missing__(self, word: bytes) -> int:
        if len(self) > 400_000:
            self.clear()
        w = word.strip(_EDGE)
        i = self[word] = self.vocabulary.get(w, -1) if w else -2
        return i


def _seeds(ids: np.ndarray, offsets: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(starts, hashes) of the windows whose read positions are all known."""
    n = len(ids) - offsets[-1]
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    ok = ids >= 0
    known, ok = ok, ok[:n].copy()
    for o in offsets[1:]:
        ok &= known[o : o + n]
    at = np.flatnonzero(ok)
    h = np.full(len(at), np.uint64(len(offsets)))
    if len(at):
        own = ids.view(np.uint64)
        for o, factor in zip(offsets, _FACTORS):
            h += own[at + o] * factor
    return at, h


def _stretches(equal: np.ndarray, least: int) -> list[tuple[int, int]]:
    """For each start, the longest stretch [a, b) of which ``IDENTITY`` agree,
    if it has ``least`` equal tokens; stretches inside others are left out."""
    starts = np.flatnonzero(equal)
    if len(starts) < least:
        return []
    if len(starts) == len(equal):
        return [(0, len(equal))]
    s = np.concatenate([[0.0], np.cumsum(np.where(equal, 1.0, -IDENTITY / (1 - IDENTITY)))])
    # the largest sum at this end or a later one falls from end to end
    later = np.maximum.accumulate(s[starts + 1][::-1])
    last = len(starts) - 1 - np.searchsorted(later, s[starts] - 1e-9)
    out, end = [], -1
    for i in np.flatnonzero(last - np.arange(len(starts)) + 1 >= least).tolist():
        if last[i] > end:
            end = int(last[i])
            out.append((int(starts[i]), int(starts[end]) + 1))
    return out


class Benchmark:
    """Items and their seeds."""

    def __init__(self, items: list[tuple[int, list[bytes]]], masks: tuple[str, ...] = MASKS):
        self.vocabulary = {w: i for i, w in enumerate(sorted({w for _, ws in items for w in ws}))}
        self.item_ids = [i for i, _ in items]
        self.texts = [np.array([self.vocabulary[w] for w in ws], np.int64) for _, ws in items]
        spans = [[j for j, c in enumerate(m) if c == "1"] for m in masks]
        longest = max(o[-1] for o in spans) + 1
        # texts that some mask does not fit are hashed whole as well
        whole = sorted({len(t) for t in self.texts if 0 < len(t) < longest})
        self.offsets = spans + [list(range(n)) for n in whole]
        self.keys, self.where = [], []
        for place, offsets in enumerate(self.offsets):
            h, w = [], []
            for k, t in enumerate(self.texts):
                if place >= len(spans) and len(t) != len(offsets):
                    continue
                at, own = _seeds(t, offsets)
                h.append(own)
                w += [(k, int(a)) for a in at]
            h = np.concatenate(h) if h else np.empty(0, np.uint64)
            order = np.argsort(h, kind="stable")
            self.keys.append(h[order])
            self.where.append(np.array(w, np.int64).reshape(-1, 2)[order])

    def find(self, ids: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(item place, start, end, equal tokens) of the items in one text."""
        diagonals = set()
        for offsets, keys, where in zip(self.offsets, self.keys, self.where):
            if not len(keys):
                continue
            at, h = _seeds(ids, offsets)
            lo = np.searchsorted(keys, h, "left")
            hit = np.flatnonzero((lo < len(keys)) & (keys[np.minimum(lo, len(keys) - 1)] == h))
            if len(hit):
                hi = np.searchsorted(keys, h[hit], "right")
                for p, a, z in zip(at[hit].tolist(), lo[hit].tolist(), hi.tolist()):
                    for k, i in where[a:z].tolist():
                        diagonals.add((k, p - i))
        pieces: dict[int, list[tuple[int, int, int, np.ndarray]]] = {}
        for k, d in sorted(diagonals):
            item = self.texts[k]
            a, z = max(0, -d), min(len(item), len(ids) - d)
            equal = ids[a + d : z + d] == item[a:z]
            for x, y in _stretches(equal, min(len(item), PIECE)):
                same = np.flatnonzero(equal[x:y]) + a + x
                pieces.setdefault(k, []).append((len(same), a + d + x, a + d + y, same))
        out = []
        for k, own in pieces.items():
            n = len(self.texts[k])
            covered = len(np.unique(np.concatenate([p[3] for p in own])))
            most, start, end, _ = max(own, key=lambda p: (p[0], -p[1]))
            if covered >= min(n, max(LEAST, -(-n * PART // 1))) or most >= LONG:
                out.append((k, start, end, covered))
        return out


def _passes(benchmark: DataFrame, block: int):
    """The items in blocks of about ``block`` tokens."""
    spark = benchmark.sparkSession
    own = benchmark.select("item_id", "text").filter(F.col("text").isNotNull())
    size = own.agg(F.sum(F.regexp_count("text", F.lit(r"\S+")))).first()[0] or 0
    blocks = max(1, -(-size // block))
    for b in range(blocks):
        part = own if blocks == 1 else own.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b)
        rows = sorted(((r["item_id"], tokens(r["text"])) for r in part.collect()),
                      key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        rows = [r for r in rows if r[1]]
        if rows:
            yield share(spark, Benchmark(rows))


_FOUND = "array<struct<item_id:bigint,start:bigint,end:bigint,equal:bigint,item_tokens:bigint>>"
_KIND = pa.list_(pa.struct([(n, pa.int64()) for n in ("item_id", "start", "end", "equal", "item_tokens")]))


def _with_found(docs: DataFrame, shared) -> DataFrame:
    """``docs`` with ``found``: the block's items in each text."""
    schema = docs.select("*", F.array().cast(_FOUND).alias("found")).schema

    def run(batches):
        bench = shared()
        places = _Places(bench.vocabulary)
        for batch in batches:
            for at in range(0, batch.num_rows, 1_000):
                part = batch.slice(at, 1_000)
                out = []
                for t in part.column(part.schema.get_field_index("text")).to_pylist():
                    words = _words(t)
                    ids = np.fromiter(map(places.__getitem__, words), np.int64, len(words))
                    found = bench.find(ids[ids != -2])
                    out.append([dict(item_id=bench.item_ids[k], start=a, end=b, equal=n,
                                     item_tokens=len(bench.texts[k])) for k, a, b, n in found])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(out, _KIND)],
                                                 names=[*part.schema.names, "found"])

    return docs.mapInArrow(run, schema)


def leaks(docs: DataFrame, benchmark: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per document and benchmark item found in it: doc_id, item_id,
    start, end (token places of the longest stretch, end exclusive), equal (item
    tokens covered), item_tokens."""
    spark = docs.sparkSession
    out = None
    for shared in _passes(benchmark, block):
        found = _with_found(docs.select("doc_id", "text"), shared).select("doc_id", F.inline("found"))
        out = found if out is None else out.unionByName(found)
    empty = "doc_id long, item_id long, start long, end long, equal long, item_tokens long"
    return spark.createDataFrame([], empty) if out is None else out


def clean(docs: DataFrame, benchmark: DataFrame, block: int = BLOCK) -> DataFrame:
    """The rows of ``docs`` in which no benchmark item is found, unchanged."""
    for i, shared in enumerate(_passes(benchmark, block)):
        inner, back = apart(docs, "text")
        docs = back(_with_found(inner, shared).filter(F.size("found") == 0))
        if i:
            docs = stage(docs, "clean-block")
    return docs


def query(spark, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
