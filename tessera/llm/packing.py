"""Packing documents into sequences: dominance reduction, then best fit.

A document is its token ids and one end id. One of more than ``capacity`` ids is
cut: its first piece takes what is over whole sequences, the others fill one
each. The number of sequences depends only on how many pieces there are of each
length, at most ``capacity`` numbers, so the plan is made from that histogram:

1. Martello-Toth reduction. For a length j, a set {j} or {j, one} or {j, two} is
   fixed when it dominates every other set that holds j: each of those can be
   exchanged, member for member, for one of the fixed set that is as long or
   longer. Fixing it loses no optimal packing. Sets are fixed as often as their
   lengths last, until no length has a dominating set.
2. Best fit, longest first, of what is left: a piece goes into the fullest
   sequence that holds it; equal sequences are filled together.

The plan says which sequence and offset the i-th piece of a length gets. Pieces
are numbered per length by their task and running totals over the tasks' counts,
so no length, however frequent, meets in one task. The driver sees the histogram
only; the plan that is broadcast is bounded by the capacity, not by the rows.

Token ids are those of the ``tokenizers`` file. Texts of ASCII and Latin letters
without special tokens go through the same vocabulary as a table of ranks, which
gives the same ids in a fraction of the time; all others through ``tokenizers``.

Defined cases: a null or empty text is the end id alone; texts of any length are
tokenized whole; rows are independent, so ids may repeat or be null; an empty
table gives no rows; other columns of the documents take no part.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from tessera.llm.common import rows_of, share, stage, table

CAPACITY = 1024
END = 2
VOCABULARY = "byte_bpe_50k.json"

# characters whose classes are the same in every version of Unicode's tables
_PLAIN = re.compile(r"[\t\n\r\x20-~¡-ɏ]*")


def _byte_letters() -> dict[int, str]:
    """Byte -> the letter that stands for it in a byte-level vocabulary: visible
    Latin-1 characters for themselves, the others from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(0x100 + i) for i, b in enumerate(rest)}


def _ranked(path: str):
    """The file's merges as a table of ranks, which a second library runs several
    times faster; None for files whose merges do not number their tokens in order."""
    import public_tokenizers
    import tiktoken

    with open(path, encoding="utf-8") as f:
        given = json.load(f)
    split, model = given["pre_tokenizer"] or {}, given["model"]
    byte = {c: b for b, c in _byte_letters().items()}
    whole = {t["content"] for t in given["added_tokens"]}
    vocabulary = {t: i for t, i in model.get("vocab", {}).items() if t not in whole}
    merges = [m.split(" ") if isinstance(m, str) else m for m in model.get("merges", [])]
    if (
        given["normalizer"] or split.get("type") != "ByteLevel" or split.get("add_prefix_space")
        or not split.get("use_regex", True) or len(vocabulary) != len(merges) + 256
        or any(vocabulary.get(a + b) != 256 + i for i, (a, b) in enumerate(merges))
    ):
        return None
    ranks = {bytes(byte[c] for c in t): i for t, i in vocabulary.items()}
    return tiktoken.Encoding("ranked", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


class Ids:
    """Little-endian 32-bit token ids of texts, as the ``tokenizers`` file gives them."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task is the unit of work
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.ranked = _ranked(path)

    def of(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self.ranked and _PLAIN.fullmatch(text) and not any(s in text for s in self.special):
            return self.ranked.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False).tobytes()
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def cut(n: int, capacity: int) -> Iterator[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids."""
    over = n % capacity
    if over:
        yield 0, over
    for at in range(over, n, capacity):
        yield at, capacity


def pieces(
    docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end: int = END,
    with_ids: bool = False, id_column: str = "doc_id", text: str = "text",
) -> DataFrame:
    """One row per piece: ``id_column``, piece, start, length, ids_crc32, the
    place of the row among those of its length (``_task``, ``_nth``) and, if
    asked for, the ids themselves (array of int)."""
    schema = docs.select(id_column).schema
    for name, of in (("piece", "integer"), ("start", "long"), ("length", "long"), ("ids_crc32", "long"),
                     ("_task", "integer"), ("_nth", "long")):
        schema = schema.add(name, of)
    if with_ids:
        schema = schema.add("ids", ArrayType(IntegerType()))
    given = docs.select(F.col(id_column).alias("_id"), F.col(text).alias("_text"))

    def run(batches):
        import public_tokenizers

        ids_of = Ids(path or public_tokenizers.path(VOCABULARY))
        task = TaskContext.get().partitionId()
        seen = [0] * (capacity + 1)
        last = struct.pack("<I", end)
        id_type = None
        for batch in batches:
            id_type = batch.schema.field("_id").type
            for keys, texts in rows_of([batch], ["_id", "_text"]):
                rows = []
                for key, t in zip(keys, texts):
                    data = ids_of.of(t) + last
                    for i, (start, n) in enumerate(cut(len(data) // 4, capacity)):
                        part = data[4 * start : 4 * (start + n)]
                        row = [key, i, start, n, zlib.crc32(part), task, seen[n]]
                        rows.append(row + [np.frombuffer(part, "<u4").tolist()] if with_ids else row)
                        seen[n] += 1
                types = [id_type, pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
                types += [pa.list_(pa.int32())] if with_ids else []
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, ty) for c, ty in zip(zip(*rows), types)], names=schema.names
                )

    return given.mapInArrow(run, schema)


# --- the plan, from the histogram of lengths ---

def _smallest(counts: dict[int, int], sizes: list[int], without: int, k: int) -> list[int]:
    """The ``k`` shortest lengths at hand (ascending ``sizes``), one ``without`` set aside."""
    out: list[int] = []
    for s in sizes:
        n = counts[s] - (s == without)
        out += [s] * min(n, k - len(out))
        if len(out) == k:
            break
    return out


def _best_pair(left: dict[int, int], sizes: list[int], room: int) -> tuple[int, int, int]:
    """The longest pair a >= b within ``room`` (0, 0 if none; of equal sums the
    one with the longer a), and the longest second member that any pair within
    ``room`` has."""
    best, second, lo = (0, 0), 0, 0
    for hi in range(len(sizes) - 1, -1, -1):
        a = sizes[hi]
        while lo < len(sizes) and sizes[lo] + a <= room:
            lo += 1
        # sizes[:lo] fit beside a; the second member is no longer than a
        at = min(lo - 1, hi)
        if at == hi and left[a] < 2:
            at -= 1
        if at >= 0:
            b = sizes[at]
            second = max(second, b)
            if a + b > sum(best):
                best = (a, b)
    return *best, second


def _dominating(counts: dict[int, int], sizes: list[int], j: int, capacity: int) -> tuple[int, ...] | None:
    """A set with ``j`` that dominates all others with it, by lengths; None if
    these tests find none."""
    room = capacity - j
    few = _smallest(counts, sizes, j, 3)
    if not few or few[0] > room:
        return (j,)
    one = max(s for s in sizes if s <= room and counts[s] - (s == j) > 0)
    if one == room or len(few) < 2 or few[0] + few[1] > room:
        return (j, one)  # it fills the sequence, or no two fit beside j
    if len(few) == 3 and sum(few) <= room:
        return None
    left = {s: counts[s] - (s == j) for s in sizes}
    held = [s for s in sizes if left[s] > 0 and s <= room]
    a, b, second = _best_pair(left, held, room)
    if one >= a + b:
        return (j, one)  # as long as any pair together
    if a == one and b == second:
        return (j, a, b)  # longest first member and longest second member there is
    return None


def reduce(counts: dict[int, int], capacity: int) -> tuple[list[tuple[tuple[int, ...], int]], dict[int, int]]:
    """(sets fixed by dominance with how often, lengths left with their counts)."""
    counts = {s: n for s, n in counts.items() if n > 0}
    fixed = []
    changed = True
    while changed:
        changed = False
        for j in sorted(counts, reverse=True):
            while counts.get(j):
                sizes = sorted(counts)
                found = _dominating(counts, sizes, j, capacity)
                if found is None:
                    break
                times = min(counts[s] // found.count(s) for s in set(found))
                fixed.append((found, times))
                for s in found:
                    counts[s] -= times
                counts = {s: n for s, n in counts.items() if n > 0}
                changed = True
    return fixed, counts


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit, longest first, over counts; equal sequences are filled together."""
    rooms: dict[int, list[tuple[tuple[int, ...], int]]] = {}

    def put(kind: tuple[int, ...], times: int) -> None:
        if times:
            rooms.setdefault(capacity - sum(kind), []).append((kind, times))

    for s in sorted(counts, reverse=True):
        n = counts[s]
        for room in sorted(r for r in rooms if r >= s):
            kinds, rooms[room] = rooms[room], []
            each = room // s
            for kind, times in kinds:
                full = min(times, n // each)
                put(kind + (s,) * each, full)
                n -= full * each
                some = 1 if full < times and n else 0
                put(kind + (s,) * min(n, each), some)
                n -= some * min(n, each)
                put(kind, times - full - some)
            if not n:
                break
        each = capacity // s
        put((s,) * each, n // each)
        if n % each:
            put((s,) * (n % each), 1)
    return [k for kinds in rooms.values() for k in kinds]


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> dict[str, np.ndarray]:
    """Slots, sorted by (length, first): the pieces number ``first`` and on of a
    length go to sequences from ``sequence`` on, ``each`` to a sequence, from
    ``offset`` on."""
    fixed, left = reduce(counts, capacity)
    taken = dict.fromkeys(counts, 0)
    slots = []
    sequence = 0
    for kind, times in fixed + best_fit(left, capacity):
        offset = 0
        for s in sorted(set(kind), reverse=True):
            each = kind.count(s)
            slots.append((s, taken[s], sequence, each, offset))
            taken[s] += each * times
            offset += s * each
        sequence += times
    rows = np.array(sorted(slots), np.int64).reshape(-1, 5)
    return dict(zip(("length", "first", "sequence", "each", "offset"), rows.T))


def pack(
    docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end: int = END,
    with_ids: bool = False, id_column: str = "doc_id", text: str = "text",
) -> DataFrame:
    """``pieces`` with sequence_id and offset (long)."""
    spark = docs.sparkSession
    cuts = stage(pieces(docs, path, capacity, end, with_ids, id_column, text), "pieces")
    counts = stage(cuts.groupBy("_task", "length").agg(F.count(F.lit(1)).alias("_n")), "piece-counts")
    # at most ``capacity`` rows
    total = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    slots = share(spark, plan(total, capacity))
    before = Window.partitionBy("length").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("_task", "length", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    kept = [c for c in cuts.columns if c not in ("_task", "_nth")]
    numbered = cuts.join(base, ["_task", "length"]).select(*kept, (F.col("_nth") + F.col("_base")).alias("_nth"))
    schema = cuts.select(*kept).schema.add("sequence_id", "long").add("offset", "long")

    def run(batches):
        p = slots()
        far = np.int64(1 << 50)  # more than there are pieces of a length
        keys = p["length"] * far + p["first"]
        for batch in batches:
            size = batch.column("length").to_numpy(zero_copy_only=False)
            nth = batch.column("_nth").to_numpy(zero_copy_only=False)
            at = np.searchsorted(keys, size * far + nth, side="right") - 1
            place = nth - p["first"][at]
            sequence = p["sequence"][at] + place // p["each"][at]
            offset = p["offset"][at] + size * (place % p["each"][at])
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in kept] + [pa.array(sequence), pa.array(offset)], names=schema.names
            )

    return numbered.mapInArrow(run, schema)


def query(spark, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
