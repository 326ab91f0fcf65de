"""Conversation prefix trie: union-find over the LCP edges of sorted neighbours.

A conversation is a sequence of turns; a node is a distinct sequence of first
turns. Conversations are range-partitioned and sorted by their turns' hashes, so
those below a node are neighbours, and the edge between two neighbours weighs
the length of their longest common prefix (LCP).

In a partition the edges are taken in descending depth. An edge of depth d lifts
the components of its two ends to depth d, which settles the nodes on the way up,
and merges them; a merge makes a branching node. A component holds only sums over
its current node, so every node costs one step.

A node that is a prefix of the partition's first or last conversation may go on
in the neighbouring partitions. Those two paths are what a partition's forest is
contracted to: a first and a last row with, for each depth, the sums of all that
hangs there. The contracted forests of ``FAN`` neighbouring partitions are merged
by the same routine over rows with sums instead of conversations, in rounds until
one forest is left. A child that is settled before its parent refers to the
parent by the hash of its turns and gets the parent's smallest member by a join
with the nodes settled in these rounds.

What is bounded: a task holds the LCPs of its partition and a few numbers per
turn, never texts; a round's group holds 2 * ``FAN`` paths. Copies of one
conversation are dealt over partitions by conv_id; a node's list of members that
end there is written in pieces by the tasks that saw them and hashed in order as
a stream. Turns are told apart by 128 bits of the hash of role and text.

Defined cases: rows without conv_id belong to no conversation and take no part;
null role and text are empty; turns of equal number (and null ones, first) are
ordered by role, then text, and repeated rows each count as a turn; a
conversation's list of turn hashes has to fit a task; an empty table has no
conversation and no node; other columns take no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import stage, table

FAN = 64
SEGMENT = 1 << 20  # bytes of one piece of a member list, about
WIDTH = 16         # bytes of a turn's hash
NO_ONE = (1 << 63) - 1
NONE = hashlib.sha256(b"").hexdigest()

FIGURES = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")
NODE = ", ".join(f"{c} long" for c in FIGURES) + ", ends_sha256 string, node binary, parent binary"
# a contracted path: sums per depth, from the root on
PATH = ("at int, last boolean, key binary, sizes array<int>, own array<long>, least array<long>, "
        "kids array<long>, leaves array<long>, saved array<long>")
SEGMENTS = "ends_of binary, part int, nth int, ids string"


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, keys, sizes): hex hashes and text bytes of each one's turns, in order."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("_role"), text.alias("_text"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "_role", "_text")
    rows = rows.select(
        "conv_id", F.row_number().over(order).alias("_nth"),
        F.md5(F.concat(F.octet_length("_role").cast("string"), F.lit(":"), "_role", "_text")).alias("_key"),
        F.octet_length("_text").alias("_size"))
    one = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("_nth", "_key", "_size"))).alias("_t"))
    return one.select("conv_id", F.col("_t._key").alias("keys"), F.col("_t._size").alias("sizes"))


def rebuilt(conversations: DataFrame) -> DataFrame:
    """``turns`` of every conversation c with its first h turns, h = crc32(c) % 9,
    replaced by the first h of conversation c - c % 5."""
    own = stage(turns(conversations), "turns")
    base = own.select(F.col("conv_id").alias("_base"), F.slice("keys", 1, 8).alias("_keys"),
                      F.slice("sizes", 1, 8).alias("_sizes"))
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(9)).cast("int")
    found = own.withColumn("_h", h).join(base, F.col("conv_id") - F.col("conv_id") % 5 == F.col("_base"), "left")

    def spliced(name: str):
        head = F.coalesce(F.col(f"_{name}"), F.array().cast(found.schema[name].dataType))
        rest = F.slice(name, F.col("_h") + 1, F.greatest(F.size(name) - F.col("_h"), F.lit(0)))
        return F.concat(F.slice(head, F.lit(1), F.col("_h")), rest).alias(name)

    return found.select("conv_id", spliced("keys"), spliced("sizes"))


def _common(a: bytes, b: bytes) -> int:
    """Number of equal first turns of two keys."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n // WIDTH
    x = np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n)
    return int(x.argmax()) // WIDTH


def _names(key: bytes) -> list[bytes]:
    """Hash of every prefix of a key, the root's first."""
    h = hashlib.blake2b(digest_size=16)
    out = [h.digest()]
    for at in range(0, len(key), WIDTH):
        h.update(key[at : at + WIDTH])
        out.append(h.digest())
    return out


class _Part:
    """A component: consecutive rows, and the sums at their node of ``depth``."""

    __slots__ = ("low", "high", "depth", "sums", "above", "waiting")

    def __init__(self, row: int, depth: int, above: dict[int, list[int]]):
        self.low = self.high = row
        self.depth = depth
        self.above = above           # depth -> sums that join there
        self.waiting: list[list] = []  # settled children whose parent is this node
        self.sums = above.pop(depth, None) or [0, NO_ONE, 0, 0, 0]


def _add(a: list[int], b: list[int]) -> list[int]:
    """Members, smallest member, children, leaves, saved bytes."""
    return [a[0] + b[0], min(a[1], b[1]), a[2] + b[2], a[3] + b[3], a[4] + b[4]]


class Forest:
    """The forest of one run of sorted rows: ``common`` are the LCPs of neighbours;
    each row has ``sizes`` (text bytes by turn) and ``above`` (depth -> sums).
    ``names`` gives the hashes of the prefixes of some rows, the first and last
    among them. ``whole``: nothing lies outside, so all settles. ``ends`` gives the
    digest of a settled node's list, ``opened`` is told of nodes on the two paths."""

    def __init__(self, common, sizes, above, names, whole=False, ends=None, opened=None):
        self.n = len(sizes)
        self.common, self.sizes, self.names = common, sizes, names
        self.whole, self.ends, self.opened = whole, ends, opened
        self.paths = ({}, {})  # of the first and the last row: depth -> sums
        self.settled: list[list] = []
        self.parts = [_Part(i, len(s), a) for i, (s, a) in enumerate(zip(sizes, above))]
        self.root = list(range(self.n))
        self._build()

    def _find(self, i: int) -> int:
        root = self.root
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    def _settle(self, c: _Part) -> None:
        """The node of ``c`` has all its sums: write it or put it on its path."""
        name = self.names.get(c.low) or self.names.get(c.high)
        name = name[c.depth] if name else None
        if not self.whole and (c.low == 0 or c.high == self.n - 1):
            self.paths[0 if c.low == 0 else 1][c.depth] = c.sums
            if self.opened:
                self.opened(c, name)
            for node in c.waiting:
                node[-1] = name
            c.sums, c.waiting = [0, NO_ONE, 0, 0, 0], []
            return
        members, least, kids, leaves, saved = c.sums
        if c.depth:
            saved += (members - 1) * int(self.sizes[c.low][c.depth - 1])
        leaves = leaves if kids else 1
        for node in c.waiting:
            node[2] = least
        digest = self.ends(c) if self.ends else None
        node = [least, c.depth, None, members, kids, leaves, saved, digest, name, None]
        self.settled.append(node)
        c.sums, c.waiting = [members, least, 1, leaves, saved], [node]

    def _lift(self, c: _Part, depth: int) -> None:
        while c.depth > depth:
            self._settle(c)
            c.depth -= 1
            more = c.above.pop(c.depth, None)
            if more:
                c.sums = _add(c.sums, more)

    def _build(self) -> None:
        for i in np.argsort(-np.asarray(self.common, np.int64), kind="stable").tolist():
            a, b = self._find(i), self._find(i + 1)
            left, right = self.parts[a], self.parts[b]
            self._lift(left, self.common[i])
            self._lift(right, self.common[i])
            left.sums = _add(left.sums, right.sums)
            if len(left.waiting) < len(right.waiting):
                left.waiting, right.waiting = right.waiting, left.waiting
            left.waiting += right.waiting
            if len(left.above) < len(right.above):
                left.above, right.above = right.above, left.above
            for d, sums in right.above.items():
                left.above[d] = _add(left.above[d], sums) if d in left.above else sums
            left.high = right.high
            self.root[b] = a
            self.parts[b] = None
        top = self.parts[self._find(0)]
        self._lift(top, 0)
        self._settle(top)

    def contracted(self, at: int, keys: tuple[bytes, bytes]) -> list[tuple]:
        """The first and, where it leaves the first's path, the last row's path."""
        out = []
        for side, path in enumerate(self.paths):
            if side and not path:
                continue
            sizes = [int(s) for s in self.sizes[-side]]
            sums = [path.get(d, [0, NO_ONE, 0, 0, 0]) for d in range(len(sizes) + 1)]
            out.append((at, bool(side), keys[side], sizes, *map(list, zip(*sums))))
        return out


def _partition(at: int, batches) -> tuple[list, list, list]:
    """(nodes, paths, segments) of one sorted partition of conversations."""
    ids, sizes, common, first, last = [], [], [], None, None
    for batch in batches:
        for key, some, conv in zip(*(batch.column(c).to_pylist() for c in ("key", "sizes", "conv_id"))):
            if first is None:
                first = key
            else:
                common.append(_common(last, key))
            last = key
            ids.append(conv)
            sizes.append(np.asarray(some, np.int32))
    if first is None:
        return [], [], []
    segments: list[tuple] = []

    def members(c: _Part) -> list[str]:
        """Those that end at the node, in order: they come first among its rows."""
        stop = c.low
        while stop <= c.high and len(sizes[stop]) == c.depth:
            stop += 1
        return list(map(str, ids[c.low : stop]))

    def ends(c: _Part) -> str:
        return hashlib.sha256(",".join(members(c)).encode()).hexdigest()

    def opened(c: _Part, name: bytes) -> None:
        found, step = members(c), SEGMENT // 20
        for nth, i in enumerate(range(0, len(found), step)):
            segments.append((name, at, nth, ",".join(found[i : i + step])))

    above = [{len(s): [1, i, 0, 0, 0]} for s, i in zip(sizes, ids)]
    names = {len(ids) - 1: _names(last), 0: _names(first)}
    forest = Forest(common, sizes, above, names, ends=ends, opened=opened)
    return forest.settled, forest.contracted(at, (first, last)), segments


def _merged(paths: pa.Table, whole: bool) -> tuple[list, list]:
    """(nodes, paths) of the contracted forests of one group."""
    r = paths.sort_by([("at", "ascending"), ("last", "ascending")]).to_pydict()
    keys = r["key"]
    above = [
        {d: list(s) for d, s in enumerate(zip(*(r[c][i] for c in ("own", "least", "kids", "leaves", "saved")))) if s[0]}
        for i in range(len(keys))
    ]
    common = [_common(a, b) for a, b in zip(keys, keys[1:])]
    forest = Forest(common, r["sizes"], above, dict(enumerate(map(_names, keys))), whole)
    return forest.settled, [] if whole else forest.contracted(r["at"][0] // FAN, (keys[0], keys[-1]))


def _batch(schema, nodes, paths, segments) -> pa.RecordBatch:
    """Rows of the three kinds under one schema, nulls elsewhere."""
    n = [len(FIGURES) + 3, 9, 4]
    empty = [(None,) * k for k in n]
    rows = [(*x, *empty[1], *empty[2]) for x in map(tuple, nodes)]
    rows += [(*empty[0], *x, *empty[2]) for x in paths]
    rows += [(*empty[0], *empty[1], *x) for x in segments]
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


_TYPES = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary(), "string": pa.string(),
          "array<int>": pa.list_(pa.int32()), "array<long>": pa.list_(pa.int64())}


def _arrow(ddl: str) -> pa.Schema:
    return pa.schema([(f.split()[0], _TYPES[f.split()[1]]) for f in ddl.split(", ")])


def _merge(schema: pa.Schema, whole: bool):
    def merge(rows: pa.Table) -> pa.Table:
        return pa.Table.from_batches([_batch(schema, *_merged(rows, whole), [])])

    return merge


def trie(sequences: DataFrame) -> DataFrame:
    """Nodes of the trie of ``sequences`` (conv_id, keys as hex, sizes)."""
    given = stage(sequences.select("conv_id", F.unhex(F.array_join("keys", "")).alias("key"), "sizes"), "rebuilt")
    ordered = given.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    ddl = f"{NODE}, {PATH}, {SEGMENTS}"
    schema = _arrow(ddl)

    def settle(batches):
        found = _partition(TaskContext.get().partitionId(), batches)
        for at in range(0, max(map(len, found)), 20_000):
            yield _batch(schema, *(kind[at : at + 20_000] for kind in found))

    out = stage(ordered.mapInArrow(settle, ddl), "trie")
    node_columns, path_columns = ([f.split()[0] for f in x.split(", ")] for x in (NODE, PATH))
    early = out.filter("depth IS NOT NULL").select(*node_columns)
    paths = out.filter("at IS NOT NULL").select(*path_columns)
    segments = out.filter("ends_of IS NOT NULL").select("ends_of", "part", "nth", "ids")
    late = None
    last = paths.agg(F.max("at")).first()[0]
    while True:
        whole = last is None or last < FAN

        grouped = paths.withColumn("_group", F.floor(F.col("at") / FAN)).groupBy("_group")
        step = stage(grouped.applyInArrow(_merge(schema, whole), ddl), "trie-merge")
        nodes = step.filter("depth IS NOT NULL").select(*node_columns)
        late = nodes if late is None else late.union(nodes)
        if whole:
            break
        paths = step.filter("at IS NOT NULL").select(*path_columns)
        last //= FAN
    ends = _ends(segments)
    late = stage(
        late.join(ends, F.col("node") == F.col("ends_of"), "left").select(
            *FIGURES, F.coalesce("_sha", F.lit(NONE)).alias("ends_sha256"), "node", "parent"), "trie-late")
    known = late.select(F.col("node").alias("_node"), F.col("conv_id").alias("_least"))
    every = early.union(late)
    result = [*FIGURES, "ends_sha256"]
    done = every.filter("parent IS NULL").select(*result)
    waiting = every.filter("parent IS NOT NULL").join(known, F.col("parent") == F.col("_node"))
    return done.union(waiting.withColumn("parent_conv_id", F.col("_least")).select(*result))


def _ends(segments: DataFrame) -> DataFrame:
    """(ends_of, _sha) of the member lists written in pieces, hashed as a stream."""
    schema = _arrow("ends_of binary, _sha string")

    def run(batches):
        name, h, out = None, None, []
        for batch in batches:
            for of, ids in zip(batch.column("ends_of").to_pylist(), batch.column("ids").to_pylist()):
                if of != name:
                    if name is not None:
                        out.append((name, h.hexdigest()))
                    name, h = of, hashlib.sha256()
                else:
                    h.update(b",")
                h.update(ids.encode())
        if name is not None:
            out.append((name, h.hexdigest()))
        columns = list(zip(*out)) if out else [(), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    ordered = segments.repartition("ends_of").sortWithinPartitions("ends_of", "part", "nth")
    return ordered.mapInArrow(run, "ends_of binary, _sha string")


def query(spark, sf_dir: str) -> DataFrame:
    return trie(rebuilt(table(spark, sf_dir, "conversations")))


# zlib's crc32 by table, over the decimal digits
_CRC = """
  SELECT conv_id, xor(list_reduce(list_concat([4294967295::BIGINT],
      list_transform(string_split(conv_id::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT)),
      lambda acc, b: xor(acc >> 8, crc_table.t[(xor(acc, b) & 255) + 1])), 4294967295::BIGINT) % 9 AS h
  FROM ids, crc_table"""

ORACLE_SQL = f"""
WITH rows AS (
  SELECT conv_id, coalesce("text", '') AS txt, md5(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '')
           || coalesce("text", '')) AS k,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce("text", '')) AS nth
  FROM conversations WHERE conv_id IS NOT NULL),
crc_table AS (
  SELECT list(x ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_concat([i::BIGINT], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
      lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END) AS x
    FROM range(256) r(i))),
ids AS (SELECT DISTINCT conv_id FROM rows),
heads AS ({_CRC}),
built AS (
  SELECT heads.conv_id, r.nth, r.k, strlen(r.txt) AS size FROM heads JOIN rows r
    ON r.conv_id = heads.conv_id - heads.conv_id % 5 AND r.nth <= heads.h
  UNION ALL
  SELECT heads.conv_id, r.nth, r.k, strlen(r.txt) FROM heads JOIN rows r
    ON r.conv_id = heads.conv_id AND r.nth > heads.h),
seqs AS (
  SELECT ids.conv_id, coalesce(list(k ORDER BY nth) FILTER (WHERE k IS NOT NULL), []) AS ks,
         coalesce(list(size ORDER BY nth) FILTER (WHERE k IS NOT NULL), []) AS sizes
  FROM ids LEFT JOIN built USING (conv_id) GROUP BY ids.conv_id),
prefixes AS (
  SELECT conv_id, d, len(ks) AS n, array_to_string(ks[1:d], '') AS node,
         CASE WHEN d > 0 THEN array_to_string(ks[1:d - 1], '') END AS up,
         CASE WHEN d > 0 THEN sizes[d] ELSE 0 END AS size
  FROM (SELECT *, unnest(range(len(ks) + 1)) AS d FROM seqs)),
nodes AS (
  SELECT node, d, any_value(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(size) AS size,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE n = d), '')) AS ends_sha256
  FROM prefixes GROUP BY node, d),
kids AS (SELECT up, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY up),
full_nodes AS (
  SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN kids ON kids.up = nodes.node),
below AS (
  SELECT substr(node, 1, 32 * a) AS above, n_children, (n_convs - 1) * size AS saved
  FROM (SELECT *, unnest(range(d + 1)) AS a FROM full_nodes)),
sums AS (
  SELECT above, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum(saved) AS saved_tokens FROM below GROUP BY above)
SELECT x.conv_id::BIGINT AS conv_id, x.d::BIGINT AS depth, p.conv_id::BIGINT AS parent_conv_id,
       x.n_convs::BIGINT AS n_convs, x.n_children::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves,
       saved_tokens::BIGINT AS saved_tokens, x.ends_sha256
FROM full_nodes x LEFT JOIN nodes p ON p.node = x.up JOIN sums ON sums.above = x.node
"""
