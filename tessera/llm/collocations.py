"""Phrase collocations by set-oriented mining (SETM).

The occurrence relation R_k holds (piece, position, phrase) of every occurrence
of a frequent phrase of k words, sorted by piece and position. R_1 comes from the
texts; then, length by length:

* merge-join: an occurrence at a position and one at the adjacent position of the
  same piece make an occurrence of the longer phrase, named by its two parts;
* group-count: occurrences per phrase;
* semi-join: only occurrences of phrases that reach ``least`` stay, and only they
  are extended. A phrase's parts occur at least as often as itself, so none is lost.

Every relation is written before the next one is made from it, as one row per
chunk of a language: the phrase at each position in order, 0 where a piece ends or
no frequent phrase stands, packed and compressed. Two neighbours that are not 0
are adjacent positions of one piece. The merge-join of sorted chunks is local;
what is shuffled are the distinct phrases of a chunk with their counts, so a
phrase that holds a third of all words is one entry per chunk, not per occurrence.
A relation is stored by chunk, so the answers about its phrases come to it and it
is not shuffled itself; once the next one is written, its files are deleted.

Group-count and semi-join share one shuffle: a chunk's phrases go as packed
blocks to buckets by a hash of the phrase, a bucket adds up and answers each chunk
which of them are frequent. There are as many buckets as keep ``BUCKET`` words
each, so a task's share does not grow with the corpus, and the hash spreads the
phrases of a frequent word over all of them. Every chunk has a block for each
bucket, so blocks grow with the square of the corpus: chunks and buckets are as
large as a task's memory allows. A chunk's words are in order of their counts and
the alphabet, which compresses both; an answer names a word by its place in the
block, which the chunk makes once more.

A phrase carries the counts of its first and last 1..k words along, from its two
parts, which is all that the cuts' scores need. They are whole numbers of up to
38 digits. A phrase that a longer candidate holds as often is held as often by
one that is one word longer, so two joins with the next length find it.

Defined cases: null and empty texts hold no words; a null lang is `und`; a piece
of any length is read whole (a long text is cut into chunks between pieces);
repeated rows count as often as they are there; equal scores and counts are
ordered by phrase; an empty table has no phrases; other columns take no part.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import mix, passing, rows_of, stage, table

LEAST = 100
LONGEST = 5
TOP = 2000
CHUNK = 2_000_000  # words of one chunk, about; a task holds twice as many
LETTERS = 16       # longer words on average: so many bytes count as a word
WINDOW = 1 << 20   # bytes of a text that are split at a time, about
BUCKET = 6_000_000  # words whose phrases are counted by one task, about
SALTS = 64

# pieces end at . , ; : ! ? and the line breaks 0A-0D; words at space and tab
_STOP = b"."
_SPLIT = bytes.maketrans(b",;:!?\n\x0b\x0c\r\t", b".........\x20")

CHUNKS = "chunk long, lang string, size long, n long, stream binary, words binary, counts binary"
RELATION = "chunk long, stream binary, ids binary"
WORD_BLOCKS = "bucket int, chunk long, lang string, words binary, counts binary"
PAIR_BLOCKS = "bucket int, chunk long, heads binary, tails binary, counts binary"
WORDS_FOUND = "bucket int, chunk long, names binary, ids binary, id long, f long, lang string, word string"
PAIRS_FOUND = "bucket int, chunk long, names binary, ids binary, id long, f long, head long, tail long"


class _Codes(dict):
    """Word -> code within a chunk; the stop is 0."""

    def __missing__(self, word: bytes) -> int:
        code = self[word] = len(self)
        return code


def _packed(values: np.ndarray) -> bytes:
    """Whole numbers as compressed bytes: the lowest bytes of all, then the next ones."""
    values = np.ascontiguousarray(values)
    planes = values.view(np.uint8).reshape(len(values), values.itemsize).T
    return zstandard.compress(planes.tobytes(), 3)


def _unpacked(data: bytes, kind: str) -> np.ndarray:
    kind = np.dtype(kind)
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(kind.itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _steps(values: np.ndarray) -> bytes:
    """Sorted numbers by their differences."""
    return _packed(np.diff(values, prepend=0).astype("<i8"))


def _from_steps(data: bytes) -> np.ndarray:
    return np.cumsum(_unpacked(data, "<i8"))


def _stream(data: bytes) -> np.ndarray:
    return _unpacked(data, "<u4").astype(np.int64)


def _listed(words: list[bytes]) -> bytes:
    """Words as compressed bytes; no word holds a line break."""
    return zstandard.compress(b"\n".join(words), 3)


def _from_listed(data: bytes) -> list[bytes]:
    data = zstandard.decompress(data)
    return data.split(b"\n") if data else []


def _joined(codes: np.ndarray) -> np.ndarray:
    """Codes without repeated zeros."""
    keep = codes != 0
    keep[1:] |= codes[:-1] != 0
    return codes[keep]


def _words(text: str) -> Iterator[tuple[list[bytes], int]]:
    """Words with A-Z lower-cased, a stop between pieces, and bytes, part by part of a text."""
    data = text.encode("utf-8", "surrogatepass").lower().translate(_SPLIT)
    start = 0
    while start < len(data):
        stop = data.find(_STOP, start + WINDOW)
        stop = len(data) if stop < 0 else stop
        yield data[start:stop].replace(b".", b" . ").split(), stop - start
        start = stop


def _chunks(batches) -> Iterator[tuple[str, _Codes, np.ndarray, int]]:
    """(lang, codes of the words, the words' codes, size) of about ``CHUNK`` words
    or less each, cut between pieces; with many languages the largest is cut first."""
    held: dict[str, tuple[_Codes, list[np.ndarray]]] = {}
    sizes: dict[str, int] = {}
    total = 0
    for langs, texts in rows_of(batches, ["lang", "text"]):
        for lang, text in zip(langs, texts):
            for words, length in _words(text or ""):
                codes, parts = held.setdefault(lang, (_Codes({_STOP: 0}), []))
                part = np.zeros(len(words) + 1, np.int32)
                part[1:] = np.fromiter(map(codes.__getitem__, words), np.int32, len(words))
                parts.append(part)
                size = max(len(part), length // LETTERS)
                sizes[lang] = sizes.get(lang, 0) + size
                total += size
                if sizes[lang] >= CHUNK or total >= 2 * CHUNK:
                    most = max(sizes, key=sizes.__getitem__)
                    codes, parts = held.pop(most)
                    size = sizes.pop(most)
                    total -= size
                    yield most, codes, np.concatenate(parts), size
    for lang, (codes, parts) in held.items():
        yield lang, codes, np.concatenate(parts), sizes[lang]


def _by_count(codes: _Codes, stream: np.ndarray) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Words by falling count, then alphabet, their counts, and the stream in their numbers."""
    counts = np.bincount(stream, minlength=len(codes))[1:]
    words = list(codes)[1:]
    order = np.fromiter(map(codes.__getitem__, sorted(words)), np.int64, len(words)) - 1
    order = order[np.argsort(-counts[order], kind="stable")]
    rank = np.zeros(len(codes), np.int64)
    rank[order + 1] = np.arange(1, len(codes))
    return [words[i] for i in order], counts[order], rank[stream]


def occurrences(docs: DataFrame) -> DataFrame:
    """R_1 with each chunk's size and number of words, its distinct words and their counts."""
    given = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text")

    def run(batches):
        base = TaskContext.get().partitionId() << 32
        for i, (lang, codes, stream, size) in enumerate(_chunks(batches)):
            words, counts, stream = _by_count(codes, stream)
            yield pa.RecordBatch.from_arrays(
                [pa.array([base + i]), pa.array([lang]), pa.array([size]), pa.array([int(counts.sum())]),
                 pa.array([_packed(_joined(stream).astype("<u4"))], pa.binary()),
                 pa.array([_listed(words)], pa.binary()), pa.array([_packed(counts.astype("<i8"))], pa.binary())],
                names=["chunk", "lang", "size", "n", "stream", "words", "counts"],
            )

    return given.mapInArrow(run, CHUNKS)


def _relation(chunk: int, stream: np.ndarray, names: np.ndarray, ids: np.ndarray) -> pa.RecordBatch | None:
    """The semi-join: of ``stream``, only the codes listed in ``names`` stay."""
    order = np.argsort(names)
    names, ids = names[order], ids[order]
    at = np.minimum(np.searchsorted(names, stream), len(names) - 1)
    kept = _joined(np.where(names[at] == stream, at + 1, 0))
    return pa.RecordBatch.from_arrays(
        [pa.array([chunk]), pa.array([_packed(kept.astype("<u4"))], pa.binary()),
         pa.array([_packed(ids)], pa.binary())],
        names=["chunk", "stream", "ids"],
    )


def _neighbours(stream: np.ndarray, n: int) -> np.ndarray:
    """The merge-join: both parts' codes at each adjacent position as one number."""
    left, right = stream[:-1], stream[1:]
    return np.where((left != 0) & (right != 0), left * (n + 1) + right, 0)


def _each(batches, *columns: str) -> Iterator[list]:
    for batch in batches:
        for row in range(batch.num_rows):
            yield [batch.column(c)[row] for c in columns]


def _known(known: pa.ListScalar) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(bucket, names, ids) of the frequent phrases of a chunk."""
    for k in known.as_py():
        yield k["bucket"], _from_steps(k["names"]), _unpacked(k["ids"], "<i8")


def _blocks(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, positions) of the buckets that occur."""
    order = np.argsort(bucket, kind="stable")
    starts = np.flatnonzero(np.diff(bucket[order], prepend=-1))
    for start, stop in zip(starts, [*starts[1:], len(order)]):
        yield int(bucket[order[start]]), order[start:stop]


def _word_buckets(words: list[bytes], buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    return _blocks((hashes % np.uint64(buckets)).astype(np.int64))


def _word_blocks(buckets: int):
    def run(batches):
        for chunk, lang, words, counts in _each(batches, "chunk", "lang", "words", "counts"):
            words, counts = _from_listed(words.as_py()), _unpacked(counts.as_py(), "<i8")
            for b, at in _word_buckets(words, buckets):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b], pa.int32()), pa.array([chunk.as_py()]), pa.array([lang.as_py()]),
                     pa.array([_listed([words[i] for i in at])], pa.binary()),
                     pa.array([_packed(counts[at])], pa.binary())],
                    names=["bucket", "chunk", "lang", "words", "counts"])

    return run


def _found(schema: pa.Schema, bucket: int, answers: list[tuple], phrases: dict[str, pa.Array]) -> pa.Table:
    """Answers (chunk, names, ids) and frequent phrases as rows of ``schema``."""
    n = len(phrases["id"])
    columns = {
        "bucket": [bucket] * (len(answers) + n),
        "chunk": [a[0] for a in answers] + [None] * n,
        "names": [_steps(a[1]) for a in answers] + [None] * n,
        "ids": [_packed(a[2].astype("<i8")) for a in answers] + [None] * n,
    }
    arrays = [
        pa.array(columns[f.name], f.type) if f.name in columns
        else pa.concat_arrays([pa.nulls(len(answers), f.type), phrases[f.name].cast(f.type)]) for f in schema
    ]
    return pa.Table.from_arrays(arrays, schema=schema)


def _count_words(least: int, schema: pa.Schema):
    def run(rows: pa.Table) -> pa.Table:
        bucket = rows.column("bucket")[0].as_py()
        r = rows.select(["chunk", "lang", "counts"]).to_pylist()
        words = [pa.array(_from_listed(w.as_py()), pa.binary()).cast(pa.string()) for w in rows.column("words")]
        sizes = [len(w) for w in words]
        table = pa.table({
            "lang": pa.array([x["lang"] for x in r]).dictionary_encode().take(pa.array(np.repeat(np.arange(len(r)), sizes))),
            "word": pa.concat_arrays(words), "n": np.concatenate([_unpacked(x["counts"], "<i8") for x in r])})
        sums = table.group_by(["lang", "word"]).aggregate([("n", "sum")])
        sums = sums.filter(pc.greater_equal(sums["n_sum"], least)).combine_chunks()
        ids = (bucket << 40) + np.arange(sums.num_rows)
        langs = np.array(sums["lang"].to_pylist(), object)
        answers, by_lang = [], {}
        for x, w in zip(r, words):
            if x["lang"] not in by_lang:
                at = np.flatnonzero(langs == x["lang"])
                by_lang[x["lang"]] = at, _whole(sums["word"]).take(pa.array(at))
            at, value_set = by_lang[x["lang"]]
            place = pc.index_in(w, value_set=value_set).to_numpy(zero_copy_only=False)
            hit = np.flatnonzero(~np.isnan(place)) if place.dtype.kind == "f" else np.arange(len(place))
            if len(hit) and len(at):
                answers.append((x["chunk"], hit, ids[at[place[hit].astype(np.int64)]]))
        return _found(schema, bucket, answers, {
            "id": pa.array(ids), "f": _whole(sums["n_sum"]), "lang": pa.array(langs, pa.string()),
            "word": _whole(sums["word"])})

    return run


def _whole(column: pa.ChunkedArray) -> pa.Array:
    return pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)


def _first(buckets: int):
    """R_1 with the words of a chunk that are frequent (``known``)."""
    def run(batches):
        for chunk, stream, words, known in _each(batches, "chunk", "stream", "words", "known"):
            blocks = dict(_word_buckets(_from_listed(words.as_py()), buckets))
            names, ids = zip(*((blocks[b][at], ids) for b, at, ids in _known(known)))
            yield _relation(chunk.as_py(), _stream(stream.as_py()), np.concatenate(names) + 1, np.concatenate(ids))

    return run


def _pairs(stream: np.ndarray, ids: np.ndarray, buckets: int):
    """Distinct longer phrases of a chunk, sorted by the ids of their parts: as
    neighbours' numbers, heads, tails, counts and buckets."""
    order = np.argsort(ids)
    rank = np.zeros(len(ids) + 1, np.int64)
    rank[order + 1] = np.arange(1, len(ids) + 1)
    ids = ids[order]
    near = _neighbours(rank[stream], len(ids))
    kinds, counts = np.unique(near[near != 0], return_counts=True)
    head, tail = ids[kinds // (len(ids) + 1) - 1], ids[kinds % (len(ids) + 1) - 1]
    mixed = mix(mix(head.astype(np.uint64)) + tail.astype(np.uint64))
    return near, kinds, head, tail, counts, (mixed % np.uint64(buckets)).astype(np.int64)


def _pair_blocks(buckets: int):
    def run(batches):
        for chunk, stream, ids in _each(batches, "chunk", "stream", "ids"):
            ids = _unpacked(ids.as_py(), "<i8")
            _, _, head, tail, counts, bucket = _pairs(_stream(stream.as_py()), ids, buckets)
            for b, at in _blocks(bucket):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b], pa.int32()), pa.array([chunk.as_py()]), pa.array([_steps(head[at])], pa.binary()),
                     pa.array([_packed(tail[at])], pa.binary()), pa.array([_packed(counts[at])], pa.binary())],
                    names=["bucket", "chunk", "heads", "tails", "counts"])

    return run


def _count_pairs(least: int, schema: pa.Schema):
    def run(rows: pa.Table) -> pa.Table:
        bucket = rows.column("bucket")[0].as_py()
        r = rows.to_pylist()
        heads = [_from_steps(x["heads"]) for x in r]
        block = np.repeat(np.arange(len(r)), [len(h) for h in heads])
        place = np.concatenate([np.arange(len(h)) for h in heads])
        head, tail = np.concatenate(heads), np.concatenate([_unpacked(x["tails"], "<i8") for x in r])
        n = np.concatenate([_unpacked(x["counts"], "<i8") for x in r])
        order = np.lexsort((tail, head))
        head, tail = head[order], tail[order]
        start = np.ones(len(order), bool)
        start[1:] = (head[1:] != head[:-1]) | (tail[1:] != tail[:-1])
        first = np.flatnonzero(start)
        sums = np.add.reduceat(n[order], first)
        good = sums >= least
        ids = np.full(len(first), -1, np.int64)
        ids[good] = (bucket << 40) + np.arange(good.sum())
        id_of = np.empty(len(order), np.int64)
        id_of[order] = ids[np.cumsum(start) - 1]
        answers = []
        hit = np.flatnonzero(id_of >= 0)  # in order of blocks and places
        for i, at in _blocks(block[hit]):
            answers.append((r[i]["chunk"], place[hit[at]], id_of[hit[at]]))
        kept = first[good]
        return _found(schema, bucket, answers, {
            "id": pa.array(ids[good]), "f": pa.array(sums[good]), "head": pa.array(head[kept]),
            "tail": pa.array(tail[kept])})

    return run


def _next(buckets: int):
    """R_k+1 from R_k and the frequent ones among a chunk's longer phrases."""
    def run(batches):
        for chunk, stream, ids, known in _each(batches, "chunk", "stream", "ids", "known"):
            ids = _unpacked(ids.as_py(), "<i8")
            near, kinds, _, _, _, bucket = _pairs(_stream(stream.as_py()), ids, buckets)
            blocks = dict(_blocks(bucket))
            names, new = zip(*((kinds[blocks[b][at]], ids) for b, at, ids in _known(known)))
            yield _relation(chunk.as_py(), near, np.concatenate(names), np.concatenate(new))

    return run


_TYPES = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}


def _counted(
    blocks: DataFrame, count, least: int, ddl: str, label: str
) -> tuple[DataFrame, DataFrame, Callable[[], None]]:
    """Frequent phrases with their ids, per chunk which of its own they are, and a
    function that deletes both."""
    schema = pa.schema([(f.split()[0], _TYPES[f.split()[1]]) for f in ddl.split(", ")])
    found, answered = passing(blocks.groupBy("bucket").applyInArrow(count(least, schema), ddl), label)
    known = found.filter("chunk IS NOT NULL").groupBy("chunk").agg(
        F.collect_list(F.struct("bucket", "names", "ids")).alias("known"))
    return found.filter("id IS NOT NULL").drop("bucket", "chunk", "names", "ids"), known, answered


def phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST) -> tuple[list[DataFrame], DataFrame]:
    """Frequent phrases by length, from 1 (id, lang, phrase, last, heads, tails, and
    head and tail: the ids of all but the last and all but the first word), where
    heads and tails count the first and last 1..k words; and (lang, n)."""
    relation, read = passing(occurrences(docs), "occurrences", "chunk")
    totals = stage(relation.groupBy("lang").agg(F.sum("n").alias("n")), "lang-words")
    buckets = 1 + (relation.agg(F.sum("size")).first()[0] or 0) // BUCKET
    blocks = relation.select("chunk", "lang", "words", "counts").mapInArrow(_word_blocks(buckets), WORD_BLOCKS)
    found, known, answered = _counted(blocks, _count_words, least, WORDS_FOUND, "words")
    levels = [stage(found.select(
        "id", "lang", F.col("word").alias("phrase"), F.col("word").alias("last"),
        F.array("f").alias("heads"), F.array("f").alias("tails")), "level-1")]
    extended = relation.select("chunk", "stream", "words").join(known, "chunk").mapInArrow(_first(buckets), RELATION)
    for k in range(2, longest + 1):
        relation, read_next = passing(extended, f"phrases-{k - 1}", "chunk")
        read()
        answered()
        read = read_next
        blocks = relation.mapInArrow(_pair_blocks(buckets), PAIR_BLOCKS)
        found, known, answered = _counted(blocks, _count_pairs, least, PAIRS_FOUND, f"pairs-{k}")
        extended = relation.join(known, "chunk").mapInArrow(_next(buckets), RELATION)
        short = levels[-1].select("id", "lang", "phrase", "last", "heads", "tails")
        head, tail = short.alias("h"), short.alias("t")
        own = F.array("f")
        level = found.join(head, F.col("head") == F.col("h.id")).join(tail, F.col("tail") == F.col("t.id"))
        levels.append(stage(level.select(
            found["id"], F.col("h.lang").alias("lang"), F.concat("h.phrase", F.lit(" "), "t.last").alias("phrase"),
            F.col("t.last").alias("last"), F.concat("h.heads", own).alias("heads"),
            F.concat("t.tails", own).alias("tails"), "head", "tail"), f"level-{k}"))
    read()
    answered()
    return levels, totals


def _scored(level: DataFrame, k: int, totals: DataFrame) -> DataFrame:
    """a, l, r, n and the score of the lowest-scoring cut."""
    wide = lambda c: c.cast("decimal(20,0)")
    a = F.element_at("heads", k)
    joined = level.join(totals, "lang").withColumn("a", a)
    cuts = []
    for j in range(1, k):
        l, r = F.element_at("heads", j), F.element_at("tails", k - j)
        top = (wide(F.col("a")) * wide(F.col("n"))).cast("decimal(34,0)") * F.lit(1000).cast("decimal(4,0)")
        low = (wide(l) * wide(r)).cast("decimal(38,0)")
        joined = joined.withColumn(f"_top{j}", top).withColumn(f"_low{j}", low)
        score = F.expr(f"_top{j} div _low{j}")
        cuts.append(F.struct(score.alias("score"), F.lit(j).alias("k"), l.alias("l"), r.alias("r")))
    best = cuts[0] if k == 2 else F.least(*cuts)  # the smallest score, then the smallest k
    return joined.withColumn("_cut", best).select(
        "id", "lang", "phrase", "a", F.col("_cut.l").alias("l"), F.col("_cut.r").alias("r"), "n",
        F.col("_cut.score").alias("score"))


def collocations(
    docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's ``top`` phrases."""
    levels, totals = phrases(docs, least, longest)
    kept = []
    for k in range(2, longest + 1):
        rows = _scored(levels[k - 1], k, totals)
        if k < longest:
            longer = levels[k].select("head", "tail", F.element_at("heads", k + 1).alias("_f"))
            inside = longer.select(F.col("head").alias("_id"), "_f").union(
                longer.select(F.col("tail").alias("_id"), "_f"))
            rows = rows.join(inside, (rows["id"] == inside["_id"]) & (rows["a"] == inside["_f"]), "left_anti")
        kept.append(rows.drop("id"))
    rows = reduce(DataFrame.union, kept)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # a language's phrases are ranked in parts first, so no task meets them all
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).orderBy(*order)
    first = rows.withColumn("_nth", F.row_number().over(part)).filter(F.col("_nth") <= top).drop("_nth")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    ranked = first.withColumn("rank", rank)
    return ranked.filter(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def query(spark, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


def _oracle() -> str:
    """Plain counting: every run of 1 to 5 words of every piece."""
    cuts = " UNION ALL ".join(
        f"SELECT lang, phrase, a, ws, k, {j} AS j, array_to_string(ws[1:{j}], ' ') AS head, "
        f"array_to_string(ws[{j + 1}:], ' ') AS tail FROM cand WHERE k > {j}" for j in range(1, LONGEST))
    grams = " UNION ALL ".join(
        f"SELECT lang, {k} AS k, unnest(list_transform(range(len(ws) - {k - 1}), lambda i: ws[i + 1:i + {k}])) AS ws "
        f"FROM pieces WHERE len(ws) >= {k}" for k in range(1, LONGEST + 1))
    return f"""
WITH texts AS (
  SELECT coalesce(lang, 'und') AS lang,
         translate("text", 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
parts AS (
  SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\\x0A-\\x0D]')) AS p FROM texts WHERE t IS NOT NULL),
pieces AS (
  SELECT lang, list_filter(regexp_split_to_array(p, '[\\x20\\x09]'), lambda w: w <> '') AS ws FROM parts),
totals AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM pieces GROUP BY lang),
grams AS ({grams}),
f AS (SELECT lang, k, array_to_string(ws, ' ') AS phrase, any_value(ws) AS ws, count(*) AS a
      FROM grams GROUP BY 1, 2, 3 HAVING count(*) >= {LEAST}),
cand AS (SELECT * FROM f WHERE k >= 2),
cuts AS ({cuts}),
scored AS (
  SELECT c.lang, c.phrase, c.a, h.a AS l, t.a AS r, n, c.j,
         ((1000::HUGEINT * c.a * n) // (h.a::HUGEINT * t.a))::BIGINT AS score
  FROM cuts c JOIN f h ON h.lang = c.lang AND h.phrase = c.head JOIN f t ON t.lang = c.lang AND t.phrase = c.tail
  JOIN totals ON totals.lang = c.lang),
best AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) AS nth FROM scored),
inside AS (
  SELECT lang, array_to_string(unnest([ws[1:k - 1], ws[2:]]), ' ') AS phrase, a FROM cand WHERE k > 2),
kept AS (
  SELECT b.* FROM best b WHERE nth = 1 AND NOT EXISTS (
    SELECT 1 FROM inside i WHERE i.lang = b.lang AND i.phrase = b.phrase AND i.a >= b.a)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score
FROM ranked WHERE rank <= {TOP}
"""


ORACLE_SQL = _oracle()
