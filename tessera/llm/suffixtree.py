"""LM scoring with a probabilistic suffix tree over words.

Symbols are the words of training texts, the end of a text, and one symbol for
every word not seen in training, as in the base score. A context is one or two
words back. It becomes a state of the tree when its next-symbol distribution
diverges from that of the longest state that is its suffix: occurrences times
Kullback-Leibler divergence must exceed ``GAIN`` nats for each follower it
keeps. Followers are kept where the context and the follower together make up
``LEAST`` of all tokens or more. Distributions are smoothed by an absolute
discount: kept followers lose it, and what is left goes to all other symbols in
proportion to the suffix state; at the root it goes to the unseen symbol. Every
token is predicted from the longest suffix state, so ``score`` is the log10 of
a proper distribution over the same symbols as ``base_score``.

Plan: words are counted per task, then summed by a shuffle. Word sequences are
counted level by level as codes (context's place, follower's place), only where
all parts are frequent already, which loses none that reaches the threshold.
Each level holds at most 1 / LEAST sequences whatever the input, and as many words
reach the threshold, so states are broadcast with all of these words, filled up to
the ``COMMON`` most frequent ones. Tokens that are not among those meet their counts
in a join on the word, whose keys are rare by construction, and everything is summed
per document.

Defined cases: null or empty text is the end token alone; without training rows
N and V are 0 and each token has probability 1 in the base score and the model;
each row is scored for itself, so ids may repeat or be null (a null id counts
as '' for the hold-out).
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import crc_mod, share, stage, table, words_of

DEPTH = 2
LEAST = 1e-6
GAIN = 3.0
COMMON = 150_000
HELD = 2
END = b"\n"  # no word holds it


def count_words(docs: DataFrame) -> DataFrame:
    """word (binary), c: all tokens of ``docs``, the end tokens included."""

    def run(batches):
        held: Counter = Counter()

        def flush():
            out = pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())],
                names=["word", "n"])
            held.clear()
            return out

        for batch in batches:
            for at in range(0, batch.num_rows, 1_000):
                texts = batch.slice(at, 1_000).column("text").to_pylist()
                for t in texts:
                    held.update(words_of(t))
                held[END] += len(texts)
                if len(held) > 400_000:
                    yield flush()
        if held:
            yield flush()

    return docs.select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(
        F.sum("n").alias("c")
    )


def _places(keys: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Place of each code in sorted keys, -1 where it is not among them."""
    if not len(keys):
        return np.full(len(codes), -1, np.int64)
    at = np.minimum(np.searchsorted(keys, codes), len(keys) - 1)
    return np.where((codes >= 0) & (keys[at] == codes), at, -1)


class Tree:
    """Frequent words by place, frequent sequences and states by level.

    ``words`` are ordered by count, descending; the first ``frequent`` of them
    can be part of a sequence. ``codes[k]`` holds the sorted codes of sequences
    of k + 2 words: place of the first k + 1 among theirs, times ``frequent``,
    plus the place of the last word.
    """

    def __init__(self, words: list[bytes], counts: np.ndarray, frequent: int, root: np.ndarray):
        self.index = {w: i for i, w in enumerate(words)}
        self.counts, self.frequent, self.root = counts, frequent, root
        self.codes: list[np.ndarray] = []
        self.logp: list[np.ndarray] = []    # log10 of the last word after the others; 0 where not a state's
        self.rest: list[np.ndarray] = []    # log10 of the factor for other symbols, nan where not a state

    def ids(self, text: str | None) -> tuple[np.ndarray, list[bytes]]:
        words = [*words_of(text), END]
        get = self.index.get
        return np.fromiter((get(w, -1) for w in words), np.int64, len(words)), words

    def sequences(self, ids: np.ndarray) -> list[np.ndarray]:
        """Per level, the place of the sequence that ends at each token."""
        ids = np.where(ids < self.frequent, ids, -1)
        out = [ids]
        for keys in self.codes:
            before = np.concatenate([[-1], out[-1][:-1]])
            code = np.where((before >= 0) & (ids >= 0), before * self.frequent + ids, -1)
            out.append(_places(keys, code))
        return out

    def next_codes(self, ids: np.ndarray) -> np.ndarray:
        """Codes one level up, of all sequences whose parts are frequent."""
        ids_ = np.where(ids < self.frequent, ids, -1)
        last = self.sequences(ids)[-1]
        before = np.concatenate([[-1], last[:-1]])
        use = (before >= 0) & (ids_ >= 0)
        return before[use] * self.frequent + ids_[use]

    def score(self, ids: np.ndarray) -> tuple[float, np.ndarray]:
        """log10 without the root's part, and the tokens that come to the root."""
        places = self.sequences(ids)
        open_, total = np.ones(len(ids), bool), 0.0
        for k in range(len(self.rest) - 1, -1, -1):
            context = np.concatenate([[-1], places[k][:-1]])
            state = (context >= 0) & ~np.isnan(self.rest[k][context]) & open_ if len(self.rest[k]) else np.zeros(len(ids), bool)
            seq = places[k + 1]
            kept = state & (seq >= 0)
            total += self.logp[k][seq[kept]].sum() + self.rest[k][context[state & ~kept]].sum()
            open_ &= ~kept
        return float(total), open_


def _levels(tree: Tree, train: DataFrame, least: float, discount: float, depth: int, gain: float) -> None:
    """Add the levels of sequences and the states they make."""
    spark = train.sparkSession
    counts = [tree.counts[: tree.frequent].astype(float)]   # of sequences, by level
    for k in range(depth):
        shared = share(spark, tree)

        def run(batches):
            model, held, rows = shared(), [], 0
            total: list[np.ndarray] = []

            def merged():
                codes, at = np.unique(np.concatenate([c for c, _ in total]), return_inverse=True)
                return codes, np.bincount(at, np.concatenate([n for _, n in total]), len(codes))

            for batch in batches:
                for at in range(0, batch.num_rows, 1_000):
                    for t in batch.slice(at, 1_000).column("text").to_pylist():
                        c = model.next_codes(model.ids(t)[0])
                        held.append(c)
                        rows += len(c)
                        if rows > 2_000_000:
                            total.append(_counted(held))
                            held, rows = [], 0
                            if sum(len(c) for c, _ in total) > 6_000_000:
                                total[:] = [merged()]
            if held:
                total.append(_counted(held))
            if total:
                codes, n = merged()
                for at in range(0, len(codes), 500_000):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(codes[at : at + 500_000]), pa.array(n[at : at + 500_000].astype(np.int64))],
                        names=["code", "n"])

        found = train.select("text").mapInArrow(run, "code long, n long").groupBy("code").agg(
            F.sum("n").alias("n")
        ).filter(F.col("n") >= least).toArrow()  # at most 1 / LEAST rows
        order = np.argsort(code := found.column("code").to_numpy())
        code, n = code[order], found.column("n").to_numpy()[order].astype(float)
        context, word = code // tree.frequent, code % tree.frequent
        times = counts[k]
        p = np.maximum(n - discount, 0) / times[context]
        # the suffix state's probability of each kept follower
        q = 10 ** tree.root[word]
        for j in range(k):
            suffix = _suffix(tree, context, k, j)
            seq = _places(tree.codes[j], np.where(suffix >= 0, suffix * tree.frequent + word, -1))
            rest = np.where(suffix >= 0, tree.rest[j][suffix], np.nan)
            state = ~np.isnan(rest)
            q = np.where(state, np.where(seq >= 0, 10 ** tree.logp[j][seq], 10 ** np.nan_to_num(rest) * q), q)
        size = len(times)
        left_p = np.maximum(1 - np.bincount(context, p, size), 1e-12)
        left_q = np.maximum(1 - np.bincount(context, q, size), 1e-12)
        kept = np.bincount(context, minlength=size)
        gained = times * (np.bincount(context, p * np.log(np.maximum(p, 1e-300) / q), size) + left_p * np.log(left_p / left_q))
        states = (kept > 0) & (gained >= gain * kept)
        tree.codes.append(code)
        tree.logp.append(np.where(states[context], np.log10(np.maximum(p, 1e-300)), 0.0))
        tree.rest.append(np.where(states, np.log10(left_p / left_q), np.nan))
        counts.append(n)


def _suffix(tree: Tree, context: np.ndarray, k: int, j: int) -> np.ndarray:
    """Places (level j) of the last j + 1 words of contexts of level k."""
    words = []
    for level in range(k, 0, -1):
        code = tree.codes[level - 1][context]
        words.append(code % tree.frequent)
        context = code // tree.frequent
    words.append(context)
    words = words[: j + 1][::-1]
    place = words[0]
    for level in range(j):
        place = _places(tree.codes[level], np.where(place >= 0, place * tree.frequent + words[level + 1], -1))
    return place


def _counted(held: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    codes, n = np.unique(np.concatenate(held), return_counts=True)
    return codes, n.astype(float)


def score(docs: DataFrame, train: DataFrame, common: int = COMMON, least: float = LEAST,
          depth: int = DEPTH, gain: float = GAIN) -> DataFrame:
    """Per row of ``docs``: doc_id, n_tokens, n_known, train_tokens,
    base_score, score under the model learnt from ``train``."""
    spark = docs.sparkSession
    words = stage(count_words(train), "lm-words")
    n, v, n1, n2 = words.agg(
        F.coalesce(F.sum("c"), F.lit(0)), F.count("*"),
        F.count(F.when(F.col("c") == 1, 1)), F.count(F.when(F.col("c") == 2, 1)),
    ).first()
    discount = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
    unseen = float(np.log10(discount * v / n)) if n else 0.0
    norm = float(n + v + 1)
    bar = max(2.0, least * n)
    # every word that can be part of a sequence: at most 1 / least
    frequent = words.filter(F.col("c") >= bar).count()
    top = words.orderBy(F.col("c").desc(), "word").limit(max(common, frequent)).toArrow()
    counts = top.column("c").to_numpy()
    tree = Tree(top.column("word").to_pylist(), counts, frequent, np.log10((counts - discount) / max(n, 1)))
    if tree.frequent:
        _levels(tree, train, bar, discount, depth, gain)
    shared = share(spark, tree)

    def run(batches):
        tree = shared()
        base = np.log10((tree.counts + 1) / norm)
        uid = TaskContext.get().partitionId() << 36
        kinds = {"uid": pa.int64(), "word": pa.binary(), "n": pa.int64(), "base": pa.float64(),
                 "score": pa.float64(), "known": pa.int64(), "tokens": pa.int64()}
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                out = {c: [] for c in kinds}
                row = []
                for i, t in enumerate(part.column("text").to_pylist()):
                    ids, text = tree.ids(t)
                    here = ids >= 0
                    total, open_ = tree.score(ids)
                    total += tree.root[ids[open_ & here]].sum()
                    rare = Counter(text[j] for j in np.flatnonzero(~here))
                    m = len(rare)
                    row += [i] + [None] * m
                    out["uid"] += [uid + i] * (m + 1)
                    # the document's own row, under a key that is no word
                    out["word"] += [END + (uid + i).to_bytes(8, "big"), *rare]
                    out["n"] += [0, *rare.values()]
                    out["base"] += [float(base[ids[here]].sum())] + [0.0] * m
                    out["score"] += [float(total)] + [0.0] * m
                    out["known"] += [int(here.sum())] + [0] * m
                    out["tokens"] += [len(ids)] + [0] * m
                uid += part.num_rows
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(row, pa.int64()))]
                    + [pa.array(x, kinds[c]) for c, x in out.items()], names=["doc_id", *out])

    given = docs.select("doc_id", "text")
    schema = given.select("doc_id").schema
    for name, kind in (("uid", "long"), ("word", "binary"), ("n", "long"), ("base", "double"),
                       ("score", "double"), ("known", "long"), ("tokens", "long")):
        schema = schema.add(name, kind)
    # the counts of words that are not broadcast
    others = words.filter(F.col("c") <= int(counts.min(initial=2**62))).withColumnRenamed("c", "_c")
    parts = given.mapInArrow(run, schema).join(others, "word", "left")
    c, mine = F.coalesce("_c", F.lit(0)).cast("double"), F.col("n").cast("double")
    root = F.when(c > 0, F.log10((c - discount) / max(n, 1))).otherwise(F.lit(unseen))
    real = F.col("n") > 0
    return parts.groupBy("uid").agg(
        F.max("doc_id").alias("doc_id"),
        F.sum("tokens").alias("n_tokens"),
        F.sum(F.col("known") + F.when(real & (c > 0), F.col("n")).otherwise(0)).alias("n_known"),
        F.sum(F.col("base") + F.when(real, mine * F.log10((c + 1) / norm)).otherwise(0.0)).alias("base_score"),
        F.sum(F.col("score") + F.when(real, mine * root).otherwise(0.0)).alias("score"),
    ).select("doc_id", "n_tokens", "n_known", F.lit(int(n)).cast("long").alias("train_tokens"),
             "base_score", "score")


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held = crc_mod("doc_id", 7) == HELD
    return score(docs, docs.filter(~held)).select(
        "doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )
