"""Token counts by dynamic programming shared over a trie of pre-tokens.

A text's pre-tokens are its white-space-free runs, each led by the word mark.
The distinct pre-tokens of a batch form a trie; a node's forward score is the
best total log-probability of a segmentation of its prefix into vocabulary
pieces, computed once for all words under it, level by level over all nodes of
a depth at once. A terminal node stores the number of pieces on its best path,
and a document's count is the sum over its pre-tokens.

The vocabulary file is a parameter; pieces get log-probabilities by rank
(Zipf-Mandelbrot), as the file lists them from common to rare. A character that
no piece covers costs ``UNKNOWN`` below the rarest piece and counts as its
UTF-8 bytes (byte fallback). Equal scores: the fewer pieces win.

Documents are counted where they are read: no shuffle, memory bounded by one
slice of documents and a limited cache. The vocabulary is broadcast (its size is
the file's). Defined cases: null or empty text counts 0; a pre-token of any
length is counted whole; rows are independent, so ids may repeat or be null.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import mix, table

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
UNKNOWN = 10.0
_LEVELS = 48     # deeper words go one by one
_CHUNK = 40_000  # words of one trie
_BASE = np.uint64(0x100000001B3)


def pieces(path: str = VOCABULARY) -> dict[str, float]:
    """Piece -> log-probability, from a sentencepiece file."""
    import sentencepiece as sp

    model = sp.SentencePieceProcessor(model_file=path)
    normal = [
        model.id_to_piece(i) for i in range(model.get_piece_size())
        if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
    ]
    weight = 1.0 / (np.arange(len(normal)) + 2.7)
    return dict(zip(normal, np.log(weight / weight.sum()).tolist()))


def _codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points (mixed to 64 bits) as a matrix, and lengths."""
    size = np.array([len(w) for w in words], np.int64)
    raw = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    m = np.zeros((len(words), int(size.max(initial=0))), np.uint32)
    m[np.arange(m.shape[1]) < size[:, None]] = raw
    return m, size


class Counter:
    """Piece counts of words under a vocabulary."""

    def __init__(self, logp: dict[str, float], limit: int = 300_000):
        self.logp, self.limit, self.cache = logp, limit, {}
        self.longest = max(map(len, logp), default=1)
        self.unknown = min(logp.values(), default=0.0) - UNKNOWN
        self.tables = {}
        by_size: dict[int, list[str]] = {}
        for p in logp:
            by_size.setdefault(len(p), []).append(p)
        for n, group in sorted(by_size.items()):
            h = self._prefix(_codes(group)[0])[:, n]
            order = np.argsort(h)
            self.tables[n] = h[order], np.array([logp[p] for p in group])[order]

    @staticmethod
    def _prefix(m: np.ndarray) -> np.ndarray:
        """Hash of every prefix of every row."""
        out = np.zeros((m.shape[0], m.shape[1] + 1), np.uint64)
        codes = mix(m.astype(np.uint64) + np.uint64(1))
        for d in range(m.shape[1]):
            out[:, d + 1] = out[:, d] * _BASE + codes[:, d]
        return out

    def _trie(self, words: list[str]) -> list[int]:
        """Counts of sorted distinct words, through their trie."""
        m, size = _codes(words)
        n, depth = m.shape
        # a row's node at a depth is new where its common prefix with the row before is shorter
        same = np.ones((n, depth), bool)
        same[0] = False
        same[1:] = m[1:] == m[:-1]
        shared = np.where(same.all(axis=1), depth, (~same).argmax(axis=1))
        hashes = self._prefix(m)
        score = np.full((depth + 1, n), -np.inf)
        count = np.zeros((depth + 1, n), np.int64)
        score[0] = 0.0
        power = [np.uint64(pow(int(_BASE), d, 1 << 64)) for d in range(depth + 1)]
        points = m.astype(np.int64)
        width = 1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000)
        for d in range(1, depth + 1):
            alive = size >= d
            fresh = alive & (shared < d)
            node = np.flatnonzero(fresh)  # one row for each trie node of this depth
            if not len(node):
                break
            best = score[d - 1, node] + self.unknown
            held = count[d - 1, node] + width[node, d - 1]
            for n_last, (keys, values) in self.tables.items():
                if n_last > d:
                    continue
                h = hashes[node, d] - hashes[node, d - n_last] * power[n_last]
                at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
                hit = keys[at] == h
                s = np.where(hit, score[d - n_last, node] + values[at], -np.inf)
                c = count[d - n_last, node] + 1
                if n_last == 1:  # a known character is no unknown one
                    best = np.where(hit, -np.inf, best)
                better = (s > best) | ((s == best) & hit & (c < held))
                best, held = np.where(better, s, best), np.where(better, c, held)
            # every row of a node reads its score
            of = np.cumsum(fresh)[alive] - 1
            score[d, alive], count[d, alive] = best[of], held[of]
        return count[size, np.arange(n)].tolist()

    def _alone(self, word: str) -> int:
        """The same recurrence for one long word."""
        score, count = [0.0], [0]
        for d in range(1, len(word) + 1):
            c = word[d - 1]
            if c in self.logp:
                best = (-float("inf"), 0)
            else:
                bytes_ = len(c.encode("utf-8", "surrogatepass"))
                best = (score[d - 1] + self.unknown, -(count[d - 1] + bytes_))
            for k in range(1, min(self.longest, d) + 1):
                p = self.logp.get(word[d - k : d])
                if p is not None:
                    best = max(best, (score[d - k] + p, -(count[d - k] + 1)))
            score.append(best[0])
            count.append(-best[1])
        return count[-1]

    def count(self, texts: list[str | None]) -> list[tuple[int, int]]:
        """(pre-tokens, pieces) of each text."""
        split = [
            [MARK + w.decode("utf-8", "surrogatepass") for w in t.encode("utf-8", "surrogatepass").split()]
            if t else [] for t in texts
        ]
        new = sorted({w for ws in split for w in ws} - self.cache.keys())
        if len(self.cache) + len(new) > self.limit:
            self.cache = {}
            new = sorted({w for ws in split for w in ws})
        short = [w for w in new if len(w) <= _LEVELS]
        for at in range(0, len(short), _CHUNK):
            part = short[at : at + _CHUNK]
            self.cache.update(zip(part, self._trie(part)))
        self.cache.update((w, self._alone(w)) for w in new if len(w) > _LEVELS)
        return [(len(ws), sum(map(self.cache.__getitem__, ws))) for ws in split]


def token_counts(docs: DataFrame, vocabulary: str = VOCABULARY, text: str = "text") -> DataFrame:
    """``docs`` without its text, with n_words, n_chars and n_tokens (long)."""
    logp = docs.sparkSession.sparkContext.broadcast(pieces(vocabulary))
    rest = [c for c in docs.columns if c not in (text, "n_words", "n_chars", "n_tokens")]
    given = docs.select(*rest, F.col(text).alias("_text"))
    schema = docs.select(*rest).schema.add("n_words", "long").add("n_chars", "long").add("n_tokens", "long")

    def run(batches):
        counter = Counter(logp.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 2_000):
                part = batch.slice(at, 2_000)
                texts = part.column("_text").to_pylist()
                got = counter.count(texts)
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in rest]
                    + [pa.array([g[0] for g in got], pa.int64()),
                       pa.array([len(t or "") for t in texts], pa.int64()),
                       pa.array([g[1] for g in got], pa.int64())],
                    names=[f.name for f in schema],
                )

    return given.mapInArrow(run, schema)


def query(spark, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents").select("doc_id", "text"))
