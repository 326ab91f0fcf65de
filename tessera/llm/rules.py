"""Quality classifier: a sparse rule ensemble over text statistics.

Statistics of every whole text are computed where it is read. On a bounded
sample of labelled rows, boosted shallow trees are grown; every path from a
root is a conjunctive rule. A lasso logistic fit keeps few rules with weights,
and these are compiled into one Spark column expression, so scoring all
documents is a projection without shuffle.

The sample is the ``max_rows`` labelled rows with the smallest md5 of their id
(held-out rows excluded). An id that repeats gives one row, chosen by a hash of
its label and statistics, so neither label is preferred; only the statistics of
at most ``max_rows`` rows reach the driver.

Defined cases: null or empty text has statistics 0 and is scored like any
other; rows without label or without text row are not learnt from; without any
label, or with one class only, every score is the share of label 1 (0.5 when
there is none). Repeated ids are scored row by row.
"""

from __future__ import annotations

import string
from collections import Counter
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import apart, crc_mod, stage, table

MAX_ROWS = 20_000
TREES = 24
DEPTH = 3
THRESHOLD = 0.3
STATISTICS = (
    "log_words", "word_length", "long_words", "short_words", "upper", "digits", "symbols",
    "bars", "bangs", "stops", "distinct", "echoes", "lines", "line_copies", "top_word", "other_bytes",
)
_UPPER = string.ascii_uppercase.encode()
_DIGITS = string.digits.encode()
_SYMBOLS = b"#$%&*@^~<>=+_\\/{}[]"


def statistics(text: str | None) -> list[float]:
    """The statistics of one text, in the order of ``STATISTICS``."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    n, size = len(words), len(raw)
    if not n:
        return [0.0] * len(STATISTICS)
    share = lambda chars: (size - len(raw.translate(None, chars))) / size
    lengths = np.fromiter(map(len, words), np.int64, n)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    kinds = Counter(words)
    return [
        float(np.log1p(n)), float(lengths.mean()), float((lengths > 20).mean()),
        float((lengths <= 3).mean()), share(_UPPER), share(_DIGITS), share(_SYMBOLS),
        share(b"|"), share(b"!"), raw.count(b".") / n, len(kinds) / n,
        sum(map(eq, words, words[1:])) / n, float(np.log1p(len(lines))),
        1 - len(set(lines)) / len(lines), max(kinds.values()) / n,
        (size - len(text)) / size,
    ]


def with_statistics(docs: DataFrame, text: str = "text", keep: bool = False) -> DataFrame:
    """``docs`` with one double column per statistic; without its text unless
    ``keep``. A text is sent to Python once in either case."""
    rest = [c for c in docs.columns if (keep or c != text) and c not in STATISTICS]
    given = docs.select(*rest) if keep else docs.select(*rest, F.col(text).alias("_text"))
    texts = text if keep else "_text"
    schema = docs.select(*rest).schema
    for s in STATISTICS:
        schema = schema.add(s, "double")

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 4_000):
                part = batch.slice(at, 4_000)
                got = np.array([statistics(t) for t in part.column(texts).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in rest] + [pa.array(c) for c in got.T.copy()],
                    names=[f.name for f in schema],
                )

    return given.mapInArrow(run, schema)


# --- fitting on the driver, over the bounded sample -------------------------

Rule = tuple[tuple[int, bool, float], ...]  # (statistic, above?, cut) and ...


def _covers(rule: Rule, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for j, above, cut in rule:
        out &= (x[:, j] > cut) if above else (x[:, j] <= cut)
    return out


def _cuts(x: np.ndarray) -> list[np.ndarray]:
    return [np.unique(np.quantile(c, np.linspace(0, 1, 34)[1:-1], method="lower")) for c in x.T]


def _paths(x: np.ndarray, bins: np.ndarray, cuts: list[np.ndarray], grad: np.ndarray, hess: np.ndarray,
           rows: np.ndarray, path: Rule, depth: int, step: np.ndarray, out: list[Rule]) -> None:
    """Grow one tree on gradients; append the path of every node but the root
    and write the leaves' steps."""
    best = (1e-3, None)
    g, h = grad[rows].sum(), hess[rows].sum()
    if depth:
        for j, cut in enumerate(cuts):
            gs = np.bincount(bins[rows, j], grad[rows], len(cut) + 1).cumsum()[:-1]
            hs = np.bincount(bins[rows, j], hess[rows], len(cut) + 1).cumsum()[:-1]
            gain = gs**2 / (hs + 1) + (g - gs) ** 2 / (h - hs + 1) - g**2 / (h + 1)
            gain[(hs < 2) | (h - hs < 2)] = 0
            if len(gain) and gain.max() > best[0]:
                best = (gain.max(), (j, int(gain.argmax())))
    if best[1] is None:
        step[rows] = g / (h + 1)
        return
    j, at = best[1]
    for above in (False, True):
        side = rows[(bins[rows, j] > at) == above]
        rule = (*path, (j, above, float(cuts[j][at])))
        out.append(rule)
        _paths(x, bins, cuts, grad, hess, side, rule, depth - 1, step, out)


def grow(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> list[Rule]:
    """Rules of boosted trees, each condition set once."""
    cuts = _cuts(x)
    # bin b holds the values in (cut[b-1], cut[b]]
    bins = np.stack([np.searchsorted(c, col, side="left") for c, col in zip(cuts, x.T)], axis=1)
    f, found = np.full(len(y), np.log(y.mean() / (1 - y.mean()))), {}
    for _ in range(trees):
        p = 1 / (1 + np.exp(-f))
        step, out = np.zeros(len(y)), []
        _paths(x, bins, cuts, y - p, p * (1 - p), np.arange(len(y)), (), depth, step, out)
        f += 0.4 * step
        for rule in out:
            found.setdefault(_covers(rule, x).tobytes(), rule)
    return list(found.values())


def lasso(z: np.ndarray, y: np.ndarray, penalty: float = 2e-3, rounds: int = 400) -> tuple[float, np.ndarray]:
    """Intercept and weights of an L1-penalised logistic fit (FISTA)."""
    n = len(y)
    bias, w = float(np.log(y.mean() / (1 - y.mean()))), np.zeros(z.shape[1])
    at_b, at_w, t = bias, w, 1.0
    rate = 4.0 * n / (np.linalg.norm(np.c_[np.ones(n), z], 2) ** 2)
    for _ in range(rounds):
        r = 1 / (1 + np.exp(-(at_b + z @ at_w))) - y
        new_b = at_b - rate * r.mean()
        new_w = at_w - rate * (z.T @ r) / n
        new_w = np.sign(new_w) * np.maximum(np.abs(new_w) - rate * penalty, 0)
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        at_b, at_w = new_b + (t - 1) / t_new * (new_b - bias), new_w + (t - 1) / t_new * (new_w - w)
        bias, w, t = new_b, new_w, t_new
    return float(bias), w


class Ensemble:
    """Weighted rules; ``column`` is their Spark expression."""

    def __init__(self, bias: float, rules: list[tuple[float, Rule]]):
        self.bias, self.rules = bias, rules

    def column(self) -> Column:
        total = F.lit(self.bias)
        for weight, rule in self.rules:
            held = F.lit(True)
            for j, above, cut in rule:
                c = F.col(STATISTICS[j])
                held = held & ((c > cut) if above else (c <= cut))
            total = total + F.when(held, F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-total))


def fit(x: np.ndarray, y: np.ndarray) -> Ensemble:
    share = y.mean() if len(y) else 0.5
    if share in (0.0, 1.0) or not len(y):
        # one class only: its share, kept off 0 and 1 as the logit needs
        share = min(max(share, 1e-6), 1 - 1e-6)
        return Ensemble(float(np.log(share / (1 - share))), [])
    rules = grow(x, y)
    if not rules:
        return Ensemble(float(np.log(share / (1 - share))), [])
    z = np.stack([_covers(r, x) for r in rules], axis=1).astype(float)
    spread = np.maximum(z.std(axis=0), 1e-9)
    bias, w = lasso((z - z.mean(axis=0)) / spread, y)
    w = w / spread
    return Ensemble(bias - float(z.mean(axis=0) @ w), [(float(v), r) for v, r in zip(w, rules) if v])


def learn(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Ensemble:
    chosen = labels.filter(
        F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & (crc_mod("doc_id", 5) != 0)
    ).select("doc_id", "quality", F.md5(F.col("doc_id").cast("string").cast("binary")).alias("_k"))
    chosen = stage(chosen.orderBy("_k", "doc_id", "quality").limit(max_rows).drop("_k"), "quality-sample")
    rows = with_statistics(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"))
    # one row of each sampled id: at most max_rows small rows
    own = F.struct(F.xxhash64("doc_id", "quality", *STATISTICS), "quality", *STATISTICS)
    one = rows.groupBy("doc_id").agg(F.min(own).alias("_row")).select("_row.quality", *(f"_row.{c}" for c in STATISTICS))
    got = sorted(one.collect())
    a = np.array(got, float).reshape(-1, 1 + len(STATISTICS))
    return fit(a[:, 1:], a[:, 0])


def classify(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS,
             threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs``."""
    model = learn(docs, labels, max_rows)
    scored = with_statistics(docs.select("doc_id", "text")).withColumn("score", model.column())
    return scored.select(
        "doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS,
              threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject, unchanged."""
    model = learn(docs, labels, max_rows)
    inner, back = apart(docs)
    text = inner.columns[docs.columns.index("text")]
    scored = with_statistics(inner, text, keep=True)
    return back(scored.filter(model.column() >= threshold))


def query(spark, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
