"""N-gram Jaccard join through a token-group matrix.

Documents with equal shingle sets are one class. Similar classes are
partitioned into groups; the matrix holds each group's union of tokens. A class
looks for links in other groups only: a group can hold a partner only when it
shares a token of the class's prefix and when the overlap of the class with the
group's whole union reaches the least overlap any partner must have. Only such
groups are opened and their members compared. Links inside a group are known,
so all documents fall into their components without listing a group's pairs.

Prefix: two sets with 100 * |A n B| >= p * |A u B| share one of the first
n - ceil(p * n / 100) + 1 tokens of each in any common order. The order here
puts tokens that recur in many documents last (most frequent at the very end)
and the others in hash order; it decides speed alone, never the result. Frequent
tokens are counted where documents are read; tokens that prove frequent among
the prefixes join the list and prefixes are cut again, until none is left.

Groups come from the prefixes too: for each shared token the class with the
fewest tokens of its own is a leader, and one more; classes are compared with the leaders they share
enough tokens with, and verified links make up the groups. Groups are dealt by
size of set in parts of about ``GROUP`` classes, which keeps unions and bounds
tight and parts bounded.

How many tokens two prefixes share bounds the overlap of the sets as well; pairs
below it are dropped before any text is read.

Near copies of one text share its frequent tokens. Where two prefixes meet in a
listed token, both hold all their tokens that are not listed, so those met by no
other class bound the overlap before any text is read.

Moves: prefix rows (about n * (1 - p)) twice, classes' keys, and the texts of
classes that have candidates. Frequent keys never meet in a join: they are last
in every order, and joins on a hot leader can be split by Spark. Everything is
staged in the shared folder between steps.

Tokens are 64-bit hashes of shingles, classes 64-bit hashes of their sets. A
class's text is fetched by id and hash of the text, as rows may share an id.
Defined cases: null texts and texts without words have 0 shingles, class and
component are their own id; texts shorter than a shingle are one shingle;
repeated ids are scored row by row, a null id never is a component's name
unless all are null.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import WordHash, apart, shingles, stage, table, words_of
from tessera.llm.graph import components

SIZE, PERCENT = 4, 85
COMMON = 200_000    # tokens on the list of frequent ones at most
OFTEN = 16          # their least count
CROWD = 500         # a prefix token of so many classes joins the list
GROUP = 32
HELD = 3_000_000     # tokens that a task counts at a time
CACHE = 150_000      # hashed words that a task remembers
BROADCAST = 1_000_000  # ids that are broadcast at most


def _least(n: int, percent: int) -> int:
    """Least overlap of a set of n with any partner."""
    return -(-n * percent // 100)


def _class(s: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(s.tobytes()) >> 1


def _survey(docs: DataFrame, size: int) -> DataFrame:
    """Rows (doc_id, cls, n, key) of documents, and (token, n) of tokens that
    occur in more than one document of what a task holds at a time; key is a
    hash of the text."""
    given = docs.select("doc_id", "text", F.xxhash64("text").alias("key"))
    none = F.lit(None)
    schema = given.select(F.coalesce("doc_id", none).alias("doc_id"),
                          *[none.cast("long").alias(c) for c in ("cls", "n", "token", "key")]).schema
    ids = pa.int64()

    def run(batches):
        words, held, rows = WordHash(CACHE), [], 0

        def tokens(kind):
            t, n = np.unique(np.concatenate(held), return_counts=True)
            t, n = t[n > 1].view(np.int64), n[n > 1]
            empty = pa.nulls(len(t))
            return pa.RecordBatch.from_arrays(
                [empty.cast(kind), empty.cast(ids), pa.array(n, ids), pa.array(t, ids), empty.cast(ids)],
                names=["doc_id", "cls", "n", "token", "key"])

        kind = None
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                kind = part.column("doc_id").type
                sets = [shingles(words.of(words_of(t)), size) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([_class(s) if len(s) else None for s in sets], ids),
                     pa.array([len(s) for s in sets], ids), pa.nulls(len(sets)).cast(ids), part.column("key")],
                    names=["doc_id", "cls", "n", "token", "key"])
                held += sets
                rows += sum(map(len, sets))
                if rows > HELD:
                    yield tokens(kind)
                    held, rows = [], 0
        if rows:
            yield tokens(kind)

    return given.mapInArrow(run, schema)


def _prefix(s: np.ndarray, percent: int, common: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, int]:
    """First tokens of a set in the common order; how many are not listed."""
    need = len(s) - _least(len(s), percent) + 1
    look = min(len(s), 2 * need + 16)
    while True:
        head = s[:look]
        if not len(common):
            return head[:need], need
        at = np.minimum(np.searchsorted(common, head), len(common) - 1)
        hot = common[at] == head
        cold = head[~hot]
        if len(cold) >= need:
            return cold[:need], need
        if look == len(s):
            late = head[hot][np.argsort(rank[at[hot]], kind="stable")]
            return np.concatenate([cold, late])[:need], len(cold)
        look = len(s)


def _prefixes(docs: DataFrame, size: int, percent: int, common: list[tuple[int, int]]) -> DataFrame:
    """(token, cls, meta) of every document's prefix; meta holds the set's size,
    the prefix's tokens that are not listed and whether this one is."""
    ordered = sorted(common, key=lambda c: (c[1], c[0]))  # from rare to frequent
    tokens = np.array([t for t, _ in ordered], np.int64).view(np.uint64)
    by_token = np.argsort(tokens)
    # at most COMMON tokens and those that the prefixes added
    sent = docs.sparkSession.sparkContext.broadcast((tokens[by_token], by_token))

    def run(batches):
        words, (known, rank) = WordHash(CACHE), sent.value
        for batch in batches:
            for at in range(0, batch.num_rows, 1_000):
                sets = [shingles(words.of(words_of(t)), size)
                        for t in batch.slice(at, 1_000).column("text").to_pylist()]
                sets = [s for s in sets if len(s)]
                if not sets:
                    continue
                heads, cold = zip(*(_prefix(s, percent, known, rank) for s in sets))
                times = [len(h) for h in heads]
                meta = np.repeat([len(s) << 32 | c << 1 for s, c in zip(sets, cold)], times)
                place = np.concatenate([np.arange(t) for t in times])
                meta |= place >= np.repeat(cold, times)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(heads).view(np.int64)),
                     pa.array(np.repeat([_class(s) for s in sets], times)),
                     pa.array(meta)],
                    names=["token", "cls", "meta"])

    return docs.select("text").mapInArrow(run, "token long, cls long, meta long")


def _texts(docs: DataFrame, classes: DataFrame, wanted: DataFrame) -> DataFrame:
    """(cls, text) of the wanted classes, from their first documents."""
    first = stage(classes.join(wanted, "cls").select(F.col("class_id").alias("_id"), F.col("key").alias("_key"), "cls"),
                  "jaccard-wanted")
    size = first.count()
    if size <= BROADCAST:
        first = F.broadcast(first)
    held = docs.select("doc_id", "text").join(
        first, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_key")))
    held = stage(held.select("cls", "text"), "jaccard-texts")
    # rows that repeat id and text
    return held if held.count() <= size else stage(
        held.groupBy("cls").agg(F.first("text").alias("text")), "jaccard-texts")


class _Sets:
    """Shingles of texts, the last ones kept."""

    def __init__(self, size: int):
        self.size, self.words, self.kept = size, WordHash(CACHE), {}

    def of(self, cls: int, text: str) -> np.ndarray | None:
        if cls not in self.kept:
            s = shingles(self.words.of(words_of(text)), self.size)
            if not len(s) or _class(s) != cls:
                return None   # another text; the right one may follow
            if len(self.kept) >= 64:
                self.kept.clear()
            self.kept[cls] = s
        return self.kept[cls]


def _overlap(a: np.ndarray, b: np.ndarray) -> int:
    if len(a) > len(b):
        a, b = b, a
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    return int((b[at] == a).sum())


def _linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    same = _overlap(a, b)
    return 100 * same >= percent * (len(a) + len(b) - same)


def _verify(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The linked ones of class pairs (a, b)."""
    joined = pairs.join(texts.toDF("a", "a_text"), "a").join(texts.toDF("b", "b_text"), "b")

    def run(batches):
        left, right = _Sets(size), _Sets(size)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                a, b = part.column("a").to_pylist(), part.column("b").to_pylist()
                ok = []
                for x, y, s, t in zip(a, b, part.column("a_text").to_pylist(), part.column("b_text").to_pylist()):
                    s, t = left.of(x, s), right.of(y, t)
                    ok.append(s is not None and t is not None and _linked(s, t, percent))
                yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b")], names=["a", "b"]).filter(pa.array(ok))

    return joined.select("a", "b", "a_text", "b_text").mapInArrow(run, "a long, b long").distinct()


def _open(found: DataFrame, groups: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Links (a, b) of classes ``a`` with members of groups ``g``, for the
    found (a, g) whose bound qualifies. ``groups``: (g, members' cls)."""
    members = groups.join(texts, "cls").groupBy("g").agg(F.collect_list(F.struct("cls", "text")).alias("members"))
    joined = found.join(texts.toDF("a", "text"), "a").join(members, "g").select("a", "text", "g", "members")

    def run(batches):
        sets, group, held, union = _Sets(size), None, [], None
        for batch in batches:
            for at in range(0, batch.num_rows, 50):
                part = batch.slice(at, 50)
                out_a, out_b = [], []
                for a, text, g, rows in zip(*(part.column(c).to_pylist() for c in ("a", "text", "g", "members"))):
                    if g != group:
                        own = _Sets(size)
                        held = [(r["cls"], own.of(r["cls"], r["text"])) for r in rows]
                        held = [(c, s) for c, s in held if s is not None]
                        union = np.unique(np.concatenate([s for _, s in held])) if held else None
                        group = g
                    q = sets.of(a, text)
                    if q is None or union is None or _overlap(q, union) < _least(len(q), percent):
                        continue
                    for c, s in held:
                        if _linked(q, s, percent):
                            out_a.append(a)
                            out_b.append(c)
                yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], names=["a", "b"])

    return joined.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, class_id of every row of ``docs``."""
    return _joined(docs, size, percent).select("doc_id", "n_shingles", "component_id", "class_id")


def _joined(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """What ``near_duplicates`` gives, and per row the hash of its text and the
    label of its component, null for rows without words."""
    survey = stage(_survey(docs, size), "jaccard-survey")
    rows = survey.filter("token IS NULL").select("doc_id", "cls", "n", "key")
    classes = stage(
        rows.filter("cls IS NOT NULL").groupBy("cls").agg(
            F.min("doc_id").alias("class_id"), F.max("n").alias("n"),
            F.coalesce(F.min_by("key", "doc_id"), F.min("key")).alias("key")),
        "jaccard-classes",
    )
    counted = survey.filter("token IS NOT NULL").groupBy("token").agg(F.sum("n").alias("n")).filter(
        F.col("n") >= OFTEN)
    common = [tuple(r) for r in counted.orderBy(F.col("n").desc(), "token").limit(COMMON).collect()]

    # prefixes, cut again while crowded tokens are found that are not listed
    for _ in range(4):
        prefix = stage(_prefixes(docs, size, percent, common), "jaccard-prefix")
        # a token of one class only links nothing
        tokens = stage(
            prefix.groupBy("token").agg(F.min("cls").alias("low"), F.max("cls").alias("high"))
            .filter("low <> high"), "jaccard-tokens",
        )
        shared = stage(
            prefix.join(tokens, "token").select(
                "token", "cls", F.shiftright("meta", 32).alias("n"),
                F.shiftright("meta", 1).bitwiseAND(F.lit(2**31 - 1)).alias("cold"),
                (F.col("meta").bitwiseAND(F.lit(1)) == 1).alias("hot"), "low",
            ).distinct(), "jaccard-shared",
        )
        listed = {t for t, _ in common}
        crowd = shared.groupBy("token").agg(F.count("*").alias("df")).filter(F.col("df") > CROWD)
        crowd = crowd.orderBy(F.col("df").desc(), "token").limit(COMMON).collect()
        crowd = [(r["token"], r["df"]) for r in crowd if r["token"] not in listed]
        if not crowd:
            break
        common += crowd
    # a class whose prefix reaches listed tokens has all its other tokens in
    # it: ``most`` is the most that such classes can share with this one
    own = stage(
        shared.groupBy("cls", "n", "cold").agg(F.count(F.when(~F.col("hot"), 1)).alias("_met")).select(
            "cls", "n", (F.col("n") - F.col("cold") + F.col("_met")).alias("most")), "jaccard-own",
    )

    def reach(n, most, n2, most2):
        both = F.least(most, most2)
        return both * 100 >= (n + F.greatest(n2, both) - both) * percent

    # A token of the prefix that ends first is in the other set only if it is in
    # its prefix. So two sets share at most the tokens beyond that prefix and
    # the common ones of both prefixes.
    def enough(common_, n, n2_low, n2_high):
        beyond = F.greatest(F.ceil(n * percent / 100), F.ceil(n2_high * percent / 100)) - 1
        return (common_ + beyond) * (100 + percent) >= (n + n2_low) * percent

    # groups: classes next to a leader they share enough of their prefix with;
    # a token is led by the class with the fewest tokens of its own, and by any
    lead = shared.select("token", "cls", "low").join(own, "cls").groupBy("token", "low").agg(
        F.min(F.struct(F.col("n") - F.col("most"), "cls")).getField("cls").alias("_lead"))
    led = shared.select("token", "cls").join(lead, "token").select(
        "cls", F.explode(F.array_distinct(F.array("_lead", "low"))).alias("b")).filter("cls <> b")
    # a class counts the tokens a leader leads it in, not all they share
    led = led.groupBy("cls", "b").agg(F.count("*").alias("c")).join(own, "cls")
    other = own.toDF("b", "_n", "_most")
    size_a, size_b = F.col("n"), F.col("_n")
    led = stage(
        led.join(other, "b").filter(
            reach(size_a, F.col("most"), size_b, F.col("_most")) & enough(2 * F.col("c"), size_a, size_b, size_b))
        .select(F.least("cls", "b").alias("a"), F.greatest("cls", "b").alias("b")).distinct(), "jaccard-led",
    )
    ends = led.select(F.explode(F.array("a", "b")).alias("cls")).distinct()
    links = stage(_verify(led, _texts(docs, classes, ends), size, percent), "jaccard-links")
    inside = components(links).withColumnsRenamed({"v": "cls", "label": "_label"})

    # the matrix: which groups hold a prefix token, and their range of sizes
    inside = inside.join(own.select("cls", F.col("n").alias("_n")), "cls")
    big = inside.groupBy("_label", "_n").agg(F.count("*").alias("_size"))
    dealt = inside.join(big, ["_label", "_n"]).join(
        inside.groupBy("_label").agg(F.count("*").alias("_all")), "_label"
    ).select("cls", "_label", "_all", F.pmod(
        F.xxhash64("cls"), F.ceil(F.col("_size") / GROUP).cast("long")).alias("_part"))
    placed = stage(
        shared.select("token", "cls", "hot").join(own, "cls").join(dealt, "cls", "left").select(
            "token", "cls", "hot", "n", "most",
            F.struct(F.coalesce("_all", F.lit(1)), F.coalesce("_label", "cls")).alias("comp"),
            F.xxhash64(F.coalesce("_label", "cls"), "n", F.coalesce("_part", F.lit(-1).cast("long"))).alias("g"),
        ), "jaccard-placed",
    )
    matrix = placed.groupBy("token", "g", "comp").agg(
        F.min("n").alias("lo"), F.max("n").alias("hi"), F.max("most").alias("g_most"))
    asked = placed.select("token", F.col("cls").alias("a"), "hot", F.col("n").alias("_n"), "most",
                          F.col("comp").alias("_comp"))
    # each pair of components is looked at from the one with fewer classes
    found = stage(
        asked.join(matrix, "token").filter(
            (F.col("_comp") < F.col("comp")) & (F.col("_n") * 100 >= F.col("lo") * percent)
            & (F.col("_n") * percent <= F.col("hi") * 100)
            & (~F.col("hot") | reach(F.col("_n"), F.col("most"), F.col("lo"), F.col("g_most")))
        ).groupBy("a", "g", "_n").agg(
            F.count("*").alias("c"), F.min("lo").alias("lo"), F.max("hi").alias("hi")
        ).filter(enough(F.col("c"), F.col("_n"), F.col("lo"), F.col("hi"))).select("a", "g"), "jaccard-found",
    )
    members = placed.select("g", "cls").distinct().join(found.select("g").distinct(), "g", "left_semi")
    members = stage(members, "jaccard-members")
    ends = found.select(F.col("a").alias("cls")).union(members.select("cls")).distinct()
    more = _open(found, members, _texts(docs, classes, ends), size, percent)
    every = stage(components(links.union(more)), "jaccard-components")

    names = classes.join(every.withColumnsRenamed({"v": "cls"}), "cls", "left").withColumn(
        "label", F.coalesce("label", "cls"))
    least = names.groupBy("label").agg(F.min("class_id").alias("component_id"))
    named = names.join(least, "label").select(F.col("cls").alias("_cls"), "label", "class_id", "component_id")
    return rows.join(named, F.col("cls") == F.col("_cls"), "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce("class_id", "doc_id").alias("class_id"), "key", "label",
    )


def _sent(df: DataFrame, label: str) -> tuple[DataFrame, int]:
    df = stage(df, label)
    n = df.count()
    return (F.broadcast(df) if n <= BROADCAST else df), n


def one_of_each(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One row of ``docs`` for each component, with its smallest id; where rows
    share that id, with the smallest hash of text, then of row. Rows without
    words all stay."""
    found = stage(_joined(docs, size, percent).filter("label IS NOT NULL"), "jaccard-stage")
    first = F.col("doc_id").eqNullSafe(F.col("component_id"))
    # components with several rows of that id
    several, _ = _sent(found.filter(first).groupBy("label").agg(
        F.min("key").alias("_least"), F.count("*").alias("_rows")).filter("_rows > 1"), "jaccard-several")
    found = found.select("doc_id", "key", "label", first.alias("_first")).join(several, "label", "left")
    ids = [F.col("doc_id").alias("_id"), F.col("key").alias("_k")]
    other = ~F.col("_first") | (F.col("key") != F.col("_least"))
    gone, _ = _sent(found.filter(other).select(*ids).distinct(), "jaccard-gone")
    once, repeats = _sent(found.filter(F.col("_first") & (F.col("key") == F.col("_least"))).select(*ids).distinct(),
                          "jaccard-once")
    inner, back = apart(docs, "doc_id", "text")
    own = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_k"))
    kept = inner.join(gone, own, "left_anti")
    if repeats:
        order = F.xxhash64(*[c for c, kind in inner.dtypes if "map<" not in kind and "variant" not in kind])
        some = kept.join(once, own).groupBy("_id", "_k").agg(F.min_by(F.struct(*inner.columns), order).alias("_row"))
        kept = kept.join(once, own, "left_anti").union(some.select("_row.*"))
    return back(kept)


def query(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
