"""Collocations, packing and the prefix trie against brute force."""

from __future__ import annotations

import collections
import functools
import hashlib
import itertools
import pathlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tessera.llm import collocations, common, packing, prefixtrie
from tessera.session import scratch_root

DOCS = "doc_id long, text string, lang string, id string, chunk string, rank string, length string, _id string"
CONVERSATIONS = "conv_id long, turn long, role string, text string, keys string, sizes string, at string, depth string"


def frame(spark, rows, schema):
    width = len(schema.split(","))
    return spark.createDataFrame([(*r, *["x"] * (width - len(r))) for r in rows], schema)


# --- collocations ---

def brute_collocations(rows, least, longest, top):
    grams, total = collections.defaultdict(collections.Counter), collections.Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        low = (text or "").translate({c: c + 32 for c in range(65, 91)})
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    grams[lang][tuple(words[i : i + k])] += 1
    out = []
    for lang, f in grams.items():
        cand = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in cand.items():
            if any(len(q) > len(p) and b >= a and any(q[i : i + len(p)] == p for i in range(len(q)))
                   for q, b in cand.items()):
                continue
            cuts = [(1000 * a * total[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            rows.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, p, l, r) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, total[lang], -score))
    return sorted(out)


@pytest.fixture(scope="module")
def prose():
    rnd = random.Random(11)
    words = ["the", "The", "a", "of", "sea", "Été", "été", "new", "york", "x\x00y", "\U0001f600"]
    rows = []
    for i in range(120):
        text = "".join(rnd.choice(words) + rnd.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\r\n", " "])
                       for _ in range(rnd.randint(0, 60)))
        rows.append((i, text + " in new york city. of the", rnd.choice(["en", "fr", None, "und"])))
    rows += [(200, None, "en"), (201, "", "en"), (202, " .,;\n", "de"), (None, "a b c d e f g", "en")]
    rows += [(300, "a a a a a a a a a a", "aa")] * 3 + [(301, "one two three four five six seven", "es")] * 9
    rows += [(302, "word " * 30_000, "en"), (303, "z" * 70_000 + " new york", "en")]
    return rows


@pytest.mark.parametrize("least,top,chunk", [(8, 1000, 200_000), (8, 3, 2000), (10**9, 5, 5000)])
def test_collocations(spark, prose, monkeypatch, least, top, chunk):
    monkeypatch.setattr(collocations, "CHUNK", chunk)
    monkeypatch.setattr(collocations, "BUCKET", chunk)  # many buckets with small chunks
    monkeypatch.setattr(collocations, "WINDOW", chunk)
    got = collocations.collocations(frame(spark, prose, DOCS).repartition(3), least, 5, top)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == brute_collocations(prose, least, 5, top)


def test_scores_beyond_64_bits(spark):
    levels = spark.createDataFrame([(1, "en", "a b", [6 * 10**9, 3 * 10**9], [5 * 10**9, 3 * 10**9])],
                                   "id long, lang string, phrase string, heads array<long>, tails array<long>")
    n = 9 * 10**12
    got = collocations._scored(levels, 2, spark.createDataFrame([("en", n)], "lang string, n long")).first()
    assert got.score == 1000 * 3 * 10**9 * n // (6 * 10**9 * 5 * 10**9)


def test_no_documents_have_no_collocations(spark):
    assert collocations.collocations(frame(spark, [], DOCS)).collect() == []


def test_relations_go_once_the_next_is_written(spark, prose):
    made = lambda: {p.name for p in pathlib.Path(scratch_root(spark).removeprefix("file:")).glob("llm-*")}
    before = made()
    result = collocations.collocations(frame(spark, prose, DOCS), 8, 5, 3)
    left = {x.removeprefix("llm-").rpartition("-")[0] for x in made() - before}
    assert left == {"lang-words", *(f"level-{k}" for k in range(1, 6))}
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("tessera_llm_")]
    assert result.count()


def test_a_relation_stays_where_it_lies(spark, monkeypatch):
    seen = []

    def passing(df, label, by=None):
        if label.startswith("phrases-"):
            seen.append(df._jdf.queryExecution().executedPlan().toString())
        return common.passing(df, label, by)

    monkeypatch.setattr(collocations, "passing", passing)
    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        collocations.collocations(frame(spark, [(i, "new york city of the sea", "en") for i in range(9)], DOCS), 8)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    assert len(seen) == 4
    for plan in seen:
        assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning(chunk") == 1, plan


def test_chunks_are_bounded_and_numbered_by_count(monkeypatch):
    monkeypatch.setattr(collocations, "CHUNK", 100)
    langs = [f"l{i % 40}" for i in range(2000)]
    batch = pa.RecordBatch.from_pydict({"lang": langs, "text": ["b a. c a " * 2] * len(langs)})
    chunks = [(lang, collocations._by_count(codes, stream), size) for lang, codes, stream, size
              in collocations._chunks([batch])]
    assert sum(int(counts.sum()) for _, (_, counts, _), _ in chunks) == 8 * len(langs)
    assert max(size for *_, size in chunks) <= 111 and len(chunks) > 200  # 40 languages of 550 words never wait together
    for _, (words, counts, stream), _ in chunks:
        assert words == [b"a", b"b", b"c"] and counts[0] == 2 * counts[1] == 2 * counts[2]
        assert list(counts) == list(np.bincount(stream)[1:])
    long = pa.RecordBatch.from_pydict({"lang": ["en"] * 9, "text": ["z" * 900] * 9})
    assert len([*collocations._chunks([long])]) == 5  # long words count by their bytes


# --- packing ---

def fewest(items, capacity):
    """Fewest sequences, by trying all ways."""
    @functools.lru_cache(maxsize=None)
    def best(left):
        if not left:
            return 0
        first, rest = left[0], left[1:]
        ways = []
        for k in range(len(rest) + 1):
            for with_it in set(itertools.combinations(rest, k)):
                if first + sum(with_it) <= capacity:
                    gone = collections.Counter(rest) - collections.Counter(with_it)
                    ways.append(best(tuple(sorted(gone.elements(), reverse=True))))
        return 1 + min(ways)

    return best(tuple(sorted(items, reverse=True)))


def test_fixed_sets_lose_no_optimal_packing():
    rnd = random.Random(5)
    fixed_any = 0
    for _ in range(250):
        capacity = rnd.choice([10, 14, 23])
        items = [rnd.randint(1, capacity) for _ in range(rnd.randint(1, 8))]
        counts = collections.Counter(items)
        fixed, left = packing.reduce(dict(counts), capacity)
        rest = list(collections.Counter(left).elements())
        fixed_any += len(rest) < len(items)
        used = collections.Counter(rest)
        for kind, times in fixed:
            assert sum(kind) <= capacity and times > 0
            for s in kind:
                used[s] += times
        assert used == counts
        assert sum(t for _, t in fixed) + fewest(rest, capacity) == fewest(items, capacity), items
    assert fixed_any > 200


def test_best_fit_is_best_fit_one_by_one():
    rnd = random.Random(6)
    for _ in range(200):
        items = sorted((rnd.randint(1, 30) for _ in range(rnd.randint(1, 60))), reverse=True)
        rooms = []
        for s in items:
            fits = [r for r in rooms if r >= s]
            if fits:
                rooms.remove(min(fits))
                rooms.append(min(fits) - s)
            else:
                rooms.append(30 - s)
        got = packing.best_fit(dict(collections.Counter(items)), 30)
        assert sorted(30 - sum(k) for k, t in got for _ in range(t)) == sorted(rooms)
        assert sorted(s for k, t in got for s in k * t) == sorted(items)


def check_packed(rows, capacity):
    placed = collections.defaultdict(list)
    for r in rows:
        placed[r.sequence_id].append((r.offset, r.length))
    for spans in placed.values():
        at = 0
        for offset, n in sorted(spans):
            assert offset == at
            at += n
        assert at <= capacity
    return len(placed)


ODD_TEXTS = [
    None, "", " ", "  two  spaces ", "it's John's, isn't it?", "line\n next \t\ttab", "café über Été.",
    "a   b  c", "<|endoftext|> x<|endoftext|>y", "\U0001f600 你好 Жизнь", "x" * 3000,
    "12 345,67 a1b2", "!!! ... ?", "soft­hyphen ­ x", "\x1c a \x85 b", " lead", "trail ", "é e ́",
    "word " * 900, "× 2 ÷ 3 ªº µm", "a ,b .c 'd 's",
]


def test_ids_equal_the_tokenizer():
    rnd = random.Random(7)
    path = public_tokenizers.path("byte_bpe_50k.json")
    whole, ids = Tokenizer.from_file(path), packing.Ids(path)
    alphabet = ["a", "B", "the", "é", "×", " ", " ", " ", "\n", "\t", ",", ".", "'s", "'", "1", " ", " ",
                "你", "\U0001f600", "­", "́", "\x1f", "\x85", "-", "ǅ", "ª"]
    texts = ODD_TEXTS + ["".join(rnd.choices(alphabet, k=rnd.randint(1, 40))) for _ in range(3000)]
    for t in texts:
        got = np.frombuffer(ids.of(t), "<u4").tolist()
        assert got == whole.encode(t or "", add_special_tokens=False).ids, repr(t)
    assert ids.ranked is not None
    plain = [chr(c) for c in (9, 10, 13, *range(32, 127), *range(0xA1, 0x250))]
    for _ in range(5000):
        t = "".join(rnd.choice(rnd.choice([plain, "aé1' \n.", "  st"])) for _ in range(rnd.randint(1, 30)))
        assert np.frombuffer(ids.of(t), "<u4").tolist() == whole.encode(t, add_special_tokens=False).ids, repr(t)


@pytest.mark.parametrize("capacity", [1024, 16])
def test_packing(spark, capacity):
    rows = [(i, t) for i, t in enumerate(ODD_TEXTS)] + [(None, "no id"), (3, "again"), (3, "again")]
    rows += [(100 + i, "w " * (i % 40)) for i in range(300)]
    got = packing.pack(frame(spark, rows, DOCS).repartition(5), capacity=capacity, with_ids=True).collect()
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = collections.Counter()
    for key, text in rows:
        ids = whole.encode(text or "", add_special_tokens=False).ids + [2]
        over = len(ids) % capacity
        cuts = ([ids[:over]] if over else []) + [ids[i : i + capacity] for i in range(over, len(ids), capacity)]
        at = 0
        for i, part in enumerate(cuts):
            crc = zlib.crc32(np.array(part, "<u4").tobytes())
            want[key, i, at, len(part), crc, tuple(part)] += 1
            at += len(part)
    assert collections.Counter(
        (r.doc_id, r.piece, r.start, r.length, r.ids_crc32, tuple(r.ids)) for r in got) == want
    used = check_packed(got, capacity)
    total = sum(r.length for r in got)
    assert used <= 1.02 * total / capacity + 2


def test_no_documents_need_no_sequence(spark):
    got = packing.pack(frame(spark, [], DOCS))
    assert got.collect() == []
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


# --- prefix trie ---

def brute_trie(rows):
    own = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(ts)] for c, ts in own.items()}
    built = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = tuple(own.get(c - c % 5, [])[:h] + ts[h:])
    members = collections.defaultdict(list)
    for c, ts in built.items():
        for d in range(len(ts) + 1):
            members[ts[:d]].append(c)
    kids = collections.Counter(p[:-1] for p in members if p)
    leaves, saved = collections.Counter(), collections.Counter()
    for p, cs in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += (len(cs) - 1) * len(p[-1][1].encode()) if p else 0
    out = []
    for p, cs in members.items():
        ends = ",".join(map(str, sorted(c for c in cs if built[c] == p)))
        out.append((min(cs), len(p), min(members[p[:-1]]) if p else -1, len(cs), kids[p], leaves[p], saved[p],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out)


@pytest.fixture(scope="module")
def talks():
    rnd = random.Random(13)
    rows = []
    for c in itertools.chain(range(60), range(1000, 1300, 3), [10**12, 10**12 + 1, 10**12 + 4]):
        for t in range(rnd.choice([1, 1, 2, 3, 5, 12])):
            rows.append((c, t, rnd.choice(["user", None, ""]), rnd.choice(["a", "b", "éé", None, "long " * 9])))
    for c in range(2000, 2300):  # copies of one conversation
        rows += [(c, t, "user", f"same {t}") for t in range(4)]
    rows += [(3, None, "system", "no number"), (3, None, "a", "first"), (4, 0, "user", "tie"), (4, 0, "user", "tie")]
    rows += [(None, 0, "user", "no conversation"), (5000, 1, "u", "x" * 50_000)]
    rows += [(6000, t, "user", f"{t % 3}") for t in range(700)]  # a very long one
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("fan,partitions", [(64, 1), (64, 7), (2, 7), (2, 23), (3, 60)])
def test_trie(spark, talks, monkeypatch, fan, partitions):
    monkeypatch.setattr(prefixtrie, "FAN", fan)
    monkeypatch.setattr(prefixtrie, "SEGMENT", 100)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = prefixtrie.trie(prefixtrie.rebuilt(frame(spark, talks, CONVERSATIONS))).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    got = sorted((*r[:2], -1 if r[2] is None else r[2], *r[3:]) for r in map(tuple, got))
    assert got == brute_trie(talks)


def test_no_conversations_have_no_trie(spark):
    assert prefixtrie.trie(prefixtrie.rebuilt(frame(spark, [], CONVERSATIONS))).collect() == []


def test_turnless_conversations_end_at_the_root(spark):
    # conversation 1 takes crc32("1") % 9 turns of the absent conversation 0
    rows = [(1, 0, "user", "a")]
    assert zlib.crc32(b"1") % 9 >= 1
    got = prefixtrie.trie(prefixtrie.rebuilt(frame(spark, rows, CONVERSATIONS)))
    assert [tuple(r) for r in got.select("conv_id", "depth", "n_convs", "n_children", "n_leaves").collect()] == [
        (1, 0, 1, 0, 1)]
    assert got.filter(F.col("parent_conv_id").isNotNull()).count() == 0
