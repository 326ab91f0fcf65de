"""Secret scans through a trigram inverted index. DataFrame functions only.

Each rule's regex is reduced to a Boolean query over lower-cased trigrams that
every match must contain (an OR of clauses, each an AND of trigrams). The index
holds, for every trigram that some query names, the rows with it, found in one
pass over the texts: the vocabulary comes from the rules, so postings stay small
beside the texts. Postings are intersected per clause; a rule's regex runs on the
rows that satisfy a clause of its query and on no others. Rules without mandatory
trigrams (hex runs) are looked for in every text.

Rows get a number of their own and are written with it once, so rows that share
an id, or have none, are as apart as any others; the numbers of the candidates
are written too, and Spark joins them by their real size (the texts are not
shuffled while candidates are few).

Positions come from cutting the text at the matches and adding up the lengths of
pieces and matches, one step a match. Where a rule is a run of characters, after
letters of that run at most, its least length is part of the pattern: the
same spans, without the many short runs.

Defined cases: null or empty text has no span and base_sha256 of the empty
string; texts of any length and any number of matches are searched whole; an
empty table gives no rows. Other columns pass by.
"""

from __future__ import annotations

import itertools
import re
from dataclasses import dataclass
from re import _constants as rc
from re import _parser as rp

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import apart, stage, table


@dataclass(frozen=True)
class Rule:
    kind: str
    regex: str          # syntax common to Java and Python; ASCII only
    any_case: bool = False
    group: int = 0      # the group whose length is checked
    least: int = 0      # its least length; shorter matches are dropped
    base: bool = False


# The base kinds in their order of listing.
BASE_RULES = (
    Rule("assign",
         r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         any_case=True, group=2, least=8, base=True),
    Rule("access", r"AKIA[A-Z0-9]+", least=16, base=True),
    Rule("hex", r"[0-9a-f]+", least=32, base=True),
)
# Published shapes of credentials that the base kinds do not cover.
MORE_RULES = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", least=40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", least=20),
    Rule("google", r"AIza[A-Za-z0-9_-]+", least=39),
    Rule("stripe", r"[sr]k_live_[A-Za-z0-9]+", least=24),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", least=30),
    Rule("bearer", r"bearer\x20+([A-Za-z0-9._~+/=-]+)", any_case=True, group=1, least=16),
    Rule("url", r"[a-z][a-z0-9+.-]*://[A-Za-z0-9._~-]+:([^\x20\x09-\x0D/@:]+)@", group=1, least=4),
)
RULES = BASE_RULES + MORE_RULES

_MOST = 64  # strings followed per run before it is cut


def _strings(items) -> list[set[str] | None]:
    """Per node of a regex: its finite set of strings, or None."""
    out: list[set[str] | None] = []
    for op, arg in items:
        if op is rc.LITERAL:
            out.append({chr(arg)})
        elif op is rc.SUBPATTERN:
            out.append(_joined(_strings(arg[-1])))
        elif op is rc.BRANCH:
            parts = [_joined(_strings(p)) for p in arg[1]]
            out.append(None if None in parts else set().union(*parts))
        elif op is rc.IN and all(k is rc.LITERAL for k, _ in arg) and len(arg) <= 5:
            out.append({chr(c) for _, c in arg})
        elif op is rc.MAX_REPEAT and arg[1] <= 1:
            inner = _joined(_strings(arg[2]))
            out.append(None if inner is None else inner | ({""} if arg[0] == 0 else set()))
        else:
            out.append(None)
    return out


def _joined(parts: list[set[str] | None]) -> set[str] | None:
    out = {""}
    for p in parts:
        if p is None or len(out) * len(p) > _MOST:
            return None
        out = {a + b for a, b in itertools.product(out, p)}
    return out


def _runs(items) -> list[set[str]]:
    """Sets of strings, one of each of which every match contains; a string
    that holds another of its set adds nothing and is left out."""
    runs, now = [], {""}
    for node, strings in zip(items, _strings(items)):
        if strings is not None and len(now) * len(strings) <= _MOST:
            now = {a + b for a, b in itertools.product(now, strings)}
            continue
        runs.append(now)
        now = strings if strings is not None else {""}
        op, arg = node
        if strings is None and op is rc.SUBPATTERN:
            runs += _runs(arg[-1])
        elif strings is None and op is rc.MAX_REPEAT and arg[0] >= 1:
            runs += _runs(arg[2])
    return [{s for s in r if not any(t != s and t in s for t in r)} for r in [*runs, now]]


_RARE = "etaoinshrdlcumwfgypbvkjxqz"  # letters from common to rare
_MOST_TERMS = 3


def _selective(gram: str) -> int:
    return sum(_RARE.find(c) if c in _RARE else 2 * len(_RARE) for c in gram)


def trigram_query(regex: str) -> list[frozenset[str]]:
    """The regex's query: a match holds all trigrams of at least one clause.
    A clause names at most ``_MOST_TERMS``, those of the rarest letters; fewer
    terms only let more candidates through. Empty: nothing is mandatory."""
    clauses = [frozenset()]
    for run in _runs(list(rp.parse(regex))):
        grams = {frozenset(s.lower()[i : i + 3] for i in range(len(s) - 2)) for s in run}
        if frozenset() not in grams and len(grams) * len(clauses) <= _MOST:
            clauses = [a | b for a, b in itertools.product(clauses, grams)]
    clauses = {frozenset(sorted(c, key=lambda t: (-_selective(t), t))[:_MOST_TERMS]) for c in clauses}
    clauses = {c for c in clauses if not any(d < c for d in clauses)}
    return [] if frozenset() in clauses else sorted(clauses, key=sorted)


def _one_of(grams: list[str]) -> str:
    """A regex for any of ``grams`` (all of three characters), by first characters."""
    quoted = lambda text: "".join(c if c.isalnum() else "\\" + c for c in text)
    heads = itertools.groupby(sorted(grams), key=lambda g: g[0])
    return "|".join(f"{quoted(h)}(?:{'|'.join(quoted(g[1:]) for g in of)})" for h, of in heads)


def index(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """Postings (trigram, _row) of the named trigrams, in any case of letters."""
    found = F.regexp_extract_all("text", F.lit(f"(?i)(?=({_one_of(trigrams)}))"), F.lit(1))
    held = F.array_distinct(F.transform(found, F.lower))
    return docs.select("_row", F.explode(held).alias("trigram"))


def candidates(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """_row and the kinds whose trigram query its postings satisfy."""
    spark = docs.sparkSession
    queries = {r.kind: trigram_query(r.regex) for r in rules}
    terms = [(k, i, t, len(c)) for k, q in queries.items() for i, c in enumerate(q) for t in sorted(c)]
    names = "kind string, clause int, trigram string, need int"
    if not terms:
        return docs.select("_row", F.array().cast("array<string>").alias("kinds")).limit(0)
    # as many rows as the rules have trigrams, whatever the input
    wanted = F.broadcast(spark.createDataFrame(terms, names))
    postings = index(docs, sorted({t for _, _, t, _ in terms}))
    met = postings.join(wanted, "trigram").groupBy("_row", "kind", "clause", "need").agg(
        F.count(F.lit(1)).alias("have")  # a row has a trigram once
    ).filter("have = need")
    return met.groupBy("_row").agg(F.collect_set("kind").alias("kinds"))


def _sized(rule: Rule) -> str | None:
    """The rule as a pattern that holds its least length, if that gives the same
    spans: one run of a class, led by characters of that class at most. (A shorter
    match is then a whole run, in which no later start can be longer.)"""
    if rule.group or rule.any_case or not rule.regex.endswith("]+"):
        return None
    at = rule.regex.rindex("[")
    head, kind = rule.regex[:at], rule.regex[at:-1]
    if not re.fullmatch(rf"{kind}*", head) or not re.fullmatch(r"\w*", head):
        return None
    return f"{head}{kind}{{{max(1, rule.least - len(head))},}}"


def _spans(rule: Rule, order: int) -> Column:
    """Kept matches of one rule: array of (start, order, end, kind)."""
    pattern = _sized(rule) or ("(?i)" if rule.any_case else "") + rule.regex
    found = F.regexp_extract_all("_t", F.lit(pattern), F.lit(0))
    tested = F.regexp_extract_all("_t", F.lit(pattern), F.lit(rule.group)) if rule.group else found
    held = F.struct(
        F.transform(found, F.length).alias("size"), F.transform(tested, F.length).alias("test"),
        F.transform(F.split("_t", pattern, -1), F.length).alias("gap"),
    )

    def step(acc: Column, m: Column) -> Column:
        start = acc["at"] + m["gap"]
        end = start + m["size"]
        span = F.struct(start.alias("start"), F.lit(order).alias("order"), end.alias("end"),
                        F.lit(rule.kind).alias("kind"))
        return F.struct(
            end.alias("at"),
            F.when(m["test"] >= rule.least, F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).alias("out"))

    def spans(h: Column) -> Column:
        matches = F.transform(h["size"], lambda n, i: F.struct(
            F.get(h["gap"], i).alias("gap"), n.alias("size"), F.get(h["test"], i).alias("test")))
        zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(_NONE).alias("out"))
        return F.aggregate(matches, zero, step, lambda acc: acc["out"])

    # one-element array: the struct is computed once for all its uses
    return F.flatten(F.transform(F.array(held), spans))


_NONE = "array<struct<start:bigint,order:int,end:bigint,kind:string>>"


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with ``spans``: array of (start, order, end, kind), by start
    then by the rules' order; code points, end exclusive. A column of that name
    is replaced."""
    docs, back = apart(docs, "text")
    docs = stage(docs.withColumn("_row", F.monotonically_increasing_id()), "secret-rows")
    kinds = stage(candidates(docs, rules).toDF("_id", "_kinds"), "secret-candidates")
    joined = docs.join(kinds, F.col("_row") == F.col("_id"), "left").withColumn("_t", F.coalesce("text", F.lit("")))
    parts = []
    for i, rule in enumerate(rules):
        if trigram_query(rule.regex):
            open_ = F.array_contains("_kinds", rule.kind)
        else:
            open_ = F.col("_t").rlike(_sized(rule) or ("(?i)" if rule.any_case else "") + rule.regex)
        parts.append(F.when(open_, _spans(rule, i)).otherwise(F.array().cast(_NONE)))
    return back(joined.withColumn("spans", F.array_sort(F.concat(*parts))), "spans")


def _text(spans: Column) -> Column:
    return F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    ), ",")


def query(spark, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("spans", lambda s: s["order"] < len(BASE_RULES))
    return found.select(
        "doc_id",
        *[count(r.kind).alias(f"n_{r.kind}") for r in BASE_RULES],
        F.sha2(_text(base).cast("binary"), 256).alias("base_sha256"),
        _text(F.col("spans")).alias("spans"),
    )


def redact(docs: DataFrame, mark: str = "[REDACTED]") -> DataFrame:
    """``docs`` with every span of their texts replaced by ``mark`` (spans that
    overlap by one mark) and n_chars counted anew; null texts stay null."""
    inner, back = apart(docs, "text", "n_chars")
    found = scan(inner)
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out"))

    def cut(at: Column, n: Column) -> Column:
        return F.substring(F.col("text"), (at + 1).cast("int"), n.cast("int"))

    def step(acc: Column, s: Column) -> Column:
        kept = cut(acc["at"], F.greatest(s["start"] - acc["at"], F.lit(0)))
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(s["start"] >= acc["at"], F.concat(acc["out"], F.array(kept, F.lit(mark))))
            .otherwise(acc["out"]).alias("out"),
        )

    def finish(acc: Column) -> Column:
        return F.array_join(F.concat(acc["out"], F.array(cut(acc["at"], F.lit(2**31 - 1)))), "")

    clean = F.when(F.size("spans") == 0, F.col("text")).otherwise(F.aggregate("spans", start, step, finish))
    out = found.withColumn("text", clean).drop("spans")
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return back(out)
