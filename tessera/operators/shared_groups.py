"""Several grouped tables of one input from one pass, as mergeable state.

Tables with different keys over the same rows are one aggregate over GROUPING
SETS: a set per table (its keys) and a set per exact distinct count (its keys and
the counted column). Catalyst plans it as one scan, one Expand and one exchange;
partial aggregation collapses hot groups before the shuffle, and a distinct set is
spread by the counted value. ``publish`` needs a second, small exchange to count
the values per group.

The rows of that aggregate are a *state*: per set and key, the row count and per
measured column an exact decimal sum, a non-null count, the least and the largest
value; for distinct sets the mere presence of the value. States of disjoint parts
of the input merge by adding, so a feed keeps them instead of its rows. Decimal
and whole-number sums do not depend on the order of merging.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.aggregate import DEC_IN, exact_ratio
from tessera.plans.gold import GoldSpec

SET = "_set"
ROWS = "_rows"
# how each part of a measured column is taken from rows and from states
_PARTS = {"sum": F.sum, "n": F.sum, "min": F.min, "max": F.max}
_NEEDS = {"sum": ("sum", "n"), "avg": ("sum", "n"), "min": ("min",), "max": ("max",)}


def grouping_sets(specs: Sequence[GoldSpec]) -> list[tuple[str, ...]]:
    """The distinct column sets that ``specs`` need, in order of first use."""
    sets: dict[frozenset, tuple[str, ...]] = {}
    for spec in specs:
        for extra in ((), *((m.column,) for m in spec.measures if m.fn == "cd")):
            columns = tuple(dict.fromkeys((*spec.keys, *extra)))
            sets.setdefault(frozenset(columns), columns)
    return list(sets.values())


def _set_of(specs: Sequence[GoldSpec], columns: Sequence[str]) -> int:
    return [frozenset(s) for s in grouping_sets(specs)].index(frozenset(columns))


def _key_columns(specs: Sequence[GoldSpec]) -> list[str]:
    return list(dict.fromkeys(c for s in grouping_sets(specs) for c in s))


def _parts(specs: Sequence[GoldSpec]) -> list[tuple[str, str]]:
    """(column, part) of every measured column."""
    found = {}
    for spec in specs:
        for m in spec.measures:
            if m.fn in ("count", "cd"):
                continue
            if m.fn not in _NEEDS:
                raise ValueError(f"{m.fn} of {m.column} has no exact mergeable state")
            found.update(((m.column, p), None) for p in _NEEDS[m.fn])
    return list(found)


def _name(column: str, part: str) -> str:
    return f"_{part}_{column}"


def state(df: DataFrame, specs: Sequence[GoldSpec]) -> DataFrame:
    """The state of ``df``: SET, key columns as ``_k_<column>`` (null outside the
    set), ROWS and the parts; the latter only in rows of the tables' own sets."""
    types, sets, keys = dict(df.dtypes), grouping_sets(specs), _key_columns(specs)
    parts = _parts(specs)
    measured = list(dict.fromkeys(c for c, _ in parts))
    rows = df.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[F.col(c).alias(f"_v_{c}") for c in measured])

    def part(column: str, name: str) -> Column:
        v = F.col(f"_v_{column}")
        if name == "sum":
            v = F.sum(v.cast(DEC_IN if types[column] == "double" else "decimal(38,0)"))
        else:
            v = {"n": F.count, "min": F.min, "max": F.max}[name](v)
        return v.alias(_name(column, name))

    grouped = rows.groupingSets([[F.col(f"_k_{c}") for c in s] for s in sets], *[F.col(f"_k_{k}") for k in keys])
    out = grouped.agg(
        F.grouping_id().alias("_gid"), F.count(F.lit(1)).alias(ROWS), *[part(c, p) for c, p in parts])
    # a key outside a set has its bit set, the first key the highest
    bit = {k: 1 << (len(keys) - 1 - i) for i, k in enumerate(keys)}
    number = F.create_map(*[
        F.lit(x) for i, s in enumerate(sets) for x in (sum(b for k, b in bit.items() if k not in s), i)])
    own = {_set_of(specs, spec.keys) for spec in specs}
    out = out.withColumn(SET, number[F.col("_gid").cast("int")]).drop("_gid")
    plain = F.col(SET).isin(*own)
    return out.select(
        SET, *[f"_k_{k}" for k in keys], ROWS,
        *[F.when(plain, F.col(_name(c, p))).alias(_name(c, p)) for c, p in parts])


def merge(states: Sequence[DataFrame], specs: Sequence[GoldSpec]) -> DataFrame:
    """One state of all parts."""
    every = reduce(DataFrame.unionByName, states)
    keys = [SET, *[f"_k_{k}" for k in _key_columns(specs)]]
    merged = every.groupBy(*keys).agg(
        F.sum(ROWS).alias(ROWS), *[_PARTS[p](_name(c, p)).alias(_name(c, p)) for c, p in _parts(specs)])
    # sums keep the type they have in a state
    return merged.select([F.col(f.name).cast(f.dataType) for f in every.schema])


def publish(merged: DataFrame, specs: Sequence[GoldSpec]) -> DataFrame:
    """All tables from a merged state, one row per (``_table``, keys): one more
    exchange over groups."""
    keys = _key_columns(specs)
    uses: dict[int, list[tuple[int, str]]] = {}
    for t, spec in enumerate(specs):
        uses.setdefault(_set_of(specs, spec.keys), []).append((t, ""))
        for m in spec.measures:
            if m.fn == "cd":
                uses.setdefault(_set_of(specs, (*spec.keys, m.column)), []).append((t, m.column))
    use = F.create_map(*[
        x for s, of in uses.items()
        for x in (F.lit(s), F.array(*[F.struct(F.lit(t).alias("t"), F.lit(c).alias("c")) for t, c in of]))])
    rows = merged.withColumn("_use", F.explode(use[F.col(SET)])).withColumn("_table", F.col("_use.t"))
    # keys of the table only: a counted column is a value here
    inside = {k: [t for t, spec in enumerate(specs) if k in spec.keys] for k in keys}
    group = [F.when(F.col("_table").isin(*of), F.col(f"_k_{k}")).alias(k) for k, of in inside.items() if of]
    names = [k for k, of in inside.items() if of]
    counted = list(dict.fromkeys(m.column for spec in specs for m in spec.measures if m.fn == "cd"))
    values = [
        F.when((F.col("_use.c") == c) & F.col(f"_k_{c}").isNotNull(), F.lit(1)).otherwise(F.lit(0)).alias(f"_d_{c}")
        for c in counted
    ]
    parts = [(ROWS, "n"), *((_name(c, p), p) for c, p in _parts(specs))]
    own = F.col("_use.c") == ""
    rows = rows.select("_table", *group, *values, *[F.when(own, F.col(c)).alias(c) for c, _ in parts])
    return rows.groupBy("_table", *names).agg(
        *[F.sum(f"_d_{c}").alias(f"_d_{c}") for c in counted], *[_PARTS[p](c).alias(c) for c, p in parts])


def table_of(published: DataFrame, specs: Sequence[GoldSpec], name: str, types: dict[str, str],
             ordered: bool = True) -> DataFrame:
    """One table of ``publish``, with its keys, measures and order."""
    at = [s.name for s in specs].index(name)
    spec = specs[at]

    def measure(m) -> Column:
        if m.fn == "count":
            return F.col(ROWS).cast("bigint").alias(m.name)
        if m.fn == "cd":
            return F.col(f"_d_{m.column}").cast("bigint").alias(m.name)
        double = types[m.column] == "double"
        total, n = F.col(_name(m.column, "sum")), F.col(_name(m.column, "n"))
        if m.fn == "avg" and double:
            return exact_ratio(total, n, m.scale).alias(m.name)
        if m.fn == "avg":
            e = F.when(n > 0, total.cast("double") / n)
        elif m.fn == "sum":
            e = F.round(total, m.scale) if double and m.scale is not None else total
            return F.when(n > 0, e.cast("double" if double else "bigint")).alias(m.name)
        else:
            e = F.col(_name(m.column, m.fn)).cast(types[m.column])
        return (F.round(e, m.scale) if m.scale is not None else e).alias(m.name)

    out = published.filter(F.col("_table") == at).select(*spec.keys, *[measure(m) for m in spec.measures])
    return out.orderBy(*spec.order) if ordered else out


def tables(df: DataFrame, specs: Sequence[GoldSpec]) -> DataFrame:
    """``publish`` straight from rows: one scan and two exchanges for all tables."""
    return publish(state(df, specs), specs)
