"""Aggregates over an inner equi-join, computed without emitting the pairs.

The gold tables aggregate over ``left JOIN right ON key`` where the key is
unique on neither side, so the join fans out: a name with a rows on the left
and b rows on the right yields a*b pairs, and the published counts, sums and
standard deviations are taken over those pairs. Materialising the pairs is
quadratic in the hottest key. Instead every quantity is derived from
per-block summaries:

1. Each side is reduced to blocks ``(join key, that side's group keys)`` with
   row count, and per measured column: non-null count, sum, squared
   deviations from the block mean, min, max. This is a partial (map-side) aggregate, so a key holding a third
   of all rows is already collapsed before the shuffle.
2. The two block tables are joined on the join key. A block pair stands for
   ``n_left * n_right`` pairs: a left column's pair-sum is its block sum times
   the right block's row count (and vice versa); min and max are unchanged.
3. Exact distinct counts over pairs: a value of a left column counts in a
   group iff its row has a partner with that group's right keys. Values are
   deduplicated per ``(join key, left keys, value)`` and paired with the
   right side's *distinct* key combinations per join key, never with its
   rows. When that pairing could itself fan out (``join_stats`` measures it),
   values that occur under a single join key -- ids, the usual case -- are
   counted through their block instead, and only values shared by several
   join keys are paired and deduplicated.
4. The additive and distinct parts are joined on the (small) group keys with
   null-safe equality, since NULL group keys form groups.

The result equals ``GROUP BY`` over the literal join (the SQL oracle runs
that form).

``strategy="auto"`` first computes the exact number of pairs from per-key
row counts (two partial aggregates and a join of one row per key, returning
one scalar). When the join emits no more than ``max_fanout`` times the larger
input, the plain join + aggregate is used (it is cheaper when keys are close
to unique); otherwise the block plan above. The joined rows of the plain form are
dealt once by the left side's group keys where these are many and none is hot:
all its distinct counts are then made where the rows are.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.aggregate import DEC_IN, Measure, exact_ratio, measure_column


# Joined rows are dealt into partitions of about so many rows, if there are so many
# left group keys to a partition and none has ``SKEW`` times a partition's rows.
DEALT_ROWS = 1 << 17
DEALT_KEYS = 16
SKEW = 4


def _cname(*parts: str) -> str:
    return "_".join(["", *parts]).replace(".", "_")


def join_stats(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[tuple[str, str]],
    left_keys: Sequence[str] = (),
    right_keys: Sequence[str] = (),
    with_combos: bool = True,
) -> dict[str, int]:
    """Sizes of the inner join computed from per-key summaries, one scalar row:

    * ``pairs`` rows the join would emit; ``left``/``right`` rows with a key;
    * ``left_combo``: sum over keys of left rows x distinct right group-key
      combinations (the rows a left-value-to-right-keys pairing emits), and
      ``right_combo`` the mirror image (only ``with_combos``).
    """
    jn = [f"_j{i}" for i in range(len(on))]

    def side(df: DataFrame, cols: Sequence[str], keys: Sequence[str], tag: str) -> DataFrame:
        own = [k for k in keys if with_combos and k not in cols]  # the others are join columns
        base = df.select(*[F.col(c).alias(j) for c, j in zip(cols, jn)], *own).filter(
            reduce(lambda a, b: a & b, [F.col(j).isNotNull() for j in jn]))
        counts = base.groupBy(*jn, *own).agg(F.count(F.lit(1)).alias(f"_{tag}n"))
        if not own:
            return counts.withColumn(f"_{tag}k", F.lit(1 if with_combos else None).cast("bigint"))
        return counts.groupBy(*jn).agg(F.sum(f"_{tag}n").alias(f"_{tag}n"), F.count(F.lit(1)).alias(f"_{tag}k"))

    stats = side(left, [a for a, _ in on], left_keys, "l").join(
        side(right, [b for _, b in on], right_keys, "r"), jn, "full")
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    row = stats.agg(
        F.sum(wide("_ln") * wide("_rn")).alias("pairs"),
        F.sum("_ln").alias("left"),
        F.sum("_rn").alias("right"),
        F.sum(wide("_ln") * wide("_rk")).alias("left_combo"),
        F.sum(wide("_rn") * wide("_lk")).alias("right_combo"),
    ).first()
    return {k: int(row[k] or 0) for k in ("pairs", "left", "right", "left_combo", "right_combo")}


def pair_stats(left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]]) -> tuple[int, int, int]:
    """(pairs, left rows, right rows) of the inner join, without joining rows."""
    st = join_stats(left, right, on, with_combos=False)
    return st["pairs"], st["left"], st["right"]


def join_aggregate(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[tuple[str, str]],
    keys: Sequence[str],
    measures: Sequence[Measure],
    sides: tuple[str, str] = ("l", "r"),
    order: Sequence[str] | None = None,
    strategy: str = "auto",
    max_fanout: float = 2.0,
) -> DataFrame:
    """``keys`` and measure columns are side-qualified (``"p.age_group"``);
    output key columns are named by the unqualified column."""
    la, ra = sides
    split = {la: True, ra: True}
    dealt = None
    if strategy == "auto":
        lk = [k.split(".", 1)[1] for k in keys if k.startswith(la + ".")]
        rk = [k.split(".", 1)[1] for k in keys if k.startswith(ra + ".")]
        st = join_stats(left, right, on, with_combos=False)
        if st["pairs"] <= max_fanout * max(st["left"], st["right"], 1):
            strategy = "direct"
            types = {la: dict(left.dtypes), ra: dict(right.dtypes)}
            counted = [types[m.side][m.column] for m in measures if m.fn == "cd"]
            # values are told apart as text
            if lk and len(counted) > 1 and set(counted) <= {"string", "tinyint", "smallint", "int", "bigint"}:
                dealt = _dealt(left, [a for a, _ in on], lk, st["pairs"])
        else:
            strategy = "blocked"
            st = join_stats(left, right, on, lk, rk)
            # pair values with partner key combinations directly when that
            # emits no more than max_fanout x the side's rows
            split = {
                la: st["left_combo"] > max_fanout * max(st["left"], 1),
                ra: st["right_combo"] > max_fanout * max(st["right"], 1),
            }
    if strategy == "direct":
        return direct_join_aggregate(left, right, on, keys, measures, sides, order, dealt)
    return blocked_join_aggregate(left, right, on, keys, measures, sides, order, split)


def _dealt(left: DataFrame, on: Sequence[str], left_keys: Sequence[str], pairs: int) -> int | None:
    """Partitions to deal ``pairs`` joined rows into by the left group keys; None
    when these are too few for that or one is on too many rows."""
    wanted = max(int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-pairs // DEALT_ROWS))
    row = left.dropna(subset=list(on)).groupBy(*left_keys).agg(F.count(F.lit(1)).alias("n")).agg(
        F.count(F.lit(1)).alias("groups"), F.max("n").alias("most"), F.sum("n").alias("rows")).first()
    if row.groups < DEALT_KEYS * wanted or row.most * wanted > SKEW * row.rows:
        return None
    return wanted


def direct_join_aggregate(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[tuple[str, str]],
    keys: Sequence[str],
    measures: Sequence[Measure],
    sides: tuple[str, str] = ("l", "r"),
    order: Sequence[str] | None = None,
    dealt: int | None = None,
) -> DataFrame:
    """The literal form: inner join, then one grouped aggregate (Catalyst
    plans the distinct counts as Expand + two-level aggregation). Expand shuffles a
    copy of the row for each distinct count; with ``dealt`` the rows move once, to so
    many partitions by the left side's group keys, and are copied there."""
    la, ra = sides
    dtypes = {la: dict(left.dtypes), ra: dict(right.dtypes)}
    cond = reduce(lambda a, b: a & b, [F.col(f"{la}.{a}") == F.col(f"{ra}.{b}") for a, b in on])
    joined = left.alias(la).join(right.alias(ra), cond, "inner")
    if dealt:
        out = _dealt_aggregate(joined, keys, measures, dtypes, dealt, [k for k in keys if k.startswith(la + ".")])
        # the sort samples its input, which is not to be made twice
        return out.repartition(*order).orderBy(*order) if order else out
    # one aggregate over the join: splitting plain and distinct aggregates
    # would run the join twice (exchanges are reused, sort-merge sorts are not)
    out = joined.groupBy(*[F.col(k).alias(k.split(".", 1)[1]) for k in keys]).agg(
        *[measure_column(m, dtypes[m.side].get(m.column) if m.side else None, qualified=True)
          for m in measures]
    )
    return out.orderBy(*order) if order else out


def _dealt_aggregate(
    joined: DataFrame,
    keys: Sequence[str],
    measures: Sequence[Measure],
    dtypes: dict[str, dict[str, str]],
    dealt: int,
    by: Sequence[str],
) -> DataFrame:
    """The grouped aggregate of joined rows that are dealt by some of the keys.
    Each row stands once for every distinct count, with its value, and once (tag 0)
    for the other measures. Rows of a group are in one partition, so neither
    collapsing the values nor counting them moves any."""
    names = [k.split(".", 1)[1] for k in keys]
    distinct = [m for m in measures if m.fn == "cd"]
    plain = [m for m in measures if m.fn != "cd"]
    read = {m.col: _cname("v", m.col) for m in measures if m.col}
    rows = joined.select(*[F.col(k).alias(k.split(".", 1)[1]) for k in keys],
                         *[F.col(c).alias(v) for c, v in read.items()])
    rows = rows.repartition(dealt, *[k.split(".", 1)[1] for k in by])
    tagged = F.explode(F.array(
        F.struct(F.lit(0).alias("_tag"), F.lit(None).cast("string").alias("_val")),
        *[F.struct(F.lit(i).alias("_tag"), F.col(read[m.col]).cast("string").alias("_val"))
          for i, m in enumerate(distinct, 1)]))
    whole = F.col("_tag") == 0
    copies = rows.withColumn("_tv", tagged).select(
        *names, "_tv._tag", "_tv._val", *dict.fromkeys(read[m.col] for m in plain if m.col))
    values = copies.filter(whole | F.col("_val").isNotNull()).select(
        *names, "_tag", "_val",
        *[F.when(whole, F.col(v)).alias(v) for v in dict.fromkeys(read[m.col] for m in plain if m.col)]
    ).groupBy(*names, "_tag", "_val").agg(
        *[measure_column(replace(m, col=read[m.col]) if m.col else m, dtypes[m.side].get(m.column) if m.side else None)
          for m in plain] or [F.count(F.lit(1)).alias("_n")])

    def of_group(m: Measure) -> Column:
        if m.fn == "cd":
            return F.count(F.when(F.col("_tag") == 1 + distinct.index(m), 1)).alias(m.name)
        one = F.max(F.when(whole, F.col(m.name)))  # of the group's only row with tag 0
        return (F.coalesce(one, F.lit(0)) if m.fn == "count" else one).alias(m.name)

    return values.groupBy(*names).agg(*[of_group(m) for m in measures])


def blocked_join_aggregate(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[tuple[str, str]],
    keys: Sequence[str],
    measures: Sequence[Measure],
    sides: tuple[str, str] = ("l", "r"),
    order: Sequence[str] | None = None,
    split_shared: dict[str, bool] | None = None,
) -> DataFrame:
    """Pair-free form (see module docstring). ``split_shared[side]`` False
    pairs that side's distinct values with partner key combinations without
    the single/shared split (safe when ``join_stats`` bounds that pairing)."""
    split_shared = split_shared or {}
    la, ra = sides
    frames = {la: left, ra: right}
    join_cols = {la: [a for a, _ in on], ra: [b for _, b in on]}
    jnames = [f"_j{i}" for i in range(len(on))]
    side_keys = {s: [k.split(".", 1)[1] for k in keys if k.split(".", 1)[0] == s] for s in sides}
    # group keys that are also join columns travel once, as the join column
    own_keys = {s: [k for k in side_keys[s] if k not in join_cols[s]] for s in sides}
    out_keys = [k.split(".", 1)[1] for k in keys]
    key_side = {k.split(".", 1)[1]: k.split(".", 1)[0] for k in keys}

    def key_col(k: str) -> Column:
        s = key_side[k]
        if k in join_cols[s]:
            return F.col(jnames[join_cols[s].index(k)]).alias(k)
        return F.col(k)

    additive = [m for m in measures if m.fn not in ("count", "cd")]
    distinct = [m for m in measures if m.fn == "cd"]

    def prepared(s: str) -> DataFrame:
        cols = {m.column for m in measures if m.side == s and m.fn != "count"}
        sel = [F.col(c).alias(j) for c, j in zip(join_cols[s], jnames)]
        sel += [F.col(k) for k in own_keys[s]]
        sel += [F.col(c).alias(_cname("v", s, c)) for c in sorted(cols)]
        df = frames[s].select(*sel)
        return df.filter(reduce(lambda a, b: a & b, [F.col(j).isNotNull() for j in jnames]))

    prep = {s: prepared(s) for s in sides}
    dtypes = {s: dict(frames[s].dtypes) for s in sides}

    def exact(m: Measure) -> bool:
        return m.fn in ("sum", "avg") and dtypes[m.side].get(m.column) == "double"

    def whole(m: Measure) -> bool:
        return dtypes[m.side].get(m.column) in ("tinyint", "smallint", "int", "bigint")

    # 1. per-side blocks. Parts per measured column: c = non-null count,
    # d = exact decimal sum (sum/avg of DOUBLE), s = plain sum, m2 = sum of
    # squared deviations from the block mean, min/max.
    def parts_of(m: Measure) -> set[str]:
        if m.fn in ("min", "max"):
            return {m.fn}
        if m.fn == "stddev":
            return {"c", "s", "m2"}
        return {"c", "d"} if exact(m) else {"c", "s"}

    def blocks(s: str) -> DataFrame:
        aggs = [F.count(F.lit(1)).alias(_cname("n", s))]
        seen: set[str] = set()
        for m in additive:
            if m.side != s:
                continue
            v = F.col(_cname("v", s, m.column))
            base = _cname(s, m.column)
            for w in sorted(parts_of(m)):
                name = f"{base}_{w}"
                if name in seen:
                    continue
                seen.add(name)
                expr = {
                    "c": F.count(v),
                    "d": F.sum(v.cast(DEC_IN)),
                    # whole numbers in a type that no weighted sum leaves
                    "s": F.sum(v.cast("decimal(38,0)") if whole(m) else v),
                    # within-block sum of squared deviations (stable moments)
                    "m2": F.coalesce(F.var_samp(v) * (F.count(v) - 1), F.lit(0.0)),
                    "min": F.min(v),
                    "max": F.max(v),
                }[w]
                aggs.append(expr.alias(name))
        return prep[s].groupBy(*jnames, *own_keys[s]).agg(*aggs)

    lb, rb = blocks(la), blocks(ra)
    paired = lb.join(rb, on=jnames, how="inner")
    paired = paired.select("*", *[key_col(k) for k in out_keys if k not in own_keys[key_side[k]]])

    # 2. weighted roll-up to the group keys
    def weight(s: str) -> Column:
        other = ra if s == la else la
        return F.col(_cname("n", other))

    agg_exprs: list[Column] = []
    for m in measures:
        if m.fn == "cd":
            continue
        scaled = True
        if m.fn == "count":
            e = F.sum(F.col(_cname("n", la)) * F.col(_cname("n", ra)))
        else:
            s, base = m.side, _cname(m.side, m.column)
            w = weight(s)
            cnt = F.sum(F.col(f"{base}_c") * w) if m.fn not in ("min", "max") else None
            if exact(m):
                # block decimal sum x pair weight, exact: decimal(25,8) * decimal(12,0)
                # -> decimal(38,8), no scale lost; block sums to 1e17, weights to 1e12
                tot = F.sum(F.col(f"{base}_d").cast("decimal(25,8)") * w.cast("decimal(12,0)"))
                if m.fn == "sum":
                    e = (F.round(tot, m.scale) if m.scale is not None else tot).cast("double")
                else:
                    e = exact_ratio(tot, cnt, m.scale)
                scaled = False
            elif m.fn == "sum":
                e = F.sum(F.col(f"{base}_s") * w)
                e = e.cast("bigint") if whole(m) else e
            elif m.fn == "avg":
                e = F.when(cnt > 0, F.sum(F.col(f"{base}_s") * w).cast("double") / cnt)
            elif m.fn in ("min", "max"):
                e = (F.min if m.fn == "min" else F.max)(F.col(f"{base}_{m.fn}"))
            else:  # sample standard deviation: pass 1 keeps the group mean
                tot = F.sum(F.col(f"{base}_s").cast("double") * w)
                agg_exprs.append(F.when(cnt > 0, tot / cnt).alias(f"_mean_{m.name}"))
                agg_exprs.append(cnt.alias(f"_cnt_{m.name}"))
                continue
        if scaled and m.scale is not None:
            e = F.round(e, m.scale)
        agg_exprs.append(e.alias(m.name))
    result = paired.groupBy(*out_keys).agg(*agg_exprs)

    # pass 2 for standard deviations: the pairs' sum of squared deviations is
    # sum over block pairs of w * (m2_b + c_b * (mean_b - group mean)^2),
    # free of the cancellation in sum(x^2) - sum(x)^2 / n
    sds = [m for m in measures if m.fn == "stddev"]
    if sds:
        means = result.select(*[F.col(k).alias(f"_g_{k}") for k in out_keys],
                              *[f"_mean_{m.name}" for m in sds])
        cond = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_g_{k}")) for k in out_keys])
        dev = paired.join(means, cond)
        m2_exprs = []
        for m in sds:
            base, w = _cname(m.side, m.column), weight(m.side)
            c_b, s_b = F.col(f"{base}_c"), F.col(f"{base}_s").cast("double")
            gap = s_b / c_b - F.col(f"_mean_{m.name}")
            contrib = w * (F.col(f"{base}_m2") + c_b * gap * gap)
            m2_exprs.append(F.sum(F.when(c_b > 0, contrib)).alias(f"_m2_{m.name}"))
        spread = dev.groupBy(*[F.col(k).alias(f"_g_{k}") for k in out_keys]).agg(*m2_exprs)
        cond = reduce(lambda a, b: a & b, [result[k].eqNullSafe(spread[f"_g_{k}"]) for k in out_keys])
        cols = [result[k] for k in out_keys]
        for m in measures:
            if m.fn == "cd":
                continue
            if m.fn == "stddev":
                n_g = result[f"_cnt_{m.name}"]
                e = F.when(n_g > 1, F.sqrt(F.greatest(spread[f"_m2_{m.name}"] / (n_g - 1), F.lit(0.0))))
                cols.append((F.round(e, m.scale) if m.scale is not None else e).alias(m.name))
            else:
                cols.append(result[m.name])
        result = result.join(spread, cond, "left").select(*cols)

    # 3. exact distinct counts over pairs (tags are the measure's position)
    if distinct:
        tags = {m.name: i for i, m in enumerate(distinct)}
        parts = [
            _distinct_counts(prep, s, ra if s == la else la,
                             [(tags[m.name], m) for m in distinct if m.side == s],
                             jnames, own_keys, [key_col(k) for k in out_keys], out_keys,
                             split_shared.get(s, True))
            for s in sides
            if any(m.side == s for m in distinct)
        ]
        per_tag = reduce(lambda a, b: a.unionByName(b), parts)
        counts = per_tag.groupBy(*out_keys).agg(
            *[F.sum(F.when(F.col("_tag") == tags[m.name], F.col("_cnt"))).alias(m.name) for m in distinct]
        )
        cond = reduce(
            lambda a, b: a & b, [result[k].eqNullSafe(counts[k]) for k in out_keys]
        )
        result = result.join(counts, cond, "left").select(
            *[result[k] for k in out_keys],
            *[result[m.name] for m in measures if m.fn != "cd"],
            *[F.coalesce(counts[m.name], F.lit(0)).cast("bigint").alias(m.name) for m in distinct],
        )

    result = result.select(*out_keys, *[m.name for m in measures])
    return result.orderBy(*order) if order else result


def _distinct_counts(
    prep: dict[str, DataFrame],
    s: str,
    other: str,
    mine: Sequence[tuple[int, Measure]],
    jnames: list[str],
    own_keys: dict[str, list[str]],
    out_cols: list[Column],
    names: list[str],
    split: bool = True,
) -> DataFrame:
    """Per (group keys, tag): number of distinct values of side ``s`` whose
    row has a partner, without pairing values with the other side's rows.

    A value seen under a single join key ("unambiguous", the usual case for
    ids) is counted through its key's block: the block's count is added to
    every other-side key combination of that join key. Only values seen under
    several join keys are paired with the other side's distinct key
    combinations and deduplicated. Output: (out keys..., _tag, _cnt)."""
    sk = own_keys[s]
    tagged = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(tag).cast("tinyint").alias("_tag"),
                    F.col(_cname("v", s, m.column)).cast("string").alias("_val"),
                )
                for tag, m in mine
            ]
        )
    )
    partners = prep[other].select(*jnames, *own_keys[other]).distinct()
    if not split:
        # the rows are few to a partner, so they are paired before they are copied
        # for each tag
        return (
            prep[s].join(partners, on=jnames, how="inner")
            .select(*out_cols, tagged.alias("_tv"))
            .select(*names, "_tv._tag", "_tv._val")
            .filter(F.col("_val").isNotNull())
            .distinct()
            .groupBy(*names, "_tag")
            .agg(F.count(F.lit(1)).alias("_cnt"))
        )
    values = (
        prep[s]
        .select(*jnames, *sk, tagged.alias("_tv"))
        .select(*jnames, *sk, "_tv._tag", "_tv._val")
        .filter(F.col("_val").isNotNull())
        .distinct()
    )
    vkeys = [*sk, "_tag", "_val"]
    # the least and the largest join key of a value tell single from shared; a
    # value on many rows is collapsed before it is shuffled
    ends = F.struct(*jnames)
    lone = (
        values.groupBy(*vkeys)
        .agg(F.min(ends).alias("_lo"), F.max(ends).alias("_hi"))
        .filter(F.col("_lo") == F.col("_hi"))
        .select(F.col("_lo.*"), *vkeys)
    )
    # the other rows: those without a lone twin. Grouped by the whole row, so the
    # rows of one value are spread however many there are
    rest = (
        values.withColumn("_lone", F.lit(0)).unionByName(lone.withColumn("_lone", F.lit(1)))
        .groupBy(*jnames, *vkeys)
        .agg(F.max("_lone").alias("_lone"))
        .filter(F.col("_lone") == 0)
        .select(*jnames, *vkeys)
    )

    single = (
        lone.groupBy(*jnames, *sk, "_tag")
        .agg(F.count(F.lit(1)).alias("_u"))
        .join(partners, on=jnames, how="inner")
        .select(*out_cols, "_tag", "_u")
        .groupBy(*names, "_tag")
        .agg(F.sum("_u").alias("_cnt"))
    )
    shared = (
        rest.join(partners, on=jnames, how="inner")
        .select(*out_cols, "_tag", "_val")
        .distinct()
        .groupBy(*names, "_tag")
        .agg(F.count(F.lit(1)).alias("_cnt"))
    )
    return single.unionByName(shared)
