"""Aggregate specifications shared by single-table and joined gold tables.

A ``Measure`` names one output column: ``count`` (rows), ``cd`` (exact
distinct count), ``sum``, ``avg``, ``min``, ``max`` or ``stddev`` (sample),
optionally wrapped in ``round(., scale)``. ``col`` may carry a side prefix
(``"h.market_value"``) when the input is a join.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Measure:
    name: str
    fn: str
    col: str | None = None
    scale: int | None = None

    @property
    def side(self) -> str | None:
        return self.col.split(".", 1)[0] if self.col and "." in self.col else None

    @property
    def column(self) -> str | None:
        return self.col.split(".", 1)[1] if self.col and "." in self.col else self.col


def n(name: str) -> Measure:
    return Measure(name, "count")


def cd(name: str, col: str) -> Measure:
    return Measure(name, "cd", col)


def sum_(name: str, col: str, scale: int | None = None) -> Measure:
    return Measure(name, "sum", col, scale)


def avg(name: str, col: str, scale: int | None = None) -> Measure:
    return Measure(name, "avg", col, scale)


def max_(name: str, col: str, scale: int | None = None) -> Measure:
    return Measure(name, "max", col, scale)


def min_(name: str, col: str, scale: int | None = None) -> Measure:
    return Measure(name, "min", col, scale)


def sd(name: str, col: str, scale: int | None = None) -> Measure:
    return Measure(name, "stddev", col, scale)


_FUNCS = {
    "sum": F.sum,
    "avg": F.avg,
    "min": F.min,
    "max": F.max,
    "stddev": F.stddev_samp,
}


# Sums and averages of DOUBLE columns accumulate in exact decimals: a double
# sum depends on the order rows arrive in (partitioning, AQE coalescing,
# retries), which flips results that sit on a rounding tie such as
# avg(1.00, 2.01) = 1.505. Decimal sums are order-independent.
DEC_IN = "decimal(38,8)"
DEC_SUM = "decimal(34,8)"  # totals up to 1e26 (pair-weighted sums of a hot key)
DEC_COUNT = "decimal(20,0)"  # any bigint; the quotient keeps 12 digits all the same


def exact_sum(col: Column, scale: int | None) -> Column:
    e = F.sum(col.cast(DEC_IN))
    return (F.round(e, scale) if scale is not None else e).cast("double")


def exact_ratio(total: Column, count: Column, scale: int | None) -> Column:
    """``total / count`` for a decimal total, rounded HALF_UP in decimal.
    With these operand types the quotient keeps 12 fractional digits."""
    q = total.cast(DEC_SUM) / count.cast(DEC_COUNT)
    q = F.round(q, scale) if scale is not None else q
    return F.when(count > 0, q.cast("double"))


def measure_column(m: Measure, dtype: str | None = None, qualified: bool = False) -> Column:
    """Spark aggregate for ``m``; ``qualified`` resolves ``"h.market_value"``
    against aliased join inputs instead of the bare column name."""
    exact = dtype == "double" and m.fn in ("sum", "avg")
    name = m.col if qualified else m.column
    c = F.col(name) if name else None
    if m.fn == "count":
        e = F.count(F.lit(1))
    elif m.fn == "cd":
        e = F.countDistinct(c)
    elif exact and m.fn == "sum":
        return exact_sum(c, m.scale).alias(m.name)
    elif exact and m.fn == "avg":
        return exact_ratio(F.sum(c.cast(DEC_IN)), F.count(c), m.scale).alias(m.name)
    else:
        e = _FUNCS[m.fn](c)
    if m.scale is not None:
        e = F.round(e, m.scale)
    return e.alias(m.name)


def split_aggregate(
    df: DataFrame,
    keys: Sequence[Column],
    names: Sequence[str],
    measures: Sequence[Measure],
    columns: dict[str, Column],
) -> DataFrame:
    """Group ``df`` by ``keys`` (output ``names``) computing ``columns``
    (measure name -> aggregate column).

    When a table mixes exact distinct counts with other aggregates, they run
    as two aggregates joined on the (few) group keys: Catalyst's Expand for
    several distincts copies every aggregate input into each of its
    projections, so keeping the distinct side narrow (keys + the counted
    columns) cuts its shuffle bytes; measured at sf0.1, 35-40% fewer bytes and
    10-20% less time than one aggregate. Both sides aggregate partially before
    their exchanges, and the distinct dedup is partitioned by (keys, value)."""
    plain = [m for m in measures if m.fn != "cd"]
    distinct = [m for m in measures if m.fn == "cd"]
    if not plain or not distinct:
        return df.groupBy(*keys).agg(*[columns[m.name] for m in measures])
    left = df.groupBy(*keys).agg(*[columns[m.name] for m in plain])
    right = df.groupBy(*[k.alias(f"_k_{n}") for k, n in zip(keys, names)]).agg(
        *[columns[m.name] for m in distinct])
    cond = reduce(lambda a, b: a & b, [F.col(n).eqNullSafe(F.col(f"_k_{n}")) for n in names])
    return left.join(right, cond, "left").select(
        *names, *[F.coalesce(F.col(m.name), F.lit(0)).alias(m.name) if m.fn == "cd" else F.col(m.name)
                  for m in measures])


def grouped(
    df: DataFrame,
    keys: Sequence[str],
    measures: Sequence[Measure],
    order: Sequence[str] | None = None,
) -> DataFrame:
    """Single-input gold table: hash aggregates with partial (map-side)
    aggregation; see ``split_aggregate`` for the distinct counts."""
    types = dict(df.dtypes)
    cols = {m.name: measure_column(m, types.get(m.column or "")) for m in measures}
    out = split_aggregate(df, [F.col(k) for k in keys], list(keys), measures, cols)
    return out.orderBy(*order) if order else out


def measure_sql(m: Measure, rnd=lambda e, k: f"round({e}, {k})", integral: frozenset = frozenset()) -> str:
    """DuckDB text of the same measure over a flat relation (oracle).
    ``integral`` names the integer-typed columns; sums/averages of the others
    are exact decimal computations, as in ``measure_column``."""
    col = m.col
    if m.fn == "count":
        return f"CAST(count(*) AS BIGINT) AS {m.name}"
    if m.fn == "cd":
        return f"CAST(count(DISTINCT {col}) AS BIGINT) AS {m.name}"
    exact = m.column not in integral and m.fn in ("sum", "avg")
    if exact and m.fn == "sum":
        e = f"sum(CAST({col} AS DECIMAL(38,8)))"
        e = f"round({e}, {m.scale})" if m.scale is not None else e
        return f"CAST({e} AS DOUBLE) AS {m.name}"
    if exact and m.fn == "avg":
        k = m.scale if m.scale is not None else 8
        s_int = f"CAST(sum(CAST({col} AS DECIMAL(38,8))) * 100000000 AS HUGEINT)"
        n = f"count({col})"
        q = (f"sign({s_int}) * ((abs({s_int}) * {2 * 10 ** k} + {n} * 100000000) "
             f"// ({n} * 200000000))")
        return (f"CASE WHEN {n} > 0 THEN CAST({q} AS DOUBLE) / {10 ** k} END AS {m.name}")
    fn = {"sum": "sum", "avg": "avg", "min": "min", "max": "max", "stddev": "stddev_samp"}[m.fn]
    e = f"{fn}({col})"
    if m.scale is not None:
        e = rnd(e, m.scale)
    return f"{e} AS {m.name}"
