"""Silver tables stored for their joins: bucketed and sorted by the join columns.

The five join tables read holdings, transactions and profiles by client name, or
holdings and market by asset name, sector and region. ``write`` stores each side
once per join as a bucketed table with the columns those tables read; joins and
the aggregates below them then need no Exchange, however often they run. Both
sides of a join have the same number of buckets, and each bucket is one file.

A bucket is read by one task, so large sides have as many buckets as keep it to
about ``ROWS`` rows, and its sorts and hash maps in memory. And a side whose hottest join value would make its
bucket ``SKEW`` times an even one is not stored this way: the join then reads the
plain silver tables, where rows are pre-aggregated before the shuffle and AQE
splits what is still too large. Both ways give the same rows.

Tables belong to the session's catalog; ``register`` brings those of an earlier
run back by their folders.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.plans import gold

SKEW = 4.0
ROWS = 1 << 18


@dataclass(frozen=True)
class Stored:
    """A stored side: silver table, join columns, catalog name, folder, buckets."""

    source: str
    on: tuple[str, ...]
    table: str
    path: str
    buckets: int


def join_specs(names: Sequence[str] | None = None) -> list[gold.GoldSpec]:
    return [s for s in gold.SPECS.values() if s.on and (names is None or s.name in names)]


def _sides(specs: Sequence[gold.GoldSpec]) -> dict[tuple[str, tuple[str, ...]], list[str]]:
    """(silver table, join columns) -> columns that the tables read."""
    sides: dict[tuple[str, tuple[str, ...]], list[str]] = {}
    for spec in specs:
        for i, (source, alias) in enumerate(zip(spec.inputs, spec.sides)):
            on = tuple(pair[i] for pair in spec.on)
            keys = [k.split(".", 1)[1] for k in spec.keys if k.startswith(f"{alias}.")]
            read = [*sides.get((source, on), on), *keys, *(m.column for m in spec.measures if m.side == alias)]
            sides[source, on] = list(dict.fromkeys(read))
    return sides


def pruned(frames: dict[str, DataFrame], name: str) -> dict[str, DataFrame]:
    """The silver tables of join table ``name`` with the columns it reads."""
    return {source: frames[source].select(*columns)
            for (source, _), columns in _sides([gold.SPECS[name]]).items()}


def hottest(df: DataFrame, on: Sequence[str]) -> tuple[int, int]:
    """Rows of the join value with the most, and rows in all, without null values."""
    counts = df.dropna(subset=list(on)).groupBy(*on).agg(F.count(F.lit(1)).alias("n"))
    row = counts.agg(F.max("n"), F.sum("n")).first()
    return int(row[0] or 0), int(row[1] or 0)


def write(
    spark: SparkSession, silver: dict[str, DataFrame], root: str, names: Sequence[str] | None = None,
    buckets: int | None = None, skew: float = SKEW,
) -> list[Stored]:
    """Store the sides of the joins ``names`` whose silver tables are at hand."""
    specs = [s for s in join_specs(names) if all(t in silver for t in s.inputs)]
    sides = {side: silver[side[0]].select(*columns) for side, columns in _sides(specs).items()}
    heat = {side: hottest(rows, side[1]) for side, rows in sides.items()}
    if not buckets:  # the same for all, as both sides of a join need
        buckets = max([int(spark.conf.get("spark.sql.shuffle.partitions")),
                       *(-(-total // ROWS) for _, total in heat.values())])
    stored = []
    for (source, on), rows in sides.items():
        most, total = heat[source, on]
        if most * buckets > skew * total:
            continue
        name = f"{source}_by_{on[0]}"
        one = Stored(source, on, f"tessera_{uuid.uuid4().hex[:12]}_{name}", f"{root}/colocated/{name}", buckets)
        # dealt as the buckets are, so each is written as one file
        (rows.repartition(buckets, *on).write.mode("overwrite").format("parquet").bucketBy(buckets, *on)
         .sortBy(*on).option("path", one.path).saveAsTable(one.table))
        stored.append(one)
    return stored


def register(spark: SparkSession, stored: Sequence[Stored]) -> None:
    """Bring tables back into a catalog that does not know them."""
    for one in stored:
        if spark.catalog.tableExists(one.table):
            continue
        schema = spark.read.parquet(one.path).schema
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        on = ", ".join(f"`{c}`" for c in one.on)
        spark.sql(
            f"CREATE TABLE {one.table} ({columns}) USING parquet CLUSTERED BY ({on}) SORTED BY ({on}) "
            f"INTO {one.buckets} BUCKETS LOCATION '{one.path}'")


def inputs(
    spark: SparkSession, name: str, stored: Sequence[Stored], silver: dict[str, DataFrame]
) -> dict[str, DataFrame]:
    """What ``gold.build`` reads for ``name``: the stored sides if both are there,
    else the silver tables."""
    spec = gold.SPECS[name]
    sides = {}
    for i, source in enumerate(spec.inputs):
        on = tuple(pair[i] for pair in spec.on)
        for one in stored:
            if spec.on and (one.source, one.on) == (source, on):
                sides[source] = spark.table(one.table)
    return sides if len(sides) == len(spec.inputs) else silver


def drop(spark: SparkSession, stored: Sequence[Stored]) -> None:
    """Forget the tables; their files stay."""
    for one in stored:
        spark.sql(f"DROP TABLE IF EXISTS {one.table}")
