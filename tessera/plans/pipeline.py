"""Medallion jobs: bronze -> silver -> gold in dependency order.

``silver_frames`` builds the lazy plans used by single queries. ``run_batch``
materialises each layer as parquet under an output root (on a cluster: a
shared folder) and reads it back with the declared schema before building the
next layer. Writing a layer cuts the lineage, so a lost executor re-runs at
most the current layer's tasks, and every gold table scans the compact silver
files instead of re-running the adapter joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.operators import quality, shared_groups
from tessera.plans import colocated, gold, silver
from tessera.plans.bronze import bronze
from tessera.plans.silver import AsOf
from tessera.session import fresh_path

BATCH_TABLES = ("holdings", "market", "transactions", "profiles")
EVENT_TABLES = ("kyc", "purchases")

DERIVE = {
    "holdings": lambda df, as_of: silver.derive_holdings(df, as_of),
    "market": lambda df, as_of: silver.derive_market(df),
    "transactions": lambda df, as_of: silver.derive_transactions(df),
    "profiles": lambda df, as_of: silver.derive_profiles(df, as_of),
    "kyc": lambda df, as_of: silver.derive_kyc(df),
    "purchases": lambda df, as_of: silver.derive_purchases(df),
}


def silver_frame(bronze_df: DataFrame, table: str, as_of: AsOf = None) -> DataFrame:
    return quality.enforce(DERIVE[table](bronze_df, as_of), quality.RULES[table])


def silver_frames(
    spark: SparkSession, sf_dir: str, tables: tuple[str, ...], as_of: AsOf = None
) -> dict[str, DataFrame]:
    return {t: silver_frame(bronze(spark, sf_dir, t), t, as_of) for t in tables}


def gold_table(
    spark: SparkSession, sf_dir: str, name: str, as_of: AsOf = None, ordered: bool = True
) -> DataFrame:
    spec = gold.SPECS[name]
    frames = silver_frames(spark, sf_dir, spec.inputs, as_of)
    if spec.on:  # a join table reads its sides many times
        frames = written(spark, colocated.pruned(frames, name), fresh_path(spark, f"sides-{name}"))
    return gold.build(name, frames, ordered)


def written(spark: SparkSession, frames: dict[str, DataFrame], root: str) -> dict[str, DataFrame]:
    """The frames out of parquet tables under ``root``."""
    out = {}
    for t, df in frames.items():
        df.write.mode("overwrite").parquet(f"{root}/{t}")
        out[t] = spark.read.schema(df.schema).parquet(f"{root}/{t}")
    return out


def colocated_gold_table(
    spark: SparkSession, sf_dir: str, name: str, root: str, as_of: AsOf = None
) -> DataFrame:
    """A join table from sides that were written for the join under ``root``."""
    frames = silver_frames(spark, sf_dir, gold.SPECS[name].inputs, as_of)
    frames = written(spark, colocated.pruned(frames, name), f"{root}/silver")
    stored = colocated.write(spark, frames, root, [name])
    return gold.build(name, colocated.inputs(spark, name, stored, frames))


def shared_gold_table(spark: SparkSession, sf_dir: str, name: str, as_of: AsOf = None) -> DataFrame:
    """A gold table out of the one pass that makes all tables of its input that
    are not keyed by date."""
    feed = gold.SPECS[name].inputs[0]
    specs = gold.undated(feed)
    rows = silver_frames(spark, sf_dir, (feed,), as_of)[feed]
    return shared_groups.table_of(shared_groups.tables(rows, specs), specs, name, dict(rows.dtypes))


def quality_report(spark: SparkSession, sf_dir: str, as_of: AsOf = None) -> DataFrame:
    """Per-rule counts for all six tables, evaluated on the derived frames."""
    out = None
    for t in (*BATCH_TABLES, *EVENT_TABLES):
        derived = DERIVE[t](bronze(spark, sf_dir, t), as_of)
        m = quality.rule_metrics(derived, quality.RULES[t], t)
        out = m if out is None else out.unionByName(m)
    return out


def run_concurrently(spark: SparkSession, tasks: dict[str, object], max_workers: int) -> dict[str, object]:
    """Run independent table builds as concurrent Spark jobs. Each worker
    thread submits into its own FAIR scheduler pool, so small jobs fill the
    cores a single job leaves idle; results are returned by task name."""
    from concurrent.futures import ThreadPoolExecutor

    group = spark.sparkContext.getLocalProperty("spark.jobGroup.id")

    def run(item):
        name, fn = item
        if group:  # worker threads do not inherit the caller's job group
            spark.sparkContext.setJobGroup(group, group)
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"tessera-{name}")
        try:
            return name, fn()
        finally:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)

    if max_workers <= 1:
        return dict(run(i) for i in tasks.items())
    with ThreadPoolExecutor(max_workers=max_workers) as pool:
        return dict(pool.map(run, tasks.items()))


def run_batch(
    spark: SparkSession,
    sf_dir: str,
    out_root: str,
    as_of: AsOf = None,
    tables: tuple[str, ...] = BATCH_TABLES + EVENT_TABLES,
    gold_names: tuple[str, ...] | None = None,
    max_workers: int = 4,
) -> dict[str, str]:
    """Write bronze, silver, quality metrics and gold tables; return paths.

    Layers are written in dependency order; the tables inside a layer are
    independent and are built concurrently (``max_workers`` jobs at a time).
    """
    from tessera.sources import schemas

    def table_chain(t: str):
        def build() -> dict[str, str]:
            bpath, spath, mpath = (f"{out_root}/{layer}/{t}" for layer in ("bronze", "silver", "quality"))
            bronze(spark, sf_dir, t).write.mode("overwrite").parquet(bpath)
            b = spark.read.schema(schemas.BRONZE[t]).parquet(bpath)
            clean, obs = quality.observe_rules(DERIVE[t](b, as_of), quality.RULES[t], t)
            quality.enforce(clean, quality.RULES[t]).write.mode("overwrite").parquet(spath)
            metrics = obs.get  # a handful of counters for this table
            rows = [(t, r.name, r.action, int(metrics["total_count"]), int(metrics[r.name]))
                    for r in quality.RULES[t]]
            spark.createDataFrame(
                rows, "table_name string, rule string, action string, total_count bigint, failed_count bigint"
            ).write.mode("overwrite").parquet(mpath)
            return {f"bronze_{t}": bpath, f"silver_{t}": spath, f"quality_{t}": mpath}
        return build

    paths: dict[str, str] = {}
    for built in run_concurrently(spark, {t: table_chain(t) for t in tables}, max_workers).values():
        paths.update(built)
    silver_read = {t: spark.read.parquet(paths[f"silver_{t}"]) for t in tables}

    # the sides of the many-to-many joins, co-located once for all of them
    stored = colocated.write(spark, silver_read, out_root, gold_names)

    def gold_job(name: str):
        def build() -> str:
            gpath = f"{out_root}/gold/{name}"
            frames = colocated.inputs(spark, name, stored, silver_read)
            gold.build(name, frames).write.mode("overwrite").parquet(gpath)
            return gpath
        return build

    names = [n for n in gold.build_order(gold_names)
             if all(i in silver_read for i in gold.SPECS[n].inputs)]
    # the KYC tables come from one pass over their silver table
    shared = [n for n in names if gold.SPECS[n].inputs == ("kyc",)]
    jobs = {n: gold_job(n) for n in names if n not in shared}
    if shared:
        every, types = f"{out_root}/gold/_kyc_groups", dict(silver_read["kyc"].dtypes)
        specs = [gold.SPECS[n] for n in shared]
        shared_groups.tables(silver_read["kyc"], specs).write.mode("overwrite").parquet(every)

        def split_job(name: str):
            def build() -> str:
                gpath = f"{out_root}/gold/{name}"
                rows = shared_groups.table_of(spark.read.parquet(every), specs, name, types)
                rows.write.mode("overwrite").parquet(gpath)
                return gpath
            return build

        jobs.update({n: split_job(n) for n in shared})
    for name, gpath in run_concurrently(spark, jobs, max_workers).items():
        paths[f"gold_{name}"] = gpath
    return paths


def register_layer_views(spark: SparkSession, paths: dict[str, str]) -> list[str]:
    """Expose the tables written by ``run_batch`` as temp views named by
    their keys (``silver_holdings``, ``gold_risk_analytics``, ...), for
    ``spark.sql`` users."""
    for name, path in paths.items():
        spark.read.parquet(path).createOrReplaceTempView(name)
    return sorted(paths)
