"""Write the physical plans of the headline queries to docs/plans/*.txt.

    python scripts/show_plans.py [--sf /root/testdata/sf0.01]

Each query is executed once first so the file shows AQE's final plan (join
strategies chosen from runtime sizes, coalesced partitions).
"""

from __future__ import annotations

import argparse
import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from tessera.operators import shared_groups  # noqa: E402
from tessera.plans import colocated, gold, pipeline  # noqa: E402
from tessera.plans.bronze import bronze  # noqa: E402
from tessera.session import build_session, fresh_path  # noqa: E402
from tessera.sources import schemas  # noqa: E402


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    args = ap.parse_args()
    spark = build_session()
    out_dir = os.path.join(ROOT, "docs", "plans")
    os.makedirs(out_dir, exist_ok=True)
    root = fresh_path(spark, "plans")

    silver = {}
    for t in ("holdings", "market", "transactions", "profiles"):
        bronze(spark, args.sf, t).write.parquet(f"{root}/bronze/{t}")
        b = spark.read.schema(schemas.BRONZE[t]).parquet(f"{root}/bronze/{t}")
        pipeline.silver_frame(b, t, "2002-01-01").write.parquet(f"{root}/silver/{t}")
        silver[t] = spark.read.parquet(f"{root}/silver/{t}")

    from pyspark.sql import functions as F

    from tessera.operators.joins import blocked_join_aggregate
    from tessera.operators.share import with_share_window

    hb = spark.read.schema(schemas.BRONZE["holdings"]).parquet(f"{root}/bronze/holdings")
    tb = spark.read.schema(schemas.BRONZE["transactions"]).parquet(f"{root}/bronze/transactions")
    plans = {
        "bronze_holdings_from_tables": bronze(spark, args.sf, "holdings"),
        "silver_holdings_from_bronze": pipeline.silver_frame(hb, "holdings", "2002-01-01"),
        "silver_transactions_from_bronze": pipeline.silver_frame(tb, "transactions"),
        "gold_asset_allocation_analytics": gold.build("asset_allocation_analytics", silver),
        "gold_client_portfolio_performance": gold.build("client_portfolio_performance", silver),
        "gold_sector_region_performance": gold.build("sector_region_performance", silver),
        "gold_processing_metrics": gold.build("processing_metrics", silver),
        "share_window_form_for_comparison": with_share_window(hb, "market_value", "s"),
    }
    spec = gold.SPECS["client_portfolio_performance"]

    def hot(df, key):
        return df.withColumn("client_name_clean", F.when(
            F.pmod(F.xxhash64(key), F.lit(3)) == 0, F.lit("HOT")).otherwise(F.col("client_name_clean")))

    plans["hot_key_client_portfolio_pair_free"] = blocked_join_aggregate(
        hot(silver["holdings"], "holding_id"), hot(silver["profiles"], "client_id"),
        spec.on, spec.keys, spec.measures, ("h", "p"), spec.order)
    # the joins from sides stored for them, without broadcasts that hide it at this size
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    stored = colocated.write(spark, silver, root)
    for spec in colocated.join_specs():
        for strategy in ("direct", "blocked"):
            plans[f"colocated_{spec.name}_{strategy}"] = gold.build(
                spec.name, colocated.inputs(spark, spec.name, stored, silver), join_strategy=strategy)
    plans["shared_kyc_tables"] = shared_groups.tables(
        pipeline.silver_frames(spark, args.sf, ("kyc",))["kyc"], gold.undated("kyc"))
    for name, df in plans.items():
        qe = df._jdf.queryExecution()
        qe.executedPlan().executeCollect()  # run this plan itself, so AQE finalises it
        text = qe.explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        with open(os.path.join(out_dir, f"{name}.txt"), "w") as fh:
            fh.write(text)
        print(name, len(text))


if __name__ == "__main__":
    main()
