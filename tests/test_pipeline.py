"""End-to-end: silver derivations, the SQL oracle, streaming replay and the
driver contract, on the smallest supplied tables."""

import datetime as dt
import re

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tessera.plans import gold, pipeline, silver
from tessera.plans.bronze import bronze
from tessera.session import fresh_path
from tessera.sources import schemas
from tessera.sources.tables import SUPPLIED_TABLES, table_path
from tessera.streaming import kyc_stream


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def duck(sf_small):
    con = duckdb.connect()
    for name in SUPPLIED_TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{table_path(sf_small, name)}')")
    return con


ORACLE_KEYS = [
    "faults_holdings",
    "silver_holdings",
    "silver_market",
    "silver_profiles",
    "silver_kyc",
    "position_share",
    "quality_report",
    "gold_asset_allocation_analytics",
    "gold_client_portfolio_performance",
    "gold_sector_region_performance",
    "gold_processing_metrics",
    "gold_realtime_kyc_metrics",
    "gold_purchase_analytics",
]


@pytest.mark.parametrize("key", ORACLE_KEYS)
def test_query_matches_sql(spark, sf_small, duck, key):
    df = entry.queries()[key](spark, sf_small)
    rel = duck.execute(entry.oracle_sql()[key])
    cols = [d[0] for d in rel.description]
    assert sorted(df.columns) == sorted(cols)
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    want = sorted((tuple(r[i] for i in order) for r in rel.fetchall()), key=str)
    got = _rows(df.select(*sorted(df.columns)))
    assert len(got) == len(want) and got == want


def test_contract_keys(spark):
    q, s = entry.queries(), entry.oracle_sql()
    assert set(s) <= set(q)
    own = {k for k in q if not re.fullmatch(r"op\d+_.*|pipeline", k)}
    assert own <= set(s)
    assert len(own) >= 52
    assert len([k for k in q if k.startswith("gold_")]) == 20


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[:5] == ["age_group", "income_tier", "net_worth_tier", "risk_tolerance", "experience_level"]


def test_name_cleaning_joins_and_null_dates(spark):
    h = spark.createDataFrame(
        [("h1", "  ann lee ", "x", 2.0, 10.0, None, "E", 1000, 500, "S", "R", 1, "USD", "B", 5.0,
          dt.datetime(2001, 1, 1))],
        schemas.HOLDINGS,
    )
    s = silver.holdings(h, as_of="2002-01-01").collect()[0]
    assert s.client_name_clean == "ANN LEE" and s.days_held == 0 and s.valuation_date_clean is None
    assert s.gain_loss_percentage == 100.0 and s.risk_level == "Low"


def test_stream_replay_adds_nothing_and_matches_batch(spark, sf_small):
    root = fresh_path(spark, "test-kyc")
    first = _rows(kyc_stream.run_silver(spark, sf_small, root))
    again = _rows(kyc_stream.run_silver(spark, sf_small, root))  # same checkpoints
    assert first == again
    batch = pipeline.silver_frame(bronze(spark, sf_small, "kyc"), "kyc")
    assert first == _rows(batch)


def test_run_batch_writes_layers_and_metrics(spark, sf_small):
    root = fresh_path(spark, "test-batch")
    paths = pipeline.run_batch(spark, sf_small, root, as_of="2002-01-01",
                               tables=("holdings", "profiles"),
                               gold_names=("client_portfolio_performance", "asset_allocation_analytics"))
    assert {"silver_holdings", "gold_client_portfolio_performance", "quality_profiles"} <= set(paths)
    written = spark.read.parquet(paths["gold_asset_allocation_analytics"])
    direct = pipeline.gold_table(spark, sf_small, "asset_allocation_analytics", "2002-01-01")
    assert _rows(written) == _rows(direct)
    views = pipeline.register_layer_views(spark, paths)
    assert "gold_asset_allocation_analytics" in views
    via_sql = spark.sql("SELECT sum(position_count) AS n FROM gold_asset_allocation_analytics").first().n
    assert via_sql == spark.sql("SELECT count(*) AS n FROM silver_holdings").first().n
    observed = spark.read.parquet(paths["quality_profiles"])
    report = pipeline.quality_report(spark, sf_small, "2002-01-01").filter(F.col("table_name") == "profiles")
    assert _rows(observed) == _rows(report)


def test_gold_specs_complete():
    assert len(gold.SPECS) == 20
    joins = [s.name for s in gold.SPECS.values() if len(s.inputs) == 2]
    assert sorted(joins) == sorted([
        "client_portfolio_performance", "client_transaction_analytics",
        "advisor_performance_analytics", "risk_analytics", "sector_region_performance"])


def test_stream_rule_counters_match_batch_metrics(spark, sf_small):
    root = fresh_path(spark, "test-kyc-q")
    counters = kyc_stream.run_pipeline(spark, sf_small, root)["quality"]
    report = {r.rule: (r.total_count, r.failed_count) for r in
              pipeline.quality_report(spark, sf_small).filter(F.col("table_name") == "kyc").collect()}
    assert counters["total_count"] == next(iter(report.values()))[0]
    assert {k: counters[k] for k in report} == {k: v[1] for k, v in report.items()}


def test_incremental_refresh_replaces_only_touched_dates(spark, sf_small):
    root = fresh_path(spark, "test-incr")
    silver_path, gold_path = f"{root}/silver", f"{root}/gold"
    kyc = pipeline.silver_frame(bronze(spark, sf_small, "kyc"), "kyc")
    dates = sorted(r[0] for r in kyc.select("processing_date").distinct().collect())
    d1, d2 = dates[0], dates[1]
    first = kyc.filter(F.col("processing_date").isin(d1, d2) & (F.col("processing_hour") < 12))
    later = kyc.filter((F.col("processing_date") == d1) & (F.col("processing_hour") >= 12))
    first.write.partitionBy("processing_date").parquet(silver_path)
    kyc_stream.refresh_dates(spark, silver_path, gold_path, "realtime_kyc_metrics", first)
    later.write.mode("append").partitionBy("processing_date").parquet(silver_path)
    kyc_stream.refresh_dates(spark, silver_path, gold_path, "realtime_kyc_metrics", later)
    got = spark.read.parquet(gold_path)
    want = gold.build("realtime_kyc_metrics", {"kyc": first.unionByName(later)}, ordered=False)
    assert _rows(got.select(*want.columns)) == _rows(want)


def test_group_counts_sum_to_inputs(spark, sf_small):
    from tessera.operators.joins import pair_stats

    silver_tables = pipeline.silver_frames(
        spark, sf_small, ("holdings", "market", "transactions", "profiles", "kyc", "purchases"), "2002-01-01")
    sizes = {t: df.count() for t, df in silver_tables.items()}

    def total(name, col):
        return gold.build(name, silver_tables).agg(F.sum(col)).first()[0]

    assert total("asset_allocation_analytics", "position_count") == sizes["holdings"]
    assert total("monthly_portfolio_trends", "position_count") == sizes["holdings"]
    assert total("market_performance_analytics", "trading_days_count") == sizes["market"]
    assert total("client_acquisition_retention", "total_clients") == sizes["profiles"]
    assert total("customer_demographics", "customer_count") == sizes["kyc"]
    assert total("realtime_metrics", "records_processed") == sizes["purchases"]
    assert total("processing_metrics", "records_processed") == sum(
        sizes[t] for t in ("holdings", "market", "transactions", "profiles"))
    on = [("client_name_clean", "client_name_clean")]
    pairs = pair_stats(silver_tables["holdings"], silver_tables["profiles"], on)[0]
    assert total("client_portfolio_performance", "total_positions") == pairs
    assert total("risk_analytics", "position_count") == pairs


def test_cli_batch_job(sf_small, tmp_path):
    import json
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = tmp_path / "out"
    proc = subprocess.run(
        [sys.executable, "-m", "tessera", "batch", "--local", "--tables", sf_small,
         "--out", str(out), "--as-of", "2002-01-01", "--workers", "4"],
        cwd=root, capture_output=True, text=True, timeout=900,
    )
    assert proc.returncode == 0, proc.stderr[-2000:]
    paths = json.loads(proc.stdout[proc.stdout.index("{"):])
    assert len([k for k in paths if k.startswith("gold_")]) == 20
    assert {"bronze", "silver", "quality", "gold"} <= set(os.listdir(out))


@pytest.mark.parametrize("strategy", ["direct", "blocked"])
def test_cleaned_names_join_and_single_pair_stddev_is_null(spark, strategy):
    ts = dt.datetime(2001, 1, 1)
    h = spark.createDataFrame(
        [("h1", "  ann lee ", "Acme #1", 2.0, 10.0, ts, "Equity", 1000, 500, "S", "R", 1, "USD", "B", 5.0, ts)],
        schemas.HOLDINGS,
    )
    p = spark.createDataFrame(
        [("c1", "ANN LEE", "ann@x", 30, "City 1", "N", 60000.0, 700000.0, "Moderate", ts, 3,
          "Unemployed", 1, "ADV", 200000.0, ts)],
        schemas.PROFILES,
    )
    hs, ps = silver.holdings(h, as_of="2002-01-01"), silver.profiles(p, as_of="2002-01-01")
    out = gold.build("client_portfolio_performance", {"holdings": hs, "profiles": ps},
                     join_strategy=strategy).collect()
    assert len(out) == 1
    row = out[0]
    assert row.total_positions == 1 and row.unique_clients == 1 and row.position_value_stddev is None
    assert (row.age_group, row.income_tier, row.net_worth_tier) == ("30-39", "Medium Income", "High Net Worth")


def test_price_consistency_is_counted_not_dropped(spark):
    from tessera.operators import quality

    ts = dt.datetime(2001, 1, 1)
    m = spark.createDataFrame(
        [("S1", "Acme #1", 10.0, 11.0, 9.0, 12.0, 100, ts, "NYSE", "T", "R", 5_000_000_000, 15.0, 2.0, "USD", ts),
         ("S2", "Acme #2", 10.0, 12.0, 9.0, 11.0, 100, ts, "NYSE", "T", "R", 5_000_000_000, 15.0, None, "USD", ts)],
        schemas.MARKET,
    )
    derived = silver.derive_market(m)
    kept = {r.symbol: r for r in quality.enforce(derived, quality.MARKET).collect()}
    assert set(kept) == {"S1", "S2"}  # high < close is a warning, not a drop
    assert kept["S2"].dividend_yield_tier == "Very High Yield"  # NULL falls to the default label
    assert (kept["S1"].market_cap_tier, kept["S1"].pe_ratio_tier) == ("Mid Cap", "Medium PE")
    metrics = {r.rule: r.failed_count for r in quality.rule_metrics(derived, quality.MARKET, "market").collect()}
    assert metrics["price_consistency"] == 1 and metrics["valid_prices"] == 0


def test_transaction_fee_bounds_and_missing_keys(spark):
    ts = dt.datetime(2001, 1, 1)

    def row(tid, name, sym, fees):
        return (tid, name, 1000, sym, "BUY", 1.0, 10.0, 10.0, ts, 500, "T", "R", fees, "USD", "ADV", ts)

    t = spark.createDataFrame(
        [row("t1", "A", "S", 0.0), row("t2", "A", "S", -0.01), row(None, "A", "S", 1.0),
         row("t4", None, "S", 1.0), row("t5", "A", None, 1.0)],
        schemas.TRANSACTIONS,
    )
    kept = [r.transaction_id for r in silver.transactions(t).collect()]
    assert kept == ["t1"]  # zero fees kept; negative fees and each missing key dropped


def test_tagged_union_fills_missing_columns(spark):
    ts = dt.datetime(2001, 1, 1, 5)
    base = "processing_date string, processing_hour int, processing_timestamp timestamp_ntz"
    frames = {
        "holdings": spark.createDataFrame([("2001-01-01", 5, ts, 1.0)], base + ", market_value double"),
        "market": spark.createDataFrame([("2001-01-01", 5, ts, "S")], base + ", symbol string"),
        "transactions": spark.createDataFrame([("2001-01-01", 5, ts)], base),
        "profiles": spark.createDataFrame([("2001-01-02", 0, ts, 30)], base + ", age int"),
    }
    u = gold.tagged_union(frames)
    assert {"market_value", "symbol", "age", "source_table"} <= set(u.columns)
    rows = {r.source_table: r for r in u.collect()}
    assert rows["market_data"].market_value is None and rows["portfolio_holdings"].symbol is None
    assert rows["client_profiles"].age == 30 and len(rows) == 4
    metrics = gold.build("processing_metrics", frames).collect()
    assert sum(r.records_processed for r in metrics) == 4


def _event_table(spark, sf_small, root, parts):
    spark.read.parquet(table_path(sf_small, "events")).repartition(parts).write.parquet(f"{root}/events.parquet")


def test_event_stream_reads_a_table_folder(spark, sf_small, tmp_path, monkeypatch):
    from tessera.streaming import common

    _event_table(spark, sf_small, tmp_path, 7)
    one = kyc_stream.run_silver(spark, sf_small)
    many = kyc_stream.run_silver(spark, str(tmp_path))
    assert many.count() == one.count() > 0
    # more micro-batches than a short ring of progress updates would keep
    ring = "spark.sql.streaming.numRecentProgressUpdates"
    spark.conf.set(ring, "2")
    every = common.file_stream
    monkeypatch.setattr(common, "file_stream", lambda s, p, sc, max_files=1, glob=None: every(s, p, sc, 1, glob))
    monkeypatch.setattr(kyc_stream, "file_stream", lambda s, p, sc, max_files=1, glob=None: every(s, p, sc, 1, glob))
    try:
        paths = kyc_stream.run_pipeline(spark, str(tmp_path), str(tmp_path / "run"))
    finally:
        spark.conf.unset(ring)
    assert paths["quality"]["total_count"] == spark.read.parquet(table_path(sf_small, "events")).count()
    assert kyc_stream.hourly(spark.read.parquet(paths["silver"])).exceptAll(kyc_stream.hourly(one)).count() == 0
    with pytest.raises(Exception):
        common.event_stream(spark, str(tmp_path / "nowhere"))


def test_files_added_later_are_read(spark, sf_small, tmp_path):
    from tessera.sources.tables import read_table

    _event_table(spark, sf_small, tmp_path, 2)
    n = read_table(spark, str(tmp_path), "events").count()
    spark.read.parquet(table_path(sf_small, "events")).limit(5).write.mode("append").parquet(f"{tmp_path}/events.parquet")
    assert read_table(spark, str(tmp_path), "events").count() == n + 5


def test_share_leaves_the_plan_when_unused(spark, sf_small):
    rows = pipeline.silver_frame(bronze(spark, sf_small, "holdings"), "holdings", entry.BATCH_AS_OF)
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert "scalar-subquery" in plan(rows.select("position_size_percentage"))
    assert "scalar-subquery" not in plan(rows.drop("position_size_percentage"))


def test_refresh_reads_only_touched_dates(spark, sf_small, tmp_path):
    from tessera.streaming.incremental import touched_rows

    paths = kyc_stream.run_pipeline(spark, sf_small, str(tmp_path / "run"), partition_silver=True)
    rows = spark.read.parquet(paths["silver"])
    day = rows.agg(F.min("processing_date")).first()[0]
    some = touched_rows(spark, paths["silver"], rows.filter(F.col("processing_date") == day))
    assert some.count() == rows.filter(F.col("processing_date") == day).count()
    read = {r[0] for r in some.select(F.input_file_name()).distinct().collect()}
    assert read and all(f"processing_date={day}" in f for f in read)
    scan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in scan and "PartitionFilters: []" not in scan
    assert touched_rows(spark, paths["silver"], rows.limit(0)) is None


def test_feeds_publish_all_their_gold_tables(spark, sf_small, tmp_path):
    from tessera.streaming import purchase_stream

    for feed, module in (("kyc", kyc_stream), ("purchases", purchase_stream)):
        paths = module.publish(spark, sf_small, str(tmp_path / feed))
        assert sorted(paths["gold"]) == sorted(n for n, s in gold.SPECS.items() if s.inputs == (feed,))
        assert all(spark.read.parquet(p).count() > 0 for p in [paths["silver"], *paths["gold"].values()])
