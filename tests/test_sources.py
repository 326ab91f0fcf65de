"""Explicit-schema reads, raw-text typing and the adapters' shape."""

import datetime as dt

import pytest

from tessera.plans import silver
from tessera.plans.bronze import bronze
from tessera.session import METHOD_LIMIT
from tessera.sources import adapters, files, schemas


def test_raw_text_typing_turns_malformed_into_null(spark, tmp_path):
    header = [f.name for f in schemas.HOLDINGS.fields]
    good = ["h1", "Ann", "Acme #1", "10", "1000.5", "2001-02-03 04:05:06", "Equity", "1001", "501",
            "S", "R", "2", "USD", "Growth", "900", "2001-02-03 00:00:00"]
    bad = ["h2", "Bob", "Acme #2", "ten", "1e3", "not a date", "Bond", "x", "502",
           "S", "R", "9", "EUR", "Value", "", "2001-02-04 00:00:00"]
    path = tmp_path / "holdings.csv"
    path.write_text("\n".join(",".join(r) for r in [header, good, bad]) + "\n")
    df = files.read_bronze(spark, str(path), "holdings", fmt="csv")
    assert df.schema == schemas.HOLDINGS
    rows = {r.holding_id: r for r in df.collect()}
    assert rows["h1"].quantity == 10.0 and rows["h1"].valuation_date == dt.datetime(2001, 2, 3, 4, 5, 6)
    assert rows["h2"].quantity is None and rows["h2"].market_value == 1000.0
    assert rows["h2"].valuation_date is None and rows["h2"].account_id is None
    assert rows["h2"].cost_basis is None
    # NULL quantity fails the silver rules: the row is dropped, not an error
    kept = silver.holdings(df, as_of="2002-01-01").collect()
    assert [r.holding_id for r in kept] == ["h1"]


def test_json_and_partitioned_write_roundtrip(spark, tmp_path):
    src = spark.createDataFrame(
        [("c1", "N", "n@x", 30, "City 1", "C1", 1000.0, "Moderate", dt.datetime(2024, 1, 1, 5), 3,
          "Employed", 5000.0, "Joint", 2, dt.datetime(2024, 1, 1, 5))],
        schemas.KYC,
    )
    out = str(tmp_path / "kyc_json")
    src.write.json(out)
    back = files.read_bronze(spark, out, "kyc", fmt="json")
    assert back.collect() == src.collect()
    silver_path = str(tmp_path / "kyc_silver")
    files.write_table(silver.kyc(back), silver_path, partition_by=["processing_date"])
    assert spark.read.parquet(silver_path).count() == 1


def test_adapters_produce_bronze_schema(spark, sf_small):
    for table in ("holdings", "market", "transactions", "profiles", "kyc", "purchases"):
        df = adapters.ADAPTERS[table](spark, sf_small).drop(adapters.ROW_KEY)
        got = [(f.name, f.dataType) for f in df.schema.fields]
        assert got == [(f.name, f.dataType) for f in schemas.BRONZE[table].fields], table


def test_scan_prunes_columns_and_pushes_filters(spark, sf_small):
    from tessera.plans import pipeline
    from tessera.plans.bronze import bronze

    s = pipeline.silver_frame(bronze(spark, sf_small, "kyc"), "kyc")
    plan = s._jdf.queryExecution().executedPlan().toString()
    assert "props" not in plan.split("ReadSchema")[1].split("\n")[0]


def test_cluster_settings_scale_with_input(spark, sf_small):
    from tessera.session import cluster_settings, input_bytes

    small = cluster_settings(input_bytes(spark, sf_small), 8)
    big = cluster_settings(100 * (1 << 40), 8000)
    assert int(small["spark.sql.shuffle.partitions"]) == 16
    assert int(big["spark.sql.shuffle.partitions"]) == 200_000
    assert int(big["spark.sql.files.maxPartitionBytes"]) > int(small["spark.sql.files.maxPartitionBytes"])
    assert int(big["spark.sql.autoBroadcastJoinThreshold"]) == 64 << 20


def test_market_lines_are_dealt_once_and_not_aggregated_before(spark, sf_small):
    plan = adapters.market(spark, sf_small)._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_COL" in plan
    below = plan.split("REPARTITION_BY_COL", 1)[1]
    assert "min_by" not in below and "Sort [" not in below


@pytest.mark.parametrize("table", ["holdings", "transactions"])
def test_customers_come_to_orders_before_lines(spark, sf_small, table):
    plan = adapters.ADAPTERS[table](spark, sf_small)._jdf.queryExecution().analyzed().toString().split("\n")
    depth = {k: next(len(line) - len(line.lstrip(" :+-")) for line in plan if "Relation" in line and k in line)
             for k in ("l_orderkey", "c_custkey")}
    assert depth["c_custkey"] > depth["l_orderkey"]


def test_long_generated_methods_are_left_to_the_compiler(spark, sf_small):
    spark.conf.set(METHOD_LIMIT, "65535")
    bronze(spark, sf_small, "market")
    assert spark.conf.get(METHOD_LIMIT) == "8000"
    spark.conf.set(METHOD_LIMIT, "4000")
    bronze(spark, sf_small, "market")
    assert spark.conf.get(METHOD_LIMIT) == "4000"
    spark.conf.unset(METHOD_LIMIT)
