"""Silver sides stored for their joins."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from tessera.plans import colocated, gold, pipeline
from tessera.session import fresh_path

JOINS = [s.name for s in colocated.join_specs()]


@pytest.fixture(scope="module")
def layer(spark):
    root = fresh_path(spark, "test-colocated")
    frames = pipeline.silver_frames(
        spark, "/root/testdata/sf0.001", ("holdings", "market", "transactions", "profiles"), "2002-01-01")
    for t, df in frames.items():
        df.write.parquet(f"{root}/silver/{t}")
        frames[t] = spark.read.parquet(f"{root}/silver/{t}")
    stored = colocated.write(spark, frames, root, buckets=4)
    yield frames, stored
    colocated.drop(spark, stored)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def below_join(plan: str) -> list[str]:
    """Exchanges under the first join of a plan text."""
    lines = plan.split("\n")
    at = next(i for i, line in enumerate(lines) if "Join" in line)
    depth = len(re.match(r"[^A-Za-z]*", lines[at])[0])
    inside = []
    for line in lines[at + 1 :]:
        if len(re.match(r"[^A-Za-z]*", line)[0]) <= depth:
            break
        inside.append(line)
    assert any("SelectedBucketsCount" in line or "Bucketed: true" in line for line in inside), plan
    return [line for line in inside if "Exchange" in line]


@pytest.mark.parametrize("name", JOINS)
def test_direct_joins_need_no_exchange(spark, layer, name):
    frames, stored = layer
    assert len(stored) == 5
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = gold.build(name, colocated.inputs(spark, name, stored, frames), join_strategy="direct")
        assert below_join(got._jdf.queryExecution().executedPlan().toString()) == []
        blocked = gold.build(name, colocated.inputs(spark, name, stored, frames), join_strategy="blocked")
        want = rows(gold.build(name, frames, join_strategy="direct"))
        assert rows(got) == want and rows(blocked) == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_each_bucket_is_one_file(spark, layer):
    for one in layer[1]:
        files = spark.read.parquet(one.path).select(F.input_file_name()).distinct().count()
        assert files <= one.buckets


def test_tables_come_back_by_their_folders(spark, layer):
    frames, stored = layer
    before = {one.table: spark.table(one.table).count() for one in stored}
    colocated.drop(spark, stored)
    colocated.register(spark, stored)
    assert {one.table: spark.table(one.table).count() for one in stored} == before
    name = "client_portfolio_performance"
    got = gold.build(name, colocated.inputs(spark, name, stored, frames))
    assert rows(got) == rows(gold.build(name, frames))


def test_a_hot_name_stays_out_of_the_buckets(spark, layer):
    frames, _ = layer
    hot = frames["holdings"].withColumn("client_name_clean", F.when(
        F.pmod(F.xxhash64("holding_id"), F.lit(3)) == 0, "HOT").otherwise(F.col("client_name_clean")))
    given = {**frames, "holdings": hot}
    stored = colocated.write(spark, given, fresh_path(spark, "test-hot"), ["client_portfolio_performance"], buckets=64)
    try:
        assert [one.source for one in stored] == ["profiles"]
        assert colocated.inputs(spark, "client_portfolio_performance", stored, given) is given
    finally:
        colocated.drop(spark, stored)


def test_an_empty_side_is_stored(spark, layer):
    frames, _ = layer
    given = {t: df.limit(0) for t, df in frames.items()}
    stored = colocated.write(spark, given, fresh_path(spark, "test-empty"), ["risk_analytics"], buckets=2)
    try:
        assert gold.build("risk_analytics", colocated.inputs(spark, "risk_analytics", stored, given)).count() == 0
    finally:
        colocated.drop(spark, stored)


@pytest.mark.parametrize("name", JOINS)
def test_join_tables_read_the_supplied_tables_once(spark, sf_small, name):
    # the aggregates read the written sides, however many passes they take
    got = pipeline.gold_table(spark, sf_small, name, "2002-01-01")
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "c_custkey" not in plan and "l_partkey" not in plan


def test_sides_are_written_with_the_columns_of_the_join(spark, sf_small):
    root = fresh_path(spark, "test-pruned")
    pipeline.colocated_gold_table(spark, sf_small, "sector_region_performance", root, "2002-01-01")
    for t in ("holdings", "market"):
        kept = spark.read.parquet(f"{root}/silver/{t}").columns
        assert "processing_timestamp" not in kept and {"asset_name_clean", "sector", "region"} <= set(kept)


def test_buckets_grow_with_the_rows(spark, monkeypatch):
    names = F.concat(F.lit("n"), (F.col("id") % 500).cast("string")).alias("client_name_clean")
    cols = colocated._sides(colocated.join_specs(["risk_analytics"]))
    given = {source: spark.range(3000).select(names, *[F.lit("x").alias(c) for c in read if c != "client_name_clean"])
             for (source, _), read in cols.items()}
    monkeypatch.setattr(colocated, "ROWS", 200)
    stored = colocated.write(spark, given, fresh_path(spark, "test-buckets"), ["risk_analytics"])
    try:
        assert [one.buckets for one in stored] == [15, 15]
        assert [spark.table(one.table).count() for one in stored] == [3000, 3000]
    finally:
        colocated.drop(spark, stored)
