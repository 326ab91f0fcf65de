"""Shared grouping sets, mergeable state, checked micro-batches, event time."""

from __future__ import annotations

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tessera.operators import quality, shared_groups
from tessera.plans import gold, pipeline, silver
from tessera.plans.bronze import bronze
from tessera.sources import schemas
from tessera.streaming import checked, event_time, merged

KYC = gold.undated("kyc")
BOTH = [("kyc", s.name) for s in KYC] + [("purchases", s.name) for s in gold.undated("purchases")]


def rows(df):
    return sorted(map(tuple, df.select(sorted(df.columns)).collect()), key=str)


@pytest.fixture(scope="module")
def feeds(spark):
    """Silver rows of both feeds, with null keys, null values and repeated rows."""
    out = {}
    for feed in ("kyc", "purchases"):
        df = pipeline.silver_frame(bronze(spark, "/root/testdata/sf0.001", feed), feed)
        odd = df.limit(40).withColumn("customer_id", F.lit(None).cast("string"))
        key = {"kyc": "country", "purchases": "product_category"}[feed]
        more = df.limit(30).withColumn(key, F.lit(None).cast("string"))
        out[feed] = df.unionByName(odd).unionByName(more).unionByName(df.limit(20)).cache()
    return out


def test_one_scan_and_two_exchanges_for_all_tables(spark, feeds, tmp_path):
    feeds["kyc"].write.parquet(str(tmp_path / "kyc"))
    plan = shared_groups.tables(spark.read.parquet(str(tmp_path / "kyc")), KYC)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"FileScan", plan)) == 1
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 2 and plan.count("Expand") == 1
    assert "Window" not in plan and "Join" not in plan


@pytest.mark.parametrize("feed,name", BOTH)
def test_shared_pass_equals_each_table(feeds, feed, name):
    specs = gold.undated(feed)
    got = shared_groups.table_of(shared_groups.tables(feeds[feed], specs), specs, name, dict(feeds[feed].dtypes))
    want = gold.build(name, {feed: feeds[feed]})
    assert got.columns == want.columns and [t for _, t in got.dtypes] == [t for _, t in want.dtypes]
    assert rows(got) == rows(want)


def test_states_merge_in_any_split(feeds):
    df, types = feeds["kyc"], dict(feeds["kyc"].dtypes)
    parts = [df.filter(F.abs(F.hash("customer_id", "annual_income")) % 5 == i) for i in range(5)]
    states = [shared_groups.state(p, KYC) for p in parts] + [shared_groups.state(df.limit(0), KYC)]
    left = shared_groups.merge(states[:2], KYC)
    every = shared_groups.merge([left, *states[2:]], KYC)
    for spec in KYC:
        got = shared_groups.table_of(shared_groups.publish(every, KYC), KYC, spec.name, types)
        assert rows(got) == rows(gold.build(spec.name, {"kyc": df}))


def test_a_standard_deviation_is_refused(feeds):
    with pytest.raises(ValueError):
        shared_groups.state(feeds["kyc"], [gold.SPECS["asset_allocation_analytics"]])


# --- state of a feed ---

def _append(df, path, i):
    df.coalesce(1).write.mode("append").parquet(path)


def test_second_run_reads_only_new_files(spark, feeds, tmp_path, monkeypatch):
    seen: list[list[str]] = []
    add_batch = merged.add_batch

    def watched(*args):
        add = add_batch(*args)

        def run(batch, batch_id):
            seen.append([r[0] for r in batch.select(F.input_file_name()).distinct().collect()])
            add(batch, batch_id)

        return run

    monkeypatch.setattr(merged, "add_batch", watched)
    silver_path, root, check = (str(tmp_path / n) for n in ("silver", "state", "check"))
    df = feeds["kyc"].withColumn("_p", F.abs(F.hash("customer_id", "annual_income")) % 6)
    parts = [df.filter(F.col("_p") == i).drop("_p") for i in range(6)]
    for i in range(3):
        _append(parts[i], silver_path, i)
    merged.run(spark, silver_path, root, "kyc", check, compact_every=2, max_files=1)
    first = {f for files in seen for f in files}
    assert len(seen) == 3 and len(first) == 3 and merged.batches(spark, f"{root}/base") == [1]
    for i in range(3, 6):
        _append(parts[i], silver_path, i)
    seen.clear()
    merged.run(spark, silver_path, root, "kyc", check, compact_every=2, max_files=1)
    second = {f for files in seen for f in files}
    assert len(second) == 3 and not first & second
    assert merged.batches(spark, f"{root}/base") == [1, 3, 5]
    want = {s.name: rows(gold.build(s.name, {"kyc": df.drop("_p")})) for s in KYC}

    def published():
        return {s.name: rows(merged.table(spark, silver_path, root, "kyc", s.name)) for s in KYC}

    assert published() == want
    # a replay of the last batch, with its compaction, adds nothing
    again = spark.read.parquet(*seen[-1])
    assert again.count() > 0
    add_batch(root, KYC, 2)(again, 5)
    assert published() == want
    # what a job left behind that died while writing is not read
    (tmp_path / "state" / "delta" / "batch=6").mkdir()
    (tmp_path / "state" / "delta" / "batch=6" / "part-0.parquet").write_bytes(b"half a file")
    assert published() == want
    gone = merged.vacuum(spark, root)
    assert gone and merged.batches(spark, f"{root}/base") == [3, 5] and merged.batches(spark, f"{root}/delta") == [4, 5]
    assert published() == want


def test_an_empty_silver_table_gives_empty_tables(spark, feeds, tmp_path):
    silver_path, root = str(tmp_path / "silver"), str(tmp_path / "state")
    feeds["purchases"].limit(0).write.parquet(silver_path)
    merged.run(spark, silver_path, root, "purchases", str(tmp_path / "check"))
    assert merged.table(spark, silver_path, root, "purchases", "purchase_analytics").collect() == []


# --- clean, rejected, counters ---

def test_checked_batches_survive_a_crash(spark, tmp_path, monkeypatch):
    source, root, check = (str(tmp_path / n) for n in ("bronze", "out", "check"))
    given = bronze(spark, "/root/testdata/sf0.001", "kyc")
    given.repartition(3).write.parquet(source)

    def derived():
        stream = spark.readStream.schema(spark.read.parquet(source).schema).option("maxFilesPerTrigger", 1)
        return silver.derive_kyc(stream.parquet(source))

    true_metrics = quality.rule_metrics
    calls = []

    def dies(df, rules, table):  # after clean and rejected rows of the second batch are written
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("killed")
        return true_metrics(df, rules, table)

    monkeypatch.setattr(quality, "rule_metrics", dies)
    with pytest.raises(Exception):
        checked.run(derived(), quality.KYC, "kyc", root, check)
    monkeypatch.setattr(quality, "rule_metrics", true_metrics)
    paths = checked.run(derived(), quality.KYC, "kyc", root, check)
    clean, rejected = (checked.read(spark, paths[n]) for n in ("silver", "rejected"))
    assert clean.count() + rejected.count() == given.count()
    assert rows(clean) == rows(pipeline.silver_frame(given, "kyc"))
    assert dict(rejected.dtypes)["failed_rules"] == "array<string>"
    assert rows(rejected) == rows(quality.quarantine(silver.derive_kyc(given), quality.KYC))
    assert rows(checked.counts(spark, paths["counters"])) == rows(
        true_metrics(silver.derive_kyc(given), quality.KYC, "kyc"))
    ids = {r[0] for r in spark.read.parquet(paths["counters"]).select("batch_id").distinct().collect()}
    assert ids == {0, 1, 2}
    # nothing new: nothing added
    checked.run(derived(), quality.KYC, "kyc", root, check)
    assert checked.read(spark, paths["silver"]).count() == clean.count()


# --- event time ---

def _hours(df):
    return df.groupBy(F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("window_start")).agg(
        F.count(F.lit(1)).alias("kyc_records_processed"), F.countDistinct("who").alias("unique_customers"),
        F.round(F.sum(F.col("x").cast("decimal(38,8)")) / F.count("x"), 2).cast("double").alias("avg_x"))


def test_event_time_loses_no_row(spark, tmp_path, monkeypatch):
    start = dt.datetime(2024, 5, 1)
    data = [(start + dt.timedelta(minutes=7 * i), f"c{i % 23}", float(i % 11)) for i in range(900)]
    data += [(None, "c1", 1.0), (start, None, None), (start, "c1", 2.5), (start, "c1", 2.5)]
    df = spark.createDataFrame(data, "ts timestamp_ntz, who string, x double")
    source, root = str(tmp_path / "silver"), str(tmp_path / "run")
    cuts = [data[i : i + 130] for i in range(0, len(data), 130)]

    def put(some):
        spark.createDataFrame(some, df.schema).coalesce(1).write.mode("append").parquet(source)

    def run():
        return event_time.run(spark, source, root, "ts", "who", [("avg_x", "x", 2)], max_files=1)

    for some in cuts[:1:-1]:  # the newest first
        put(some)
    got = run()
    late = spark.read.parquet(f"{root}/late")
    assert late.count() > 300  # most rows come behind the watermark
    assert rows(got) == rows(_hours(spark.read.parquet(source)))
    # the job dies while it splits a batch, and is started again with more files
    for some in cuts[1::-1]:
        put(some)
    old = event_time.F.max
    monkeypatch.setattr(event_time.F, "max", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(Exception):
        run()
    monkeypatch.setattr(event_time.F, "max", old)
    assert rows(run()) == rows(_hours(df))
    assert rows(run()) == rows(_hours(df))  # nothing new


def test_new_hours_extend_the_windows(spark, tmp_path):
    """Files in order: hours grow over several runs, whose state goes on."""
    schema = "ts timestamp_ntz, who string, x double"
    start = dt.datetime(2024, 5, 1)
    data = [(start + dt.timedelta(minutes=11 * i), f"c{i % 5}", float(i)) for i in range(200)]
    source, root = str(tmp_path / "silver"), str(tmp_path / "run")
    for i in range(0, 200, 50):
        spark.createDataFrame(data[i : i + 50], schema).coalesce(1).write.mode("append").parquet(source)
        got = event_time.run(spark, source, root, "ts", "who", [("avg_x", "x", 2)])
    assert spark.read.parquet(f"{root}/late").count() == 0
    assert rows(got) == rows(_hours(spark.createDataFrame(data, schema)))


def test_new_queries_have_sql():
    names = [n for n in entry.queries() if n.startswith(("stream_gold_merged_", "shared_gold_"))]
    assert len(names) == 14 and set(names) <= set(entry.oracle_sql())
    assert schemas.KYC is not None


def test_folders_get_few_files_from_many_tasks(spark, tmp_path):
    given = bronze(spark, "/root/testdata/sf0.001", "kyc").repartition(6)
    write = checked.write_batch(str(tmp_path), quality.KYC, "kyc", "q", ["processing_date"])
    write(silver.derive_kyc(given), 0)
    files = spark.read.parquet(str(tmp_path / "silver")).select("processing_date", F.input_file_name().alias("f")).distinct()
    assert files.count() == files.select("processing_date").distinct().count()
