"""Faults, quality rules, the whole-table share and join aggregation."""

import duckdb
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from tessera.operators import quality
from tessera.operators.aggregate import avg, cd, max_, min_, n, sd, sum_
from tessera.operators.faults import Fault, fault_sql, inject_faults
from tessera.operators.joins import blocked_join_aggregate, direct_join_aggregate, join_aggregate, join_stats, pair_stats
from tessera.operators.share import with_share, with_share_window


# --- RA1 faults ---------------------------------------------------------------

FAULTS = [
    Fault("a", 0.10, 1),
    Fault("x", 0.20, 2, -50.0, 100.0),
    Fault("k", 0.05, 3, 4, 3, integer=True),
]


def _frame(spark, rows=20000):
    return spark.range(rows).select(
        F.col("id").alias("_row_key"),
        F.concat(F.lit("r"), F.col("id").cast("string")).alias("a"),
        (F.col("id") * 1.5).alias("x"),
        (F.col("id") % 3 + 1).cast("int").alias("k"),
    )


def test_faults_deterministic_and_rate(spark):
    df = _frame(spark)
    a = inject_faults(df, FAULTS).collect()
    b = inject_faults(df.repartition(7), FAULTS).collect()
    assert sorted(a) == sorted(b)
    rows = len(a)
    null_rate = sum(r.a is None for r in a) / rows
    assert 0.08 < null_rate < 0.12
    bad_k = [r.k for r in a if r.k not in (1, 2, 3)]
    assert set(bad_k) <= {4, 5, 6} and 0.03 < len(bad_k) / rows < 0.07
    hit_x = [r.x for r in a if r.x != r._row_key * 1.5]
    assert all(-50.0 <= v < 50.0 for v in hit_x)


def test_faults_match_sql(spark):
    df = _frame(spark, 3000)
    got = sorted(tuple(r) for r in inject_faults(df, FAULTS).collect())
    pdf = df.toPandas()
    con = duckdb.connect()
    con.register("t", pdf)
    types = {"a": "VARCHAR", "x": "DOUBLE", "k": "INTEGER"}
    cols = ", ".join(
        f"{fault_sql(f, '_row_key', types[f.column])} AS {f.column}" for f in FAULTS
    )
    want = sorted(con.execute(f"SELECT _row_key, {cols} FROM t").fetchall())
    assert got == want


# --- RA3 / RA4 quality -------------------------------------------------------

RULES = [
    quality.Rule("required_id", "id IS NOT NULL", "filter"),
    quality.Rule("valid_qty", "qty > 0", "drop"),
    quality.Rule("valid_code", "code IN (1, 2, 3)", "warn"),
]


def _qframe(spark):
    return spark.createDataFrame(
        [("a", 1.0, 1), (None, 2.0, 2), ("c", -1.0, 5), ("d", None, None), ("e", 0.0, 3)],
        "id string, qty double, code int",
    )


def test_rules_metrics_and_enforce(spark):
    df = _qframe(spark)
    clean, metrics = quality.apply_rules(df, RULES, "t")
    assert [r.id for r in clean.collect()] == ["a"]  # NULL qty drops, like WHERE
    m = {r.rule: (r.total_count, r.failed_count, r.action) for r in metrics.collect()}
    assert m == {
        "required_id": (5, 1, "filter"),
        "valid_qty": (5, 3, "drop"),
        "valid_code": (5, 2, "warn"),
    }


def test_clean_plus_quarantine_is_input(spark):
    df = _qframe(spark)
    clean = quality.enforce(df, RULES)
    quar = quality.quarantine(df, RULES)
    assert clean.count() + quar.count() == df.count()
    got = {r.id: r.failed_rules for r in quar.collect()}
    assert got == {None: ["required_id"], "c": ["valid_qty"], "d": ["valid_qty"], "e": ["valid_qty"]}


def test_observed_rules(spark, tmp_path):
    df = _qframe(spark)
    observed, obs = quality.observe_rules(df, RULES, "t")
    quality.enforce(observed, RULES).write.parquet(str(tmp_path / "out"))
    assert obs.get["total_count"] == 5 and obs.get["valid_qty"] == 3


# --- WIN1 share ------------------------------------------------------------------

def test_share_forms_agree_and_count_filtered_rows(spark):
    df = spark.createDataFrame([(1, 10.0), (2, 30.0), (3, -20.0), (4, 60.0)], "id int, mv double")
    a = with_share(df, "mv", "s", 4).filter("mv > 0")
    b = with_share_window(df, "mv", "s", 4).filter("mv > 0")
    ra = sorted(tuple(r) for r in a.collect())
    assert ra == sorted(tuple(r) for r in b.collect())
    # denominator is 80 (the negative row counts even though it is dropped)
    assert dict((r[0], r[2]) for r in ra) == {1: 0.125, 2: 0.375, 4: 0.75}
    # Only the one-row-per-task partial sums meet in a single partition; the
    # rows themselves never go through a Window.
    plan = a._jdf.queryExecution().optimizedPlan().toString()
    assert "scalar-subquery" in plan
    assert "Window" not in plan and "Join" not in plan


# --- join aggregation ---------------------------------------------------------------

MEASURES = [
    n("pairs"),
    cd("clients", "p.client_id"),
    cd("portfolios", "h.portfolio_id"),
    sum_("total_mv", "h.mv", 2),
    avg("avg_mv", "h.mv", 2),
    max_("max_mv", "h.mv", 2),
    min_("min_mv", "h.mv", 2),
    sd("sd_mv", "h.mv", 2),
    avg("avg_days", "h.days", 1),
    avg("avg_income", "p.income", 2),
]
KEYS = ["p.tier", "h.kind"]


def _join_inputs(spark):
    holdings = spark.createDataFrame(
        [
            Row(name="ANN", portfolio_id=1, mv=100.0, days=10, kind="E"),
            Row(name="ANN", portfolio_id=2, mv=250.5, days=20, kind="E"),
            Row(name="BOB", portfolio_id=1, mv=10.25, days=5, kind="B"),
            Row(name="BOB", portfolio_id=3, mv=None, days=7, kind="B"),
            Row(name="CY", portfolio_id=4, mv=1.0, days=1, kind=None),
            Row(name=None, portfolio_id=5, mv=9.0, days=1, kind="E"),
            Row(name="ZED", portfolio_id=6, mv=3.0, days=2, kind="E"),
        ]
        + [Row(name="HOT", portfolio_id=7 + i % 3, mv=float(i), days=i, kind="E") for i in range(40)]
    )
    profiles = spark.createDataFrame(
        [
            Row(name="ANN", client_id="c1", income=10.0, tier="A"),
            Row(name="ANN", client_id="c2", income=20.0, tier="A"),
            Row(name="ANN", client_id="c3", income=30.0, tier="B"),
            Row(name="BOB", client_id="c1", income=5.0, tier=None),
            Row(name="CY", client_id="c4", income=1.5, tier="A"),
            Row(name=None, client_id="c9", income=1.0, tier="A"),
        ]
        + [Row(name="HOT", client_id=f"h{i}", income=float(i), tier="B") for i in range(25)]
    )
    return holdings, profiles


def _brute(spark, holdings, profiles):
    holdings.createOrReplaceTempView("jh")
    profiles.createOrReplaceTempView("jp")
    return spark.sql(
        """SELECT p.tier, h.kind, count(*) AS pairs, count(DISTINCT p.client_id) AS clients,
              count(DISTINCT h.portfolio_id) AS portfolios,
              round(sum(h.mv), 2) AS total_mv, round(avg(h.mv), 2) AS avg_mv,
              round(max(h.mv), 2) AS max_mv, round(min(h.mv), 2) AS min_mv,
              round(stddev_samp(h.mv), 2) AS sd_mv, round(avg(h.days), 1) AS avg_days,
              round(avg(p.income), 2) AS avg_income
           FROM jh h JOIN jp p ON h.name = p.name GROUP BY p.tier, h.kind"""
    )


@pytest.mark.parametrize("strategy", ["direct", "blocked", "blocked_unsplit", "auto"])
def test_join_aggregate_equals_literal_join(spark, strategy):
    h, p = _join_inputs(spark)
    if strategy == "blocked_unsplit":
        got = blocked_join_aggregate(h, p, [("name", "name")], KEYS, MEASURES, ("h", "p"),
                                     split_shared={"h": False, "p": False})
    else:
        got = join_aggregate(h, p, [("name", "name")], KEYS, MEASURES, ("h", "p"), strategy=strategy)
    want = _brute(spark, h, p)
    norm = lambda rows: sorted((tuple(r) for r in rows), key=str)
    assert norm(got.collect()) == norm(want.collect())


def test_fan_out_counts_pairs(spark):
    h = spark.createDataFrame([("ANN LEE", 1.0), ("ANN LEE", 2.0)], "name string, v double")
    p = spark.createDataFrame([("ANN LEE", "a"), ("ANN LEE", "b"), ("ANN LEE", "c")], "name string, g string")
    out = join_aggregate(h, p, [("name", "name")], ["p.g"], [n("pairs"), sum_("s", "h.v", 2)],
                         ("h", "p"), strategy="blocked").collect()
    assert sorted((r.g, r.pairs, r.s) for r in out) == [("a", 2, 3.0), ("b", 2, 3.0), ("c", 2, 3.0)]
    assert pair_stats(h, p, [("name", "name")]) == (6, 2, 3)


def test_blocked_plan_has_no_row_pair_join(spark):
    h, p = _join_inputs(spark)
    got = join_aggregate(h, p, [("name", "name")], KEYS, MEASURES, ("h", "p"), strategy="blocked")
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "CartesianProduct" not in plan and "Expand" not in plan


def test_join_stats_measure_fan_out(spark):
    h, p = _join_inputs(spark)
    st = join_stats(h, p, [("name", "name")], ["kind"], ["tier"])
    # ANN 2x3, BOB 2x1, CY 1x1, HOT 40x25; NULL names never match
    assert st["pairs"] == 6 + 2 + 1 + 1000
    assert st["left_combo"] == 2 * 2 + 2 * 1 + 1 * 1 + 40 * 1
    assert st["right_combo"] == 3 * 1 + 1 * 1 + 1 * 1 + 25 * 1


@pytest.mark.parametrize("strategy", ["direct", "blocked", "blocked_unsplit"])
def test_multi_key_join_with_key_columns_in_groups(spark, strategy):
    h = spark.createDataFrame(
        [("A", "tech", "EU", 1, 10.0), ("A", "tech", "EU", 2, 20.0), ("A", "tech", "US", 3, 5.0),
         ("B", "fin", "EU", 1, 7.5), ("B", "fin", "EU", 1, 2.5), (None, "fin", "EU", 9, 1.0)],
        "asset string, sector string, region string, pid int, mv double",
    )
    m = spark.createDataFrame(
        [("A", "tech", "EU", "Mid", 1.5), ("A", "tech", "EU", "Mid", 2.5), ("A", "tech", "EU", "Large", 0.5),
         ("A", "tech", "US", "Mid", 3.0), ("B", "fin", "EU", None, 4.0), ("B", "fin", "US", "Mid", 9.0)],
        "asset string, sector string, region string, tier string, ret double",
    )
    on = [("asset", "asset"), ("sector", "sector"), ("region", "region")]
    keys = ["h.sector", "h.region", "m.tier"]
    meas = [n("pairs"), cd("pids", "h.pid"), sum_("mv", "h.mv", 2), avg("ret", "m.ret", 4), sd("sd_ret", "m.ret", 4)]
    if strategy == "blocked_unsplit":
        got = blocked_join_aggregate(h, m, on, keys, meas, ("h", "m"), split_shared={"h": False, "m": False})
    else:
        got = join_aggregate(h, m, on, keys, meas, ("h", "m"), strategy=strategy)
    h.createOrReplaceTempView("kh")
    m.createOrReplaceTempView("km")
    want = spark.sql(
        """SELECT h.sector, h.region, m.tier, count(*) AS pairs, count(DISTINCT h.pid) AS pids,
                  round(sum(h.mv), 2) AS mv, round(avg(m.ret), 4) AS ret, round(stddev_samp(m.ret), 4) AS sd_ret
           FROM kh h JOIN km m ON h.asset = m.asset AND h.sector = m.sector AND h.region = m.region
           GROUP BY h.sector, h.region, m.tier""")
    norm = lambda rows: sorted((tuple(r) for r in rows), key=str)
    assert norm(got.collect()) == norm(want.collect())


def test_hot_key_routes_to_pair_free_plan(spark):
    from pyspark.sql import functions as F

    # one name holds a third of the rows on both sides: 1000 x 1000 pairs
    left = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("n"), F.col("id").cast("string"))).alias("name"),
        (F.col("id") % 7).cast("int").alias("pid"),
        (F.col("id") * 0.25).alias("mv"),
        F.when(F.col("id") % 2 == 0, "E").otherwise("B").alias("kind"),
    )
    right = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("n"), F.col("id").cast("string"))).alias("name"),
        F.concat(F.lit("c"), F.col("id").cast("string")).alias("client_id"),
        (F.col("id") % 4).cast("string").alias("tier"),
        F.lit(1.0).alias("income"),
    )
    st = join_stats(left, right, [("name", "name")])
    assert st["pairs"] > 100 * max(st["left"], st["right"])
    measures = [n("pairs"), cd("clients", "p.client_id"), cd("portfolios", "h.pid"),
                sum_("total_mv", "h.mv", 2), avg("avg_mv", "h.mv", 2), sd("sd_mv", "h.mv", 2)]
    got = join_aggregate(left, right, [("name", "name")], ["p.tier", "h.kind"], measures, ("h", "p"))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan  # the literal join + distinct plan was not chosen
    left.createOrReplaceTempView("sh")
    right.createOrReplaceTempView("sp")
    want = spark.sql(
        """SELECT p.tier, h.kind, count(*) AS pairs, count(DISTINCT p.client_id) AS clients,
                  count(DISTINCT h.pid) AS portfolios, round(sum(h.mv), 2) AS total_mv,
                  round(avg(h.mv), 2) AS avg_mv, round(stddev_samp(h.mv), 2) AS sd_mv
           FROM sh h JOIN sp p ON h.name = p.name GROUP BY p.tier, h.kind""")
    norm = lambda rows: sorted((tuple(r) for r in rows), key=str)
    assert norm(got.collect()) == norm(want.collect())


def test_pair_free_stddev_is_stable_for_large_means(spark):
    from pyspark.sql import functions as F

    # mean 1e9, spread of a few cents: sum(x^2) - sum(x)^2/n would cancel to noise
    left = spark.range(600).select(
        (F.col("id") % 5).cast("string").alias("name"),
        (F.lit(1e9) + (F.col("id") % 7) * 0.01).alias("mv"),
        F.lit("E").alias("kind"),
    )
    right = spark.range(50).select((F.col("id") % 5).cast("string").alias("name"), F.lit("A").alias("tier"))
    got = blocked_join_aggregate(left, right, [("name", "name")], ["p.tier", "h.kind"],
                                 [n("pairs"), sd("sd_mv", "h.mv", 6)], ("h", "p")).collect()
    left.createOrReplaceTempView("bh")
    right.createOrReplaceTempView("bp")
    want = spark.sql("""SELECT p.tier, h.kind, count(*) AS pairs, round(stddev_samp(h.mv), 6) AS sd_mv
                        FROM bh h JOIN bp p ON h.name = p.name GROUP BY p.tier, h.kind""").collect()
    assert [tuple(r) for r in got] == [tuple(r) for r in want]
    assert 0.01 < got[0].sd_mv < 0.03


def test_blocked_join_keeps_large_whole_numbers():
    from tessera.session import build_session

    spark = build_session(master="local[*]")
    left = spark.range(40).select(F.lit("k").alias("name"), F.lit("a").alias("kind"),
                                  (F.lit(4 * 10**18)).cast("bigint").alias("big"), F.lit(0.5).alias("x"))
    right = spark.range(30).select(F.lit("k").alias("name"), F.lit("t").alias("tier"))
    ms = [avg("mean", "l.big"), n("pairs"), avg("half", "l.x", 2)]
    rows = [join_aggregate(left, right, [("name", "name")], ["l.kind", "r.tier"], ms, strategy=s).collect()
            for s in ("direct", "blocked")]
    assert rows[0] == rows[1] and rows[0][0]["mean"] == 4e18 and rows[0][0]["pairs"] == 1200


def test_pair_counts_pass_13_digits(spark):
    big = spark.range(1).select(F.lit(16 * 10**12).cast("bigint").alias("n"), F.lit("8000000000000.00").cast("decimal(38,8)").alias("t"))
    from tessera.operators.aggregate import exact_ratio

    assert big.select(exact_ratio(F.col("t"), F.col("n"), 2)).first()[0] == 0.5
    one = spark.range(1).select(F.lit("k").alias("name"))
    assert pair_stats(one, one, [("name", "name")]) == (1, 1, 1)


def test_a_value_on_every_row_is_not_joined_with_itself(spark):
    """One region on all rows, ids under one name and under several."""
    from pyspark.sql import functions as F

    left = spark.range(4000).select(
        (F.col("id") % 700).cast("string").alias("name"), F.lit("EU").alias("region"),
        F.when(F.col("id") % 9 == 0, "odd").otherwise(F.col("id").cast("string")).alias("pid"),
        F.when(F.col("id") % 4 > 0, (F.col("id") % 3).cast("string")).alias("kind"))
    right = spark.range(3000).select(
        (F.col("id") % 900).cast("string").alias("name"), (F.col("id") % 8).cast("string").alias("tier"))
    measures = [n("pairs"), cd("regions", "h.region"), cd("pids", "h.pid")]
    keys = ["p.tier", "h.kind"]
    got = blocked_join_aggregate(left, right, [("name", "name")], keys, measures, ("h", "p"))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.split("\n") if "Join " in line]
    assert joins and not any("_val" in line for line in joins)
    want = join_aggregate(left, right, [("name", "name")], keys, measures, ("h", "p"), strategy="direct")
    norm = lambda rows: sorted((tuple(r) for r in rows), key=str)
    assert norm(got.collect()) == norm(want.collect())


def _many_groups(spark):
    """Transactions of many advisors, some null, beside clients."""
    i = F.col("id")
    left = spark.range(4000).select(
        F.concat(F.lit("c"), (i % 500).cast("string")).alias("name"),
        F.when(i % 97 != 0, F.concat(F.lit("a"), (i % 400).cast("string"))).alias("advisor"),
        F.when(i % 11 != 0, (i % 7).cast("int")).alias("pid"),
        F.when(i % 13 != 0, F.concat(F.lit("s"), (i % 5).cast("string"))).alias("symbol"),
        F.when(i % 17 != 0, i * 0.25).alias("mv"),
    )
    right = spark.range(500).select(
        F.concat(F.lit("c"), i.cast("string")).alias("name"), i.cast("string").alias("client"),
        F.when(i % 9 != 0, (i % 3).cast("string")).alias("tier"),
    )
    return left, right


def test_distinct_counts_of_many_groups_move_each_row_once(spark):
    left, right = _many_groups(spark)
    measures = [n("pairs"), cd("clients", "p.client"), cd("pids", "t.pid"), cd("symbols", "t.symbol"),
                sum_("total", "t.mv", 2), avg("mean", "t.mv", 2), max_("most", "t.mv", 2), sd("spread", "t.mv", 4)]
    keys, on = ["t.advisor", "p.tier"], [("name", "name")]
    got = join_aggregate(left, right, on, keys, measures, ("t", "p"))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and plan.count("Exchange hashpartitioning(advisor") == 1
    want = direct_join_aggregate(left, right, on, keys, measures, ("t", "p"))
    norm = lambda rows: sorted((tuple(r) for r in rows), key=str)
    assert got.dtypes == want.dtypes and norm(got.collect()) == norm(want.collect())


def test_rows_of_a_hot_group_are_not_dealt(spark):
    left, right = _many_groups(spark)
    hot = left.withColumn("advisor", F.when(F.col("mv") > 300, "hot").otherwise(F.col("advisor")))
    measures = [n("pairs"), cd("clients", "p.client"), cd("pids", "t.pid")]
    got = join_aggregate(hot, right, [("name", "name")], ["t.advisor", "p.tier"], measures, ("t", "p"))
    assert "Expand" in got._jdf.queryExecution().optimizedPlan().toString()


def test_few_partner_keys_are_joined_before_rows_are_copied(spark):
    left, right = _many_groups(spark)
    got = blocked_join_aggregate(left, right, [("name", "name")], ["p.tier"],
                                 [n("pairs"), cd("pids", "t.pid"), cd("symbols", "t.symbol")], ("t", "p"),
                                 split_shared={"t": False, "p": False})
    plan = got._jdf.queryExecution().optimizedPlan().toString().split("\n")
    below = [i for i, line in enumerate(plan) if "Generate explode" in line]
    assert below and all(any("Join" in line for line in plan[i:]) for i in below)
    want = direct_join_aggregate(left, right, [("name", "name")], ["p.tier"],
                                 [n("pairs"), cd("pids", "t.pid"), cd("symbols", "t.symbol")], ("t", "p"))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_join_stats_count_combinations_beside_join_columns(spark):
    left = spark.createDataFrame([("A", "x", "1"), ("A", "x", None), ("A", "y", "1"), ("B", "x", "1"), (None, "x", "1")],
                                 "name string, sector string, tier string")
    st = join_stats(left, left, [("name", "name"), ("sector", "sector")], ["sector"], ["sector", "tier"])
    assert st == {"pairs": 6, "left": 4, "right": 4, "left_combo": 6, "right_combo": 4}
    same = join_stats(left, left, [("name", "name")], ["tier"], ["sector", "tier"])
    assert same == {"pairs": 10, "left": 4, "right": 4, "left_combo": 10, "right_combo": 7}
