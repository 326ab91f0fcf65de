"""RA2: shape the supplied star-schema tables into the six bronze tables.

Each adapter is a declarative join/projection over the supplied parquet
tables; Catalyst prunes the scans to the columns used here and AQE picks the
join strategy from runtime sizes (the nation/region dimensions broadcast on
their own because their scans are tiny; nothing is hinted).

Every adapter returns the bronze columns (``tessera.sources.schemas``) plus
``_row_key``, a deterministic BIGINT used by the fault injector
(``tessera.operators.faults``); ``bronze(...)`` drops it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import buckets as B
from tessera.functions.buckets import regex_bucket
from tessera.functions.tiers import code_label
from tessera.sources import schemas
from tessera.sources.tables import read_table

ROW_KEY = "_row_key"


def _s(col: str) -> Column:
    return F.col(col).cast("string")


def _asset_name() -> Column:
    return F.concat(F.col("p_name"), F.lit(" #"), _s("p_partkey"))


def _line_id() -> Column:
    return F.concat(_s("l_orderkey"), F.lit("-"), _s("l_linenumber"))


def _line_key() -> Column:
    return F.col("l_orderkey") * 8 + F.col("l_linenumber")


def _with_region(spark: SparkSession, sf_dir: str, df: DataFrame, nation_key: str, out: str) -> DataFrame:
    """Attach the region name through nation. Each dimension is joined to the
    fact side as a base relation, so the planner compares real table sizes:
    a pre-joined dimension subquery gets a product-of-inputs size estimate
    and would make the fact side look like the smaller (broadcast) side."""
    nation = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_regionkey"])
    region = read_table(spark, sf_dir, "region", ["r_regionkey", "r_name"])
    return (
        df.join(nation, F.col(nation_key) == nation.n_nationkey)
        .join(region, F.col("n_regionkey") == region.r_regionkey)
        .drop("n_nationkey", "n_regionkey")
        .withColumnRenamed("r_name", out)
    )


def _with_customer(spark: SparkSession, sf_dir: str, df: DataFrame, cust_key: str) -> DataFrame:
    cust = read_table(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_nationkey"])
    joined = df.join(cust, F.col(cust_key) == cust.c_custkey)
    return _with_region(spark, sf_dir, joined, "c_nationkey", "c_region").drop("r_regionkey")


def holdings(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(
        spark, sf_dir, "lineitem",
        ["l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice",
         "l_linestatus", "l_shipdate"],
    )
    orders = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey"])
    part = read_table(spark, sf_dir, "part", ["p_partkey", "p_name", "p_type", "p_retailprice"])
    # the customer comes to an order first: fewer rows than to each of its lines
    placed = _with_customer(spark, sf_dir, orders, "o_custkey")
    df = li.join(placed, li.l_orderkey == placed.o_orderkey).join(part, F.col("l_partkey") == part.p_partkey)
    return df.select(
        _line_id().alias("holding_id"),
        F.col("c_name").alias("client_name"),
        _asset_name().alias("asset_name"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("market_value"),
        F.col("l_shipdate").alias("valuation_date"),
        regex_bucket("p_name", *B.ASSET_TYPE).alias("asset_type"),
        (F.col("c_custkey") % 1000 + 1000).cast("int").alias("account_id"),
        (F.col("l_orderkey") % 500 + 500).cast("int").alias("portfolio_id"),
        F.col("p_type").alias("sector"),
        F.col("c_region").alias("region"),
        (F.col("l_linenumber") % 3 + 1).cast("int").alias("risk_rating"),
        F.when(F.col("l_linestatus") == "O", "USD").otherwise("EUR").alias("currency"),
        regex_bucket("p_type", *B.INVESTMENT_STRATEGY).alias("investment_strategy"),
        (F.col("l_quantity") * F.col("p_retailprice")).alias("cost_basis"),
        F.col("l_shipdate").alias("processing_timestamp"),
        _line_key().alias(ROW_KEY),
    )


def market(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One daily-style bar per (part, supplier region, ship month)."""
    li = read_table(
        spark, sf_dir, "lineitem",
        ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
         "l_extendedprice", "l_discount", "l_shipdate"],
    )
    part = read_table(spark, sf_dir, "part",
                      ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"])
    supp = read_table(spark, sf_dir, "supplier", ["s_suppkey", "s_nationkey"])
    with_supp = li.join(supp, li.l_suppkey == supp.s_suppkey)
    keys = ["l_partkey", "r_regionkey", "s_region", "ship_year", "ship_month"]
    # Nearly every line is a bar of its own, so a map-side aggregate would only sort
    # and widen the rows: they are dealt by the bar first and aggregated once.
    joined = (
        _with_region(spark, sf_dir, with_supp, "s_nationkey", "s_region")
        .withColumn("ship_year", F.year("l_shipdate"))
        .withColumn("ship_month", F.month("l_shipdate"))
        .select(*keys, "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_shipdate")
        .repartition(*keys)
        .withColumn("unit", F.col("l_extendedprice") / F.col("l_quantity"))
    )
    order_key = F.struct("l_shipdate", "l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity")
    bars = joined.groupBy(*keys).agg(
        F.min_by("unit", order_key).alias("open_price"),
        F.max("unit").alias("high_price"),
        F.min("unit").alias("low_price"),
        F.max_by("unit", order_key).alias("close_price"),
        F.sum("l_quantity").cast("int").alias("volume"),
        (F.sum(F.round(F.col("l_discount") * 100).cast("bigint")) / F.count(F.lit(1))).alias(
            "dividend_yield"
        ),
        F.max("l_shipdate").alias("trade_date"),
    )
    df = bars.join(part, bars.l_partkey == part.p_partkey)
    return df.select(
        F.col("p_brand").alias("symbol"),
        _asset_name().alias("asset_name"),
        "open_price",
        "high_price",
        "low_price",
        "close_price",
        "volume",
        "trade_date",
        regex_bucket("p_name", *B.EXCHANGE).alias("exchange"),
        F.col("p_type").alias("sector"),
        F.col("s_region").alias("region"),
        (F.round(F.col("p_retailprice") * 100).cast("bigint") * 10000
         * (F.col("p_partkey") % 1000 + 1)).alias("market_cap"),
        F.col("p_size").cast("double").alias("pe_ratio"),
        "dividend_yield",
        F.lit("USD").alias("currency"),
        F.col("trade_date").alias("processing_timestamp"),
        ((F.col("p_partkey") * 8 + F.col("r_regionkey")) * 100000
         + F.col("ship_year") * 12 + F.col("ship_month")).cast("bigint").alias(ROW_KEY),
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(
        spark, sf_dir, "lineitem",
        ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
         "l_extendedprice", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"],
    )
    orders = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])
    part = read_table(spark, sf_dir, "part", ["p_partkey", "p_brand", "p_type"])
    supp = read_table(spark, sf_dir, "supplier", ["s_suppkey", "s_name"])
    placed = _with_customer(spark, sf_dir, orders, "o_custkey")
    df = li.join(placed, li.l_orderkey == placed.o_orderkey)
    df = df.join(part, F.col("l_partkey") == part.p_partkey).join(supp, F.col("l_suppkey") == supp.s_suppkey)
    ttype = (
        F.when((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "O"), "BUY")
        .when(F.col("l_returnflag") == "R", "SELL")
        .when(F.col("l_returnflag") == "A", "DIVIDEND")
        .otherwise("REINVEST")
    )
    return df.select(
        _line_id().alias("transaction_id"),
        F.col("c_name").alias("client_name"),
        (F.col("c_custkey") % 1000 + 1000).cast("int").alias("account_id"),
        F.col("p_brand").alias("asset_symbol"),
        ttype.alias("transaction_type"),
        F.col("l_quantity").alias("quantity"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price_per_share"),
        F.col("l_extendedprice").alias("total_amount"),
        F.col("o_orderdate").alias("transaction_date"),
        (F.col("o_custkey") % 500 + 500).cast("int").alias("portfolio_id"),
        F.col("p_type").alias("sector"),
        F.col("c_region").alias("region"),
        (F.col("l_extendedprice") * F.col("l_tax")).alias("fees"),
        F.when(F.col("l_linestatus") == "O", "USD").otherwise("EUR").alias("currency"),
        F.col("s_name").alias("advisor_name"),
        F.col("l_shipdate").alias("processing_timestamp"),
        _line_key().alias(ROW_KEY),
    )


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = read_table(spark, sf_dir, "customer",
                      ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"])
    nation = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name"])
    # Per-customer order summary: partial aggregation before the shuffle, so
    # the join below sees one row per customer on both sides.
    orders = read_table(spark, sf_dir, "orders", ["o_custkey", "o_orderdate", "o_totalprice"])
    per_cust = orders.groupBy("o_custkey").agg(
        F.min("o_orderdate").alias("first_order"),
        (F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")) / 100.0).alias("order_total"),
    )
    df = cust.join(nation, cust.c_nationkey == nation.n_nationkey).join(
        per_cust, cust.c_custkey == per_cust.o_custkey, "left"
    )
    return df.select(
        _s("c_custkey").alias("client_id"),
        F.col("c_name").alias("client_name"),
        F.concat(F.lower(F.regexp_replace("c_name", "#", "")), F.lit("@example.com")).alias(
            "email_address"
        ),
        (F.col("c_custkey") % 63 + 18).cast("int").alias("age"),
        F.concat(F.lit("City "), _s_expr(F.col("c_custkey") % 50)).alias("city"),
        F.col("n_name").alias("country"),
        (F.col("c_acctbal") * 60).alias("annual_income"),
        (F.col("c_acctbal") * 700).alias("net_worth"),
        regex_bucket(F.lower("c_mktsegment"), *B.RISK_TOLERANCE).alias("risk_tolerance"),
        F.col("first_order").alias("account_open_date"),
        (F.col("c_custkey") % 30 + 1).cast("int").alias("investment_experience_years"),
        regex_bucket("c_mktsegment", *B.EMPLOYMENT_STATUS).alias("employment_status"),
        (F.col("c_custkey") % 3 + 1).cast("int").alias("account_type_code"),
        F.col("n_name").alias("advisor_name"),
        F.col("order_total").alias("total_portfolio_value"),
        F.col("first_order").alias("processing_timestamp"),
        F.col("c_custkey").cast("bigint").alias(ROW_KEY),
    )


def _s_expr(col: Column) -> Column:
    return col.cast("string")


# --- fixed values: event type -> employment status for the KYC feed ---
EVENT_EMPLOYMENT = ([("view", "Employed"), ("click", "Self-Employed"), ("signup", "Retired")],
                    "Unemployed")
# user_id % 4 -> account type for the KYC feed
USER_ACCOUNT_TYPE = ([(0, "Individual"), (1, "Joint"), (2, "Corporate")], "Trust")


def kyc_from_events(events: DataFrame) -> DataFrame:
    """KYC bronze projection over an events frame (batch or streaming)."""
    uid = F.col("user_id")
    return events.select(
        _s("user_id").alias("customer_id"),
        F.concat(F.lit("Client "), _s("user_id")).alias("full_name"),
        F.concat(F.lit("client"), _s("user_id"), F.lit("@example.com")).alias("email_address"),
        (uid % 63 + 18).cast("int").alias("age"),
        F.concat(F.lit("City "), _s_expr(uid % 20)).alias("city"),
        F.concat(F.lit("C"), _s_expr(uid % 5)).alias("country"),
        (F.col("value") * 1000).alias("annual_income"),
        regex_bucket("event_type", *B.RISK_TOLERANCE).alias("risk_profile"),
        F.col("ts").alias("kyc_timestamp"),
        (uid % 21).cast("int").alias("investment_experience_years"),
        code_label("event_type", *EVENT_EMPLOYMENT).alias("employment_status"),
        (F.col("value") * 5000).alias("net_worth"),
        code_label(uid % 4, *USER_ACCOUNT_TYPE).alias("account_type"),
        (F.col("event_id") % 3 + 1).cast("int").alias("kyc_status_code"),
        F.col("ts").alias("processing_timestamp"),
        F.col("event_id").alias(ROW_KEY),
    )


def purchases_from_events(events: DataFrame) -> DataFrame:
    uid = F.col("user_id")
    return events.select(
        _s("user_id").alias("customer_id"),
        F.concat(F.lit("Client "), _s("user_id")).alias("name"),
        F.concat(F.lit("client"), _s("user_id"), F.lit("@example.com")).alias("email"),
        (uid % 63 + 18).cast("int").alias("age"),
        F.concat(F.lit("City "), _s_expr(uid % 20)).alias("city"),
        F.concat(F.lit("C"), _s_expr(uid % 5)).alias("country"),
        F.col("value").alias("purchase_amount"),
        regex_bucket("event_type", *B.PRODUCT_CATEGORY).alias("product_category"),
        F.col("ts").alias("timestamp"),
        F.col("ts").alias("processing_timestamp"),
        F.col("event_id").alias(ROW_KEY),
    )


def kyc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kyc_from_events(read_table(spark, sf_dir, "events"))


def purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return purchases_from_events(read_table(spark, sf_dir, "events"))


ADAPTERS = {
    "holdings": holdings,
    "market": market,
    "transactions": transactions,
    "profiles": profiles,
    "kyc": kyc,
    "purchases": purchases,
}


def bronze_columns(table: str) -> list[str]:
    return [f.name for f in schemas.BRONZE[table].fields]
