"""Tier cuts, code labels and regex buckets on boundary rows."""

import pytest
from pyspark.sql import functions as F

from tessera.functions import buckets as B
from tessera.functions import tiers as T
from tessera.functions.buckets import regex_bucket
from tessera.functions.tiers import code_label, tier


def _apply(spark, values, dtype, expr_fn):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(expr_fn(F.col("x"))).collect()]


@pytest.mark.parametrize(
    "values, spec, expected",
    [
        (
            [18, 29, 30, 39, 40, 49, 50, 59, 60, 69, 70, 100, None],
            T.AGE_GROUP_BATCH,
            ["18-29", "18-29", "30-39", "30-39", "40-49", "40-49", "50-59", "50-59", "60-69",
             "60-69", "70+", "70+", "70+"],
        ),
        (
            [18, 24, 25, 34, 35, 44, 45, 54, 55, 64, 65],
            T.AGE_GROUP_STREAM,
            ["18-24", "18-24", "25-34", "25-34", "35-44", "35-44", "45-54", "45-54", "55-64",
             "55-64", "65+"],
        ),
        (
            [0, 1, 2, 4, 5, 9, 10, 19, 20],
            T.EXPERIENCE_LEVEL_BATCH,
            ["Beginner", "Beginner", "Intermediate", "Intermediate", "Advanced", "Advanced",
             "Expert", "Expert", "Veteran"],
        ),
    ],
)
def test_int_tiers(spark, values, spec, expected):
    assert _apply(spark, values, "int", lambda c: tier(c, *spec)) == expected


def test_income_and_wealth_tiers(spark):
    inc = [49999.99, 50000.0, 99999.99, 100000.0, 199999.99, 200000.0, 499999.99, 500000.0]
    assert _apply(spark, inc, "double", lambda c: tier(c, *T.INCOME_TIER_BATCH)) == [
        "Low Income", "Medium Income", "Medium Income", "High Income", "High Income",
        "Very High Income", "Very High Income", "Ultra High Income",
    ]
    nw = [99999.0, 100000.0, 499999.0, 500000.0, 999999.0, 1e6, 4999999.0, 5e6]
    assert _apply(spark, nw, "double", lambda c: tier(c, *T.NET_WORTH_TIER_BATCH)) == [
        "Low Net Worth", "Medium Net Worth", "Medium Net Worth", "High Net Worth",
        "High Net Worth", "Very High Net Worth", "Very High Net Worth", "Ultra High Net Worth",
    ]
    assert _apply(spark, [999.99, 1000.0, 9999.99, 10000.0, 99999.99, 100000.0], "double",
                  lambda c: tier(c, *T.TRANSACTION_SIZE_TIER)) == [
        "Small", "Medium", "Medium", "Large", "Large", "Very Large"]
    assert _apply(spark, [49.99, 50.0, 199.99, 200.0], "double",
                  lambda c: tier(c, *T.PURCHASE_TIER)) == ["Low", "Medium", "Medium", "High"]


def test_market_tiers_null_and_negative(spark):
    y = [None, -1.0, 0.99, 1.0, 2.99, 3.0, 4.99, 5.0]
    assert _apply(spark, y, "double", lambda c: tier(c, *T.DIVIDEND_YIELD_TIER)) == [
        "Very High Yield", "Low Yield", "Low Yield", "Medium Yield", "Medium Yield",
        "High Yield", "High Yield", "Very High Yield",
    ]
    caps = [999_999_999, 1_000_000_000, 9_999_999_999, 10_000_000_000, 99_999_999_999,
            100_000_000_000]
    assert _apply(spark, caps, "bigint", lambda c: tier(c, *T.MARKET_CAP_TIER)) == [
        "Small Cap", "Mid Cap", "Mid Cap", "Large Cap", "Large Cap", "Mega Cap"]


def test_code_labels(spark):
    assert _apply(spark, [1, 2, 3, 5, None], "int", lambda c: code_label(c, *T.RISK_LEVEL)) == [
        "Low", "Medium", "High", "High", "High"]
    assert _apply(spark, [1, 2, 3, 4], "int", lambda c: code_label(c, *T.ACCOUNT_TYPE_BATCH)) == [
        "Individual", "Joint", "Corporate", "Corporate"]
    assert _apply(spark, [1, 2, 3, 6], "int", lambda c: code_label(c, *T.KYC_STATUS)) == [
        "Pending", "Approved", "Rejected", "Rejected"]


def test_first_letter_bucket(spark):
    words = ["apple", "bond", "house", "night", "zebra", "Apple", None]
    assert _apply(spark, words, "string", lambda c: regex_bucket(c, *B.ASSET_TYPE)) == [
        "Equity", "Bond", "ETF", "Mutual Fund", "Alternative Investment",
        "Alternative Investment", "Alternative Investment",
    ]


def test_substring_bucket_first_match_wins(spark):
    text = ["FinTech Health", "Green Energy", "my finance", None]
    assert _apply(spark, text, "string", lambda c: regex_bucket(c, *B.SECTOR)) == [
        "Technology", "Energy", "Financial Services", "Consumer Goods"]


def test_modulo_codes_of_texts(spark):
    from tessera.functions.columns import modulo_code

    rows = [("7",), ("-7",), (" 8 ",), ("n/a",), ("",), (None,), ("99999999999",), ("-2147483648",)]
    got = spark.createDataFrame(rows, "t string").select(modulo_code("t", 5, 10).alias("c")).collect()
    assert [r.c for r in got] == [12, 12, 13, None, None, None, None, 2147483648 % 5 + 10]
