"""RA3 / RA4: declarative data-quality rules.

A rule is ``(name, SQL predicate, action)``:

* ``drop``   -- an expectation whose failing rows leave the table;
* ``warn``   -- an expectation that only counts failures;
* ``filter`` -- a required-field condition of the silver table itself.

A row is kept iff every ``drop`` and ``filter`` predicate IS TRUE (a NULL
predicate drops the row, as in a WHERE clause). Counts are produced by one
aggregate pass (partial aggregation per task, one row to the final stage),
or by an ``Observation`` riding on the write.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    name: str
    predicate: str
    action: str  # "drop" | "warn" | "filter"

    def holds(self) -> Column:
        return F.coalesce(F.expr(self.predicate), F.lit(False))


def keep_predicate(rules: Sequence[Rule]) -> Column:
    preds = [F.expr(r.predicate) for r in rules if r.action in ("drop", "filter")]
    return reduce(lambda a, b: a & b, preds) if preds else F.lit(True)


def enforce(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows passing every drop/filter rule."""
    return df.filter(keep_predicate(rules))


def rule_metrics(df: DataFrame, rules: Sequence[Rule], table: str) -> DataFrame:
    """One row per rule: (table_name, rule, action, total_count, failed_count)."""
    aggs = [F.count(F.lit(1)).alias("_total")] + [
        F.count_if(~r.holds()).alias(f"_f{i}") for i, r in enumerate(rules)
    ]
    wide = df.agg(*aggs)
    rows = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(r.name).alias("rule"),
                    F.lit(r.action).alias("action"),
                    F.col(f"_f{i}").alias("failed_count"),
                )
                for i, r in enumerate(rules)
            ]
        )
    )
    return wide.select(F.col("_total"), rows.alias("_r")).select(
        F.lit(table).alias("table_name"),
        F.col("_r.rule").alias("rule"),
        F.col("_r.action").alias("action"),
        F.col("_total").cast("bigint").alias("total_count"),
        F.col("_r.failed_count").cast("bigint").alias("failed_count"),
    )


def apply_rules(df: DataFrame, rules: Sequence[Rule], table: str) -> tuple[DataFrame, DataFrame]:
    """(clean rows, per-rule metrics). Both are lazy plans over ``df``."""
    return enforce(df, rules), rule_metrics(df, rules, table)


def observe_rules(df: DataFrame, rules: Sequence[Rule], table: str) -> tuple[DataFrame, Observation]:
    """Counting variant for writes and streams: the counters ride on the
    action that consumes the returned frame; ``observation.get`` holds them
    afterwards (batch) or the query progress reports them (stream)."""
    obs = Observation(f"quality_{table}")
    exprs = [F.count(F.lit(1)).alias("total_count")] + [
        F.count_if(~r.holds()).alias(r.name) for r in rules
    ]
    return df.observe(obs, *exprs), obs


def quarantine(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """RA4: rows that fail at least one drop/filter rule, with the failed rules'
    names (array, rule order) in ``failed_rules``."""
    blocking = [r for r in rules if r.action in ("drop", "filter")]
    names = F.array_compact(F.array(*[F.when(~r.holds(), F.lit(r.name)) for r in blocking]))
    return df.withColumn("failed_rules", names).filter(F.size("failed_rules") > 0)


# --- fixed values: rule sets (name, predicate, action) per table ---

HOLDINGS = [
    Rule("required_holding_id", "holding_id IS NOT NULL", "filter"),
    Rule("required_client_name", "client_name IS NOT NULL", "filter"),
    Rule("required_asset_name", "asset_name IS NOT NULL", "filter"),
    Rule("valid_quantity", "quantity > 0", "drop"),
    Rule("valid_market_value", "market_value > 0", "drop"),
    Rule("valid_cost_basis", "cost_basis > 0", "drop"),
    Rule("non_null_holding_id", "holding_id IS NOT NULL", "warn"),
    Rule("non_null_client_name", "client_name IS NOT NULL", "warn"),
    Rule("non_null_asset_name", "asset_name IS NOT NULL", "warn"),
    Rule("valid_risk_rating", "risk_rating IN (1, 2, 3)", "warn"),
    Rule("valid_account_id", "account_id >= 1000 AND account_id <= 1999", "warn"),
    Rule("valid_portfolio_id", "portfolio_id >= 500 AND portfolio_id <= 999", "warn"),
]

MARKET = [
    Rule("required_symbol", "symbol IS NOT NULL", "filter"),
    Rule("required_asset_name", "asset_name IS NOT NULL", "filter"),
    Rule(
        "valid_prices",
        "open_price > 0 AND high_price > 0 AND low_price > 0 AND close_price > 0",
        "drop",
    ),
    Rule("valid_volume", "volume > 0", "drop"),
    Rule("valid_market_cap", "market_cap > 0", "drop"),
    Rule("valid_pe_ratio", "pe_ratio > 0", "drop"),
    Rule("non_null_symbol", "symbol IS NOT NULL", "warn"),
    Rule("non_null_asset_name", "asset_name IS NOT NULL", "warn"),
    Rule("valid_exchange", "exchange IN ('NYSE', 'NASDAQ', 'LSE', 'TSE')", "warn"),
    Rule(
        "price_consistency",
        "high_price >= low_price AND high_price >= open_price AND high_price >= close_price",
        "warn",
    ),
]

TRANSACTIONS = [
    Rule("required_transaction_id", "transaction_id IS NOT NULL", "filter"),
    Rule("required_client_name", "client_name IS NOT NULL", "filter"),
    Rule("required_asset_symbol", "asset_symbol IS NOT NULL", "filter"),
    Rule("valid_quantity", "quantity > 0", "drop"),
    Rule("valid_price_per_share", "price_per_share > 0", "drop"),
    Rule("valid_total_amount", "total_amount > 0", "drop"),
    Rule("valid_fees", "fees >= 0", "drop"),
    Rule("non_null_transaction_id", "transaction_id IS NOT NULL", "warn"),
    Rule("non_null_client_name", "client_name IS NOT NULL", "warn"),
    Rule("non_null_asset_symbol", "asset_symbol IS NOT NULL", "warn"),
    Rule(
        "valid_transaction_type",
        "transaction_type IN ('BUY', 'SELL', 'DIVIDEND', 'REINVEST')",
        "warn",
    ),
    Rule("valid_account_id", "account_id >= 1000 AND account_id <= 1999", "warn"),
    Rule("valid_portfolio_id", "portfolio_id >= 500 AND portfolio_id <= 999", "warn"),
]

PROFILES = [
    Rule("required_client_id", "client_id IS NOT NULL", "filter"),
    Rule("required_client_name", "client_name IS NOT NULL", "filter"),
    Rule("required_email", "email_address IS NOT NULL", "filter"),
    Rule("valid_age", "age >= 18 AND age <= 100", "drop"),
    Rule("valid_annual_income", "annual_income > 0", "drop"),
    Rule("valid_net_worth", "net_worth > 0", "drop"),
    Rule("valid_portfolio_value", "total_portfolio_value > 0", "drop"),
    Rule("valid_experience", "investment_experience_years >= 0", "drop"),
    Rule("non_null_client_id", "client_id IS NOT NULL", "warn"),
    Rule("non_null_client_name", "client_name IS NOT NULL", "warn"),
    Rule("non_null_email", "email_address IS NOT NULL", "warn"),
    Rule("valid_account_type", "account_type_code IN (1, 2, 3)", "warn"),
    Rule(
        "valid_risk_tolerance",
        "risk_tolerance IN ('Conservative', 'Moderate', 'Aggressive', 'Balanced')",
        "warn",
    ),
]

KYC = [
    Rule("required_customer_id", "customer_id IS NOT NULL", "filter"),
    Rule("required_email", "email_address IS NOT NULL", "filter"),
    Rule("required_full_name", "full_name IS NOT NULL", "filter"),
    Rule("valid_age", "age >= 18 AND age <= 100", "drop"),
    Rule("valid_income", "annual_income > 0", "drop"),
    Rule("valid_net_worth", "net_worth > 0", "drop"),
    Rule("valid_experience", "investment_experience_years >= 0", "drop"),
    Rule("non_null_customer_id", "customer_id IS NOT NULL", "warn"),
    Rule("non_null_email", "email_address IS NOT NULL", "warn"),
    Rule("non_null_name", "full_name IS NOT NULL", "warn"),
    Rule("valid_kyc_status", "kyc_status_code IN (1, 2, 3)", "warn"),
]

PURCHASES = [
    Rule("required_customer_id", "customer_id IS NOT NULL", "filter"),
    Rule("required_email", "email IS NOT NULL", "filter"),
    Rule("valid_age", "age >= 18 AND age <= 80", "drop"),
    Rule("valid_purchase", "purchase_amount > 0", "drop"),
    Rule("non_null_customer_id", "customer_id IS NOT NULL", "warn"),
    Rule("non_null_email", "email IS NOT NULL", "warn"),
]

RULES = {
    "holdings": HOLDINGS,
    "market": MARKET,
    "transactions": TRANSACTIONS,
    "profiles": PROFILES,
    "kyc": KYC,
    "purchases": PURCHASES,
}
