"""Explicit bronze schemas (SRC1): every stored bronze table is read back with
its declared schema instead of inference. Event-time columns keep the
supplied tables' ``TIMESTAMP_NTZ`` type, so values do not move with the
session time zone."""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

S, I, L, D, T = StringType(), IntegerType(), LongType(), DoubleType(), TimestampNTZType()


def _schema(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])  # type: ignore[arg-type]


HOLDINGS = _schema(
    ("holding_id", S), ("client_name", S), ("asset_name", S), ("quantity", D),
    ("market_value", D), ("valuation_date", T), ("asset_type", S), ("account_id", I),
    ("portfolio_id", I), ("sector", S), ("region", S), ("risk_rating", I),
    ("currency", S), ("investment_strategy", S), ("cost_basis", D),
    ("processing_timestamp", T),
)

MARKET = _schema(
    ("symbol", S), ("asset_name", S), ("open_price", D), ("high_price", D),
    ("low_price", D), ("close_price", D), ("volume", I), ("trade_date", T),
    ("exchange", S), ("sector", S), ("region", S), ("market_cap", L),
    ("pe_ratio", D), ("dividend_yield", D), ("currency", S),
    ("processing_timestamp", T),
)

TRANSACTIONS = _schema(
    ("transaction_id", S), ("client_name", S), ("account_id", I), ("asset_symbol", S),
    ("transaction_type", S), ("quantity", D), ("price_per_share", D),
    ("total_amount", D), ("transaction_date", T), ("portfolio_id", I), ("sector", S),
    ("region", S), ("fees", D), ("currency", S), ("advisor_name", S),
    ("processing_timestamp", T),
)

PROFILES = _schema(
    ("client_id", S), ("client_name", S), ("email_address", S), ("age", I),
    ("city", S), ("country", S), ("annual_income", D), ("net_worth", D),
    ("risk_tolerance", S), ("account_open_date", T),
    ("investment_experience_years", I), ("employment_status", S),
    ("account_type_code", I), ("advisor_name", S), ("total_portfolio_value", D),
    ("processing_timestamp", T),
)

KYC = _schema(
    ("customer_id", S), ("full_name", S), ("email_address", S), ("age", I),
    ("city", S), ("country", S), ("annual_income", D), ("risk_profile", S),
    ("kyc_timestamp", T), ("investment_experience_years", I),
    ("employment_status", S), ("net_worth", D), ("account_type", S),
    ("kyc_status_code", I), ("processing_timestamp", T),
)

PURCHASES = _schema(
    ("customer_id", S), ("name", S), ("email", S), ("age", I), ("city", S),
    ("country", S), ("purchase_amount", D), ("product_category", S),
    ("timestamp", T), ("processing_timestamp", T),
)

EVENTS = _schema(
    ("event_id", L), ("ts", T), ("user_id", L), ("event_type", S), ("value", D),
    ("props", S),
)

BRONZE = {
    "holdings": HOLDINGS,
    "market": MARKET,
    "transactions": TRANSACTIONS,
    "profiles": PROFILES,
    "kyc": KYC,
    "purchases": PURCHASES,
}
