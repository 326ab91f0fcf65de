"""SLV1-SLV6: bronze -> silver derivations, quality rules and filters.

Each builder adds its derived columns in one ``withColumns`` projection (two
where a derived column reads another), evaluates the table's rules on the
derived frame, and keeps rows passing every drop/filter rule. The functions
work unchanged on batch and streaming frames, except ``holdings``, whose
whole-table share (WIN1) needs a batch input.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import tiers as T
from tessera.functions.columns import (
    as_of_literal,
    clean_lower,
    clean_upper,
    days_since,
    guarded_pct,
    processing_parts,
    ymd,
)
from tessera.functions.tiers import code_label, tier
from tessera.operators import quality
from tessera.operators.share import with_share

AsOf = _dt.datetime | _dt.date | str | None


def derive_holdings(bronze: DataFrame, as_of: AsOf = None, share_scale: int = 4) -> DataFrame:
    mv, cb = F.col("market_value"), F.col("cost_basis")
    df = bronze.withColumns(
        {
            "client_name_clean": clean_upper("client_name"),
            "asset_name_clean": clean_upper("asset_name"),
            "unrealized_gain_loss": mv - cb,
            "gain_loss_percentage": guarded_pct(mv - cb, cb, cb, 2),
        }
    )
    # The share's denominator covers every bronze row, before any filter.
    df = with_share(df, "market_value", "position_size_percentage", share_scale)
    return df.withColumns(
        {
            "risk_level": code_label("risk_rating", *T.RISK_LEVEL),
            "valuation_date_clean": ymd("valuation_date"),
            "days_held": days_since("valuation_date", as_of_literal(as_of)),
            **processing_parts(),
        }
    )


def derive_market(bronze: DataFrame) -> DataFrame:
    o, h, lo, cl = (F.col(c) for c in ("open_price", "high_price", "low_price", "close_price"))
    return bronze.withColumns(
        {
            "symbol_clean": clean_upper("symbol"),
            "asset_name_clean": clean_upper("asset_name"),
            "daily_return": guarded_pct(cl - o, o, o, 4),
            "price_range": h - lo,
            "price_range_percentage": guarded_pct(h - lo, lo, lo, 2),
            "volume_weighted_price": F.round((h + lo + cl) / 3, 2),
            "market_cap_tier": tier("market_cap", *T.MARKET_CAP_TIER),
            "pe_ratio_tier": tier("pe_ratio", *T.PE_RATIO_TIER),
            "dividend_yield_tier": tier("dividend_yield", *T.DIVIDEND_YIELD_TIER),
            "trade_date_clean": ymd("trade_date"),
            **processing_parts(),
        }
    )


def derive_transactions(bronze: DataFrame) -> DataFrame:
    total, fees = F.col("total_amount"), F.col("fees")
    tdate = F.col("transaction_date")
    return bronze.withColumns(
        {
            "client_name_clean": clean_upper("client_name"),
            "asset_symbol_clean": clean_upper("asset_symbol"),
            "advisor_name_clean": clean_upper("advisor_name"),
            "transaction_amount_after_fees": total - fees,
            "fee_percentage": guarded_pct(fees, total, total, 4),
            "transaction_category": code_label("transaction_type", *T.TRANSACTION_CATEGORY),
            "transaction_size_tier": tier("total_amount", *T.TRANSACTION_SIZE_TIER),
            "transaction_date_clean": ymd("transaction_date"),
            "transaction_month": F.month(tdate),
            "transaction_year": F.year(tdate),
            "transaction_day_of_week": F.dayofweek(tdate),
            **processing_parts(),
        }
    )


def derive_profiles(bronze: DataFrame, as_of: AsOf = None) -> DataFrame:
    df = bronze.withColumns(
        {
            "client_name_clean": clean_upper("client_name"),
            "email_address_clean": clean_lower("email_address"),
            "advisor_name_clean": clean_upper("advisor_name"),
            "age_group": tier("age", *T.AGE_GROUP_BATCH),
            "income_tier": tier("annual_income", *T.INCOME_TIER_BATCH),
            "net_worth_tier": tier("net_worth", *T.NET_WORTH_TIER_BATCH),
            "portfolio_value_tier": tier("total_portfolio_value", *T.PORTFOLIO_VALUE_TIER),
            "experience_level": tier("investment_experience_years", *T.EXPERIENCE_LEVEL_BATCH),
            "account_type": code_label("account_type_code", *T.ACCOUNT_TYPE_BATCH),
            "account_age_days": days_since("account_open_date", as_of_literal(as_of)),
        }
    )
    return df.withColumns(
        {
            "account_age_years": F.round(F.col("account_age_days") / 365.25, 1),
            "account_open_date_clean": ymd("account_open_date"),
            **processing_parts(),
        }
    )


def derive_kyc(bronze: DataFrame) -> DataFrame:
    return bronze.withColumns(
        {
            "age_group": tier("age", *T.AGE_GROUP_STREAM),
            "income_tier": tier("annual_income", *T.INCOME_TIER_STREAM),
            "net_worth_tier": tier("net_worth", *T.NET_WORTH_TIER_STREAM),
            "experience_level": tier("investment_experience_years", *T.EXPERIENCE_LEVEL_STREAM),
            "kyc_status": code_label("kyc_status_code", *T.KYC_STATUS),
            **processing_parts(date_as_string=False),
        }
    )


def derive_purchases(bronze: DataFrame) -> DataFrame:
    parts = processing_parts(date_as_string=False)
    return bronze.withColumns(
        {
            "age_group": tier("age", *T.AGE_GROUP_STREAM),
            "purchase_tier": tier("purchase_amount", *T.PURCHASE_TIER),
            "processing_date": parts["processing_date"],
            "processing_hour": parts["processing_hour"],
        }
    )


def holdings(bronze: DataFrame, as_of: AsOf = None, share_scale: int = 4) -> DataFrame:
    return quality.enforce(derive_holdings(bronze, as_of, share_scale), quality.HOLDINGS)


def market(bronze: DataFrame) -> DataFrame:
    return quality.enforce(derive_market(bronze), quality.MARKET)


def transactions(bronze: DataFrame) -> DataFrame:
    return quality.enforce(derive_transactions(bronze), quality.TRANSACTIONS)


def profiles(bronze: DataFrame, as_of: AsOf = None) -> DataFrame:
    return quality.enforce(derive_profiles(bronze, as_of), quality.PROFILES)


def kyc(bronze: DataFrame) -> DataFrame:
    return quality.enforce(derive_kyc(bronze), quality.KYC)


def purchases(bronze: DataFrame) -> DataFrame:
    return quality.enforce(derive_purchases(bronze), quality.PURCHASES)
