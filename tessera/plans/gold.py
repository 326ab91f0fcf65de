"""AGG1-AGG20: the published gold tables as data (keys, measures, order).

Single-input tables run as one grouped aggregate. Tables over a join
(AGG1, AGG4, AGG5, AGG6, AGG9) run through ``join_aggregate``, which gives the
same numbers as aggregating the literal many-to-many join without emitting
its pairs. AGG10 aggregates a by-name union of the four silver tables.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.aggregate import (
    Measure,
    avg,
    cd,
    grouped,
    max_,
    min_,
    n,
    sd,
    sum_,
)
from tessera.operators.joins import join_aggregate


@dataclass(frozen=True)
class GoldSpec:
    name: str
    inputs: tuple[str, ...]  # silver table names; two for a join
    keys: tuple[str, ...]
    measures: tuple[Measure, ...]
    order: tuple[str, ...]
    on: tuple[tuple[str, str], ...] = ()
    sides: tuple[str, ...] = ()


def _spec(name, inputs, keys, measures, order, on=(), sides=()) -> GoldSpec:
    return GoldSpec(name, tuple(inputs), tuple(keys), tuple(measures), tuple(order), tuple(on), tuple(sides))


# Integer-typed silver columns that gold tables sum or average (all other
# measured numeric columns are DOUBLE).
INTEGRAL_COLUMNS = frozenset({"volume", "market_cap", "days_held", "age", "investment_experience_years"})

_NAME_JOIN = (("client_name_clean", "client_name_clean"),)
_ASSET_JOIN = (("asset_name_clean", "asset_name_clean"), ("sector", "sector"), ("region", "region"))

# --- fixed values: output column names, keys and rounding of the gold tables ---

SPECS: dict[str, GoldSpec] = {}


def _add(spec: GoldSpec) -> None:
    SPECS[spec.name] = spec


_add(_spec(
    "client_portfolio_performance", ("holdings", "profiles"),
    ["p.age_group", "p.income_tier", "p.net_worth_tier", "p.risk_tolerance", "p.experience_level"],
    [n("total_positions"), cd("unique_clients", "p.client_id"),
     cd("unique_portfolios", "h.portfolio_id"),
     avg("avg_position_value", "h.market_value", 2), sum_("total_portfolio_value", "h.market_value", 2),
     avg("avg_unrealized_gain_loss", "h.unrealized_gain_loss", 2),
     avg("avg_gain_loss_percentage", "h.gain_loss_percentage", 2),
     max_("max_position_value", "h.market_value", 2), min_("min_position_value", "h.market_value", 2),
     sd("position_value_stddev", "h.market_value", 2),
     cd("asset_types_count", "h.asset_type"), cd("sectors_count", "h.sector"),
     cd("regions_count", "h.region")],
    ["age_group", "income_tier", "net_worth_tier", "risk_tolerance"],
    on=_NAME_JOIN, sides=("h", "p"),
))

_add(_spec(
    "asset_allocation_analytics", ("holdings",),
    ["asset_type", "sector", "region", "risk_level"],
    [n("position_count"), cd("unique_clients", "client_name_clean"), cd("unique_portfolios", "portfolio_id"),
     sum_("total_market_value", "market_value", 2), avg("avg_position_value", "market_value", 2),
     sum_("total_cost_basis", "cost_basis", 2), sum_("total_unrealized_gain_loss", "unrealized_gain_loss", 2),
     avg("avg_gain_loss_percentage", "gain_loss_percentage", 2),
     max_("max_position_value", "market_value", 2), min_("min_position_value", "market_value", 2),
     sd("position_value_stddev", "market_value", 2), sum_("total_quantity", "quantity", 2),
     avg("avg_days_held", "days_held", 1)],
    ["asset_type", "sector", "region", "risk_level"],
))

_add(_spec(
    "market_performance_analytics", ("market",),
    ["sector", "region", "market_cap_tier", "pe_ratio_tier", "dividend_yield_tier"],
    [n("trading_days_count"), cd("unique_symbols", "symbol_clean"),
     avg("avg_daily_return", "daily_return", 4), max_("max_daily_return", "daily_return", 4),
     min_("min_daily_return", "daily_return", 4), sd("daily_return_stddev", "daily_return", 4),
     avg("avg_price_range_percentage", "price_range_percentage", 2),
     avg("avg_volume", "volume", 0), sum_("total_volume", "volume", 0),
     avg("avg_market_cap", "market_cap", 0), avg("avg_pe_ratio", "pe_ratio", 2),
     avg("avg_dividend_yield", "dividend_yield", 2),
     max_("max_close_price", "close_price", 2), min_("min_close_price", "close_price", 2)],
    ["sector", "region", "market_cap_tier"],
))

_add(_spec(
    "client_transaction_analytics", ("transactions", "profiles"),
    ["t.transaction_type", "t.transaction_category", "t.transaction_size_tier",
     "p.age_group", "p.income_tier", "p.risk_tolerance"],
    [n("transaction_count"), cd("unique_clients", "p.client_id"), cd("unique_portfolios", "t.portfolio_id"),
     sum_("total_transaction_amount", "t.total_amount", 2), avg("avg_transaction_amount", "t.total_amount", 2),
     sum_("total_fees", "t.fees", 2), avg("avg_fees", "t.fees", 2),
     avg("avg_fee_percentage", "t.fee_percentage", 4),
     sum_("total_amount_after_fees", "t.transaction_amount_after_fees", 2),
     max_("max_transaction_amount", "t.total_amount", 2), min_("min_transaction_amount", "t.total_amount", 2),
     sd("transaction_amount_stddev", "t.total_amount", 2),
     cd("unique_assets", "t.asset_symbol_clean"), cd("unique_advisors", "t.advisor_name_clean"),
     cd("sectors_count", "t.sector")],
    ["transaction_type", "transaction_category", "transaction_size_tier"],
    on=_NAME_JOIN, sides=("t", "p"),
))

_add(_spec(
    "advisor_performance_analytics", ("transactions", "profiles"),
    ["t.advisor_name_clean", "p.age_group", "p.income_tier", "p.net_worth_tier"],
    [n("total_transactions"), cd("unique_clients", "p.client_id"), cd("unique_portfolios", "t.portfolio_id"),
     sum_("total_transaction_volume", "t.total_amount", 2), avg("avg_transaction_amount", "t.total_amount", 2),
     sum_("total_fees_generated", "t.fees", 2), avg("avg_fees_per_transaction", "t.fees", 2),
     avg("avg_fee_percentage", "t.fee_percentage", 4),
     cd("unique_assets_traded", "t.asset_symbol_clean"), cd("transaction_types_count", "t.transaction_type"),
     cd("sectors_traded_count", "t.sector"),
     max_("max_transaction_amount", "t.total_amount", 2), min_("min_transaction_amount", "t.total_amount", 2)],
    ["advisor_name_clean", "age_group", "income_tier"],
    on=_NAME_JOIN, sides=("t", "p"),
))

_add(_spec(
    "risk_analytics", ("holdings", "profiles"),
    ["p.risk_tolerance", "h.risk_level", "p.age_group", "p.experience_level"],
    [n("position_count"), cd("unique_clients", "p.client_id"), cd("unique_portfolios", "h.portfolio_id"),
     sum_("total_portfolio_value", "h.market_value", 2), avg("avg_position_value", "h.market_value", 2),
     sum_("total_unrealized_gain_loss", "h.unrealized_gain_loss", 2),
     avg("avg_gain_loss_percentage", "h.gain_loss_percentage", 2),
     max_("max_gain_percentage", "h.gain_loss_percentage", 2),
     min_("min_gain_percentage", "h.gain_loss_percentage", 2),
     sd("gain_loss_volatility", "h.gain_loss_percentage", 2),
     cd("asset_types_count", "h.asset_type"), cd("sectors_count", "h.sector"), cd("regions_count", "h.region"),
     avg("avg_days_held", "h.days_held", 1)],
    ["risk_tolerance", "risk_level", "age_group"],
    on=_NAME_JOIN, sides=("h", "p"),
))

_add(_spec(
    "monthly_portfolio_trends", ("holdings",),
    ["processing_year", "processing_month", "asset_type", "sector"],
    [n("position_count"), cd("unique_clients", "client_name_clean"), cd("unique_portfolios", "portfolio_id"),
     sum_("total_market_value", "market_value", 2), avg("avg_position_value", "market_value", 2),
     sum_("total_unrealized_gain_loss", "unrealized_gain_loss", 2),
     avg("avg_gain_loss_percentage", "gain_loss_percentage", 2),
     max_("max_position_value", "market_value", 2), min_("min_position_value", "market_value", 2),
     sd("position_value_stddev", "market_value", 2), sum_("total_quantity", "quantity", 2),
     avg("avg_days_held", "days_held", 1)],
    ["processing_year", "processing_month", "asset_type", "sector"],
))

_add(_spec(
    "client_acquisition_retention", ("profiles",),
    ["age_group", "income_tier", "net_worth_tier", "employment_status", "experience_level"],
    [n("total_clients"), cd("unique_advisors", "advisor_name_clean"),
     avg("avg_portfolio_value", "total_portfolio_value", 2), sum_("total_portfolio_value", "total_portfolio_value", 2),
     avg("avg_annual_income", "annual_income", 2), sum_("total_annual_income", "annual_income", 2),
     avg("avg_net_worth", "net_worth", 2), sum_("total_net_worth", "net_worth", 2),
     avg("avg_experience_years", "investment_experience_years", 1),
     avg("avg_account_age_years", "account_age_years", 1),
     max_("max_account_age_years", "account_age_years", 1),
     min_("min_account_age_years", "account_age_years", 1),
     cd("account_types_count", "account_type"), cd("risk_tolerances_count", "risk_tolerance")],
    ["age_group", "income_tier", "net_worth_tier"],
))

_add(_spec(
    "sector_region_performance", ("holdings", "market"),
    ["h.sector", "h.region", "m.market_cap_tier"],
    [n("position_count"), cd("unique_clients", "h.client_name_clean"), cd("unique_portfolios", "h.portfolio_id"),
     sum_("total_market_value", "h.market_value", 2), avg("avg_position_value", "h.market_value", 2),
     sum_("total_unrealized_gain_loss", "h.unrealized_gain_loss", 2),
     avg("avg_gain_loss_percentage", "h.gain_loss_percentage", 2),
     avg("avg_daily_return", "m.daily_return", 4), sd("daily_return_volatility", "m.daily_return", 4),
     avg("avg_pe_ratio", "m.pe_ratio", 2), avg("avg_dividend_yield", "m.dividend_yield", 2),
     avg("avg_market_cap", "m.market_cap", 0), avg("avg_volume", "m.volume", 0),
     avg("avg_days_held", "h.days_held", 1)],
    ["sector", "region", "market_cap_tier"],
    on=_ASSET_JOIN, sides=("h", "m"),
))

_add(_spec(
    "processing_metrics", ("holdings", "market", "transactions", "profiles"),
    ["source_table", "processing_date", "processing_hour"],
    [n("records_processed"), cd("processing_batches", "processing_timestamp"),
     max_("latest_processing_timestamp", "processing_timestamp"),
     min_("earliest_processing_timestamp", "processing_timestamp")],
    ["source_table", "processing_date", "processing_hour"],
))

_KYC_COMMON = [
    avg("avg_annual_income", "annual_income", 2), avg("avg_net_worth", "net_worth", 2),
    avg("avg_experience_years", "investment_experience_years", 1),
]

_add(_spec(
    "customer_demographics", ("kyc",), ["age_group", "country", "city"],
    [n("customer_count"), avg("avg_age", "age", 1), *_KYC_COMMON, cd("risk_profiles_count", "risk_profile")],
    ["country", "city", "age_group"],
))
_add(_spec(
    "risk_experience_analytics", ("kyc",), ["risk_profile", "experience_level"],
    [n("customer_count"), *_KYC_COMMON, cd("unique_customers", "customer_id"),
     cd("account_types_count", "account_type")],
    ["risk_profile", "experience_level"],
))
_add(_spec(
    "wealth_analytics", ("kyc",), ["income_tier", "net_worth_tier"],
    [n("customer_count"), *_KYC_COMMON, cd("unique_customers", "customer_id"),
     cd("risk_profiles_count", "risk_profile")],
    ["income_tier", "net_worth_tier"],
))
_add(_spec(
    "kyc_account_analytics", ("kyc",), ["kyc_status", "account_type"],
    [n("customer_count"), *_KYC_COMMON, cd("unique_customers", "customer_id"),
     cd("employment_statuses_count", "employment_status")],
    ["kyc_status", "account_type"],
))
_add(_spec(
    "employment_analytics", ("kyc",), ["employment_status"],
    [n("customer_count"), *_KYC_COMMON, cd("unique_customers", "customer_id"),
     cd("risk_profiles_count", "risk_profile"), cd("account_types_count", "account_type")],
    ["employment_status"],
))
_add(_spec(
    "realtime_kyc_metrics", ("kyc",), ["processing_date", "processing_hour"],
    [n("kyc_records_processed"), cd("unique_customers", "customer_id"), cd("countries_count", "country"),
     cd("risk_profiles_count", "risk_profile"), cd("account_types_count", "account_type"),
     cd("employment_statuses_count", "employment_status"), *_KYC_COMMON,
     cd("kyc_statuses_count", "kyc_status")],
    ["processing_date", "processing_hour"],
))
_add(_spec(
    "monthly_kyc_trends", ("kyc",), ["processing_year", "processing_month"],
    [n("kyc_records_processed"), cd("unique_customers", "customer_id"), cd("countries_count", "country"),
     cd("risk_profiles_count", "risk_profile"), cd("account_types_count", "account_type"),
     cd("employment_statuses_count", "employment_status"), *_KYC_COMMON,
     max_("max_annual_income", "annual_income", 2), min_("min_annual_income", "annual_income", 2),
     max_("max_net_worth", "net_worth", 2), min_("min_net_worth", "net_worth", 2)],
    ["processing_year", "processing_month"],
))
_add(_spec(
    "purchase_demographics", ("purchases",), ["age_group", "country", "city"],
    [n("customer_count"), avg("avg_age", "age", 1), avg("avg_purchase_amount", "purchase_amount", 2),
     sum_("total_revenue", "purchase_amount", 2)],
    ["country", "city", "age_group"],
))
_add(_spec(
    "purchase_analytics", ("purchases",), ["product_category", "purchase_tier"],
    [n("transaction_count"), avg("avg_purchase_amount", "purchase_amount", 2),
     sum_("total_revenue", "purchase_amount", 2), cd("unique_customers", "customer_id")],
    ["product_category", "purchase_tier"],
))
_add(_spec(
    "realtime_metrics", ("purchases",), ["processing_date", "processing_hour"],
    [n("records_processed"), cd("unique_customers", "customer_id"), cd("countries_count", "country"),
     cd("categories_count", "product_category"), sum_("hourly_revenue", "purchase_amount", 2),
     avg("avg_purchase_amount", "purchase_amount", 2)],
    ["processing_date", "processing_hour"],
))


def undated(feed: str) -> list[GoldSpec]:
    """Specs over ``feed`` alone whose keys hold no processing date."""
    return [s for s in SPECS.values() if s.inputs == (feed,) and "processing_date" not in s.keys]


def build_order(names=None) -> list[str]:
    """Gold tables in submission order for concurrent builds: join tables
    (the longest jobs) first, so the tail of a layer is short."""
    names = list(names or SPECS)
    return sorted(names, key=lambda n: (len(SPECS[n].inputs) < 2, -len(SPECS[n].on), names.index(n)))


# Source tags of the processing-metrics union (UN1), in union order.
SOURCE_TAGS = (
    ("holdings", "portfolio_holdings"),
    ("market", "market_data"),
    ("transactions", "client_transactions"),
    ("profiles", "client_profiles"),
)


def tagged_union(silver: dict[str, DataFrame]) -> DataFrame:
    """UN1: tag each silver table and union by name, missing columns NULL.
    Only the columns the metrics read survive column pruning."""
    frames = [silver[t].withColumn("source_table", F.lit(tag)) for t, tag in SOURCE_TAGS]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def build(
    name: str, silver: dict[str, DataFrame], ordered: bool = True, join_strategy: str = "auto"
) -> DataFrame:
    spec = SPECS[name]
    order: Sequence[str] | None = spec.order if ordered else None
    if name == "processing_metrics":
        return grouped(tagged_union(silver), spec.keys, spec.measures, order)
    if len(spec.inputs) == 1:
        return grouped(silver[spec.inputs[0]], spec.keys, spec.measures, order)
    left, right = (silver[t] for t in spec.inputs)
    return join_aggregate(
        left, right, spec.on, spec.keys, spec.measures,
        sides=(spec.sides[0], spec.sides[1]), order=order, strategy=join_strategy,
    )
