"""Reference SQL for every registered query, written for DuckDB.

The SQL restates each table in its literal relational form (for example the
gold join tables aggregate over the materialised many-to-many join), so it
checks the Spark plans, including the pair-free join aggregation, by brute
force on the same parquet tables. Fixed values (tier cuts, bucket patterns,
rule predicates, fault parameters) are rendered from the same tables the
library uses.
"""

from __future__ import annotations

from tessera.functions import buckets as B
from tessera.functions import tiers as T
from tessera.functions.buckets import regex_bucket_sql as bucket
from tessera.functions.tiers import code_label_sql as code
from tessera.functions.tiers import tier_sql as tier
from tessera.operators import quality
from tessera.operators.aggregate import avg, measure_sql
from tessera.operators.faults import FAULTS, fault_sql
from tessera.plans import gold
from tessera.sources import adapters, schemas

BATCH_AS_OF = "2002-01-01"
EVENTS_AS_OF = "2024-02-01"
SHARE_SCALE_QUERY = 8

_DUCK_TYPES = {
    "StringType()": "VARCHAR",
    "IntegerType()": "INTEGER",
    "LongType()": "BIGINT",
    "DoubleType()": "DOUBLE",
    "TimestampNTZType()": "TIMESTAMP",
}


def _duck_type(table: str, col: str) -> str:
    for f in schemas.BRONZE[table].fields:
        if f.name == col:
            return _DUCK_TYPES[repr(f.dataType)]
    raise KeyError(col)


def R(expr: str, k: int) -> str:
    """Spark's ``round`` on a DOUBLE: HALF_UP on the shortest decimal form
    of the value (``round(1.005, 2)`` is 1.01), where DuckDB's own ``round``
    works on the binary value (1.0)."""
    return f"CAST(round(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38,16)), {k}) AS DOUBLE)"


def _i(expr: str) -> str:
    return f"CAST({expr} AS INTEGER)"


# --- adapters (RA2) ---------------------------------------------------------

_CUSTOMER_GEO = """
    SELECT c.c_custkey, c.c_name, r.r_name AS c_region
    FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
    JOIN region r ON n.n_regionkey = r.r_regionkey"""

_SUPPLIER_GEO = """
    SELECT s.s_suppkey, s.s_name, r.r_regionkey, r.r_name AS s_region
    FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
    JOIN region r ON n.n_regionkey = r.r_regionkey"""


def adapted_sql(table: str) -> str:
    if table == "holdings":
        return f"""
SELECT CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS holding_id,
  cg.c_name AS client_name,
  p.p_name || ' #' || CAST(p.p_partkey AS VARCHAR) AS asset_name,
  l.l_quantity AS quantity, l.l_extendedprice AS market_value, l.l_shipdate AS valuation_date,
  {bucket('p.p_name', *B.ASSET_TYPE)} AS asset_type,
  {_i('cg.c_custkey % 1000 + 1000')} AS account_id,
  {_i('l.l_orderkey % 500 + 500')} AS portfolio_id,
  p.p_type AS sector, cg.c_region AS region,
  {_i('l.l_linenumber % 3 + 1')} AS risk_rating,
  CASE WHEN l.l_linestatus = 'O' THEN 'USD' ELSE 'EUR' END AS currency,
  {bucket('p.p_type', *B.INVESTMENT_STRATEGY)} AS investment_strategy,
  l.l_quantity * p.p_retailprice AS cost_basis,
  l.l_shipdate AS processing_timestamp,
  l.l_orderkey * 8 + l.l_linenumber AS _row_key
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN ({_CUSTOMER_GEO}) cg ON o.o_custkey = cg.c_custkey
JOIN part p ON l.l_partkey = p.p_partkey"""
    if table == "market":
        return f"""
SELECT p.p_brand AS symbol, p.p_name || ' #' || CAST(p.p_partkey AS VARCHAR) AS asset_name,
  b.open_price, b.high_price, b.low_price, b.close_price, b.volume, b.trade_date,
  {bucket('p.p_name', *B.EXCHANGE)} AS exchange,
  p.p_type AS sector, b.s_region AS region,
  CAST(round(p.p_retailprice * 100) AS BIGINT) * 10000 * (p.p_partkey % 1000 + 1) AS market_cap,
  CAST(p.p_size AS DOUBLE) AS pe_ratio, b.dividend_yield, 'USD' AS currency,
  b.trade_date AS processing_timestamp,
  CAST((p.p_partkey * 8 + b.r_regionkey) * 100000 + b.ship_year * 12 + b.ship_month AS BIGINT) AS _row_key
FROM (
  SELECT l.l_partkey, sg.r_regionkey, sg.s_region, year(l.l_shipdate) AS ship_year,
    month(l.l_shipdate) AS ship_month,
    arg_min(l.l_extendedprice / l.l_quantity,
            (l.l_shipdate, l.l_orderkey, l.l_linenumber, l.l_extendedprice, l.l_quantity)) AS open_price,
    max(l.l_extendedprice / l.l_quantity) AS high_price,
    min(l.l_extendedprice / l.l_quantity) AS low_price,
    arg_max(l.l_extendedprice / l.l_quantity,
            (l.l_shipdate, l.l_orderkey, l.l_linenumber, l.l_extendedprice, l.l_quantity)) AS close_price,
    CAST(sum(l.l_quantity) AS INTEGER) AS volume,
    sum(CAST(round(l.l_discount * 100) AS BIGINT)) / count(*) AS dividend_yield,
    max(l.l_shipdate) AS trade_date
  FROM lineitem l JOIN ({_SUPPLIER_GEO}) sg ON l.l_suppkey = sg.s_suppkey
  GROUP BY 1, 2, 3, 4, 5
) b JOIN part p ON b.l_partkey = p.p_partkey"""
    if table == "transactions":
        return f"""
SELECT CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS transaction_id,
  cg.c_name AS client_name,
  {_i('cg.c_custkey % 1000 + 1000')} AS account_id,
  p.p_brand AS asset_symbol,
  CASE WHEN l.l_returnflag = 'N' AND l.l_linestatus = 'O' THEN 'BUY'
       WHEN l.l_returnflag = 'R' THEN 'SELL'
       WHEN l.l_returnflag = 'A' THEN 'DIVIDEND' ELSE 'REINVEST' END AS transaction_type,
  l.l_quantity AS quantity, l.l_extendedprice / l.l_quantity AS price_per_share,
  l.l_extendedprice AS total_amount, o.o_orderdate AS transaction_date,
  {_i('o.o_custkey % 500 + 500')} AS portfolio_id,
  p.p_type AS sector, cg.c_region AS region,
  l.l_extendedprice * l.l_tax AS fees,
  CASE WHEN l.l_linestatus = 'O' THEN 'USD' ELSE 'EUR' END AS currency,
  s.s_name AS advisor_name, l.l_shipdate AS processing_timestamp,
  l.l_orderkey * 8 + l.l_linenumber AS _row_key
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN ({_CUSTOMER_GEO}) cg ON o.o_custkey = cg.c_custkey
JOIN part p ON l.l_partkey = p.p_partkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey"""
    if table == "profiles":
        return f"""
SELECT CAST(c.c_custkey AS VARCHAR) AS client_id, c.c_name AS client_name,
  lower(replace(c.c_name, '#', '')) || '@example.com' AS email_address,
  {_i('c.c_custkey % 63 + 18')} AS age,
  'City ' || CAST(c.c_custkey % 50 AS VARCHAR) AS city, n.n_name AS country,
  c.c_acctbal * 60 AS annual_income, c.c_acctbal * 700 AS net_worth,
  {bucket('lower(c.c_mktsegment)', *B.RISK_TOLERANCE)} AS risk_tolerance,
  oc.first_order AS account_open_date,
  {_i('c.c_custkey % 30 + 1')} AS investment_experience_years,
  {bucket('c.c_mktsegment', *B.EMPLOYMENT_STATUS)} AS employment_status,
  {_i('c.c_custkey % 3 + 1')} AS account_type_code,
  n.n_name AS advisor_name, oc.order_total AS total_portfolio_value,
  oc.first_order AS processing_timestamp, CAST(c.c_custkey AS BIGINT) AS _row_key
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN (
  SELECT o_custkey, min(o_orderdate) AS first_order,
    sum(CAST(round(o_totalprice * 100) AS BIGINT)) / 100.0 AS order_total
  FROM orders GROUP BY o_custkey
) oc ON c.c_custkey = oc.o_custkey"""
    if table == "kyc":
        return f"""
SELECT CAST(user_id AS VARCHAR) AS customer_id, 'Client ' || CAST(user_id AS VARCHAR) AS full_name,
  'client' || CAST(user_id AS VARCHAR) || '@example.com' AS email_address,
  {_i('user_id % 63 + 18')} AS age, 'City ' || CAST(user_id % 20 AS VARCHAR) AS city,
  'C' || CAST(user_id % 5 AS VARCHAR) AS country, value * 1000 AS annual_income,
  {bucket('event_type', *B.RISK_TOLERANCE)} AS risk_profile, ts AS kyc_timestamp,
  {_i('user_id % 21')} AS investment_experience_years,
  {code('event_type', *adapters.EVENT_EMPLOYMENT)} AS employment_status,
  value * 5000 AS net_worth,
  {code('user_id % 4', *adapters.USER_ACCOUNT_TYPE)} AS account_type,
  {_i('event_id % 3 + 1')} AS kyc_status_code, ts AS processing_timestamp,
  event_id AS _row_key
FROM events"""
    if table == "purchases":
        return f"""
SELECT CAST(user_id AS VARCHAR) AS customer_id, 'Client ' || CAST(user_id AS VARCHAR) AS name,
  'client' || CAST(user_id AS VARCHAR) || '@example.com' AS email,
  {_i('user_id % 63 + 18')} AS age, 'City ' || CAST(user_id % 20 AS VARCHAR) AS city,
  'C' || CAST(user_id % 5 AS VARCHAR) AS country, value AS purchase_amount,
  {bucket('event_type', *B.PRODUCT_CATEGORY)} AS product_category,
  ts AS "timestamp", ts AS processing_timestamp, event_id AS _row_key
FROM events"""
    raise KeyError(table)


def bronze_sql(table: str, faults: bool = True) -> str:
    cols = adapters.bronze_columns(table)
    rules = {f.column: f for f in FAULTS[table]} if faults else {}
    sel = []
    for c in cols:
        qc = f'"{c}"'
        if c in rules:
            sel.append(f"{fault_sql(rules[c], '_row_key', _duck_type(table, c))} AS {qc}")
        else:
            sel.append(qc)
    return f"SELECT {', '.join(sel)} FROM ({adapted_sql(table)}) a"


# --- silver -------------------------------------------------------------------

def _ymd(col: str) -> str:
    return f"strftime({col}, '%Y-%m-%d')"


def _days_since(col: str, as_of: str) -> str:
    return (f"CASE WHEN {col} IS NOT NULL THEN "
            f"CAST(date_diff('day', CAST({col} AS DATE), DATE '{as_of}') AS INTEGER) ELSE 0 END")


def _parts(ts: str = "processing_timestamp", date_as_string: bool = True) -> str:
    d = _ymd(ts) if date_as_string else f"CAST({ts} AS DATE)"
    return (f"{d} AS processing_date, {_i(f'hour({ts})')} AS processing_hour, "
            f"{_i(f'dayofweek({ts}) + 1')} AS processing_day_of_week, "
            f"{_i(f'month({ts})')} AS processing_month, {_i(f'year({ts})')} AS processing_year")


def _pct(num: str, den: str, guard: str, scale: int) -> str:
    return f"CASE WHEN {guard} > 0 THEN {R(f'({num}) / {den} * 100', scale)} ELSE 0.0 END"


def derived_sql(table: str, share_scale: int = 4) -> str:
    b = bronze_sql(table)
    if table == "holdings":
        return f"""
WITH b AS ({b})
SELECT b.*, trim(upper(client_name)) AS client_name_clean, trim(upper(asset_name)) AS asset_name_clean,
  market_value - cost_basis AS unrealized_gain_loss,
  {_pct('market_value - cost_basis', 'cost_basis', 'cost_basis', 2)} AS gain_loss_percentage,
  {R('market_value / sum(market_value) OVER ()', share_scale)} AS position_size_percentage,
  {code('risk_rating', *T.RISK_LEVEL)} AS risk_level,
  {_ymd('valuation_date')} AS valuation_date_clean,
  {_days_since('valuation_date', BATCH_AS_OF)} AS days_held,
  {_parts()}
FROM b"""
    if table == "market":
        return f"""
WITH b AS ({b})
SELECT b.*, trim(upper(symbol)) AS symbol_clean, trim(upper(asset_name)) AS asset_name_clean,
  {_pct('close_price - open_price', 'open_price', 'open_price', 4)} AS daily_return,
  high_price - low_price AS price_range,
  {_pct('high_price - low_price', 'low_price', 'low_price', 2)} AS price_range_percentage,
  {R('(high_price + low_price + close_price) / 3', 2)} AS volume_weighted_price,
  {tier('market_cap', *T.MARKET_CAP_TIER)} AS market_cap_tier,
  {tier('pe_ratio', *T.PE_RATIO_TIER)} AS pe_ratio_tier,
  {tier('dividend_yield', *T.DIVIDEND_YIELD_TIER)} AS dividend_yield_tier,
  {_ymd('trade_date')} AS trade_date_clean,
  {_parts()}
FROM b"""
    if table == "transactions":
        return f"""
WITH b AS ({b})
SELECT b.*, trim(upper(client_name)) AS client_name_clean,
  trim(upper(asset_symbol)) AS asset_symbol_clean, trim(upper(advisor_name)) AS advisor_name_clean,
  total_amount - fees AS transaction_amount_after_fees,
  {_pct('fees', 'total_amount', 'total_amount', 4)} AS fee_percentage,
  {code('transaction_type', *T.TRANSACTION_CATEGORY)} AS transaction_category,
  {tier('total_amount', *T.TRANSACTION_SIZE_TIER)} AS transaction_size_tier,
  {_ymd('transaction_date')} AS transaction_date_clean,
  {_i('month(transaction_date)')} AS transaction_month,
  {_i('year(transaction_date)')} AS transaction_year,
  {_i('dayofweek(transaction_date) + 1')} AS transaction_day_of_week,
  {_parts()}
FROM b"""
    if table == "profiles":
        return f"""
WITH b AS ({b}), d AS (
SELECT b.*, trim(upper(client_name)) AS client_name_clean,
  trim(lower(email_address)) AS email_address_clean, trim(upper(advisor_name)) AS advisor_name_clean,
  {tier('age', *T.AGE_GROUP_BATCH)} AS age_group,
  {tier('annual_income', *T.INCOME_TIER_BATCH)} AS income_tier,
  {tier('net_worth', *T.NET_WORTH_TIER_BATCH)} AS net_worth_tier,
  {tier('total_portfolio_value', *T.PORTFOLIO_VALUE_TIER)} AS portfolio_value_tier,
  {tier('investment_experience_years', *T.EXPERIENCE_LEVEL_BATCH)} AS experience_level,
  {code('account_type_code', *T.ACCOUNT_TYPE_BATCH)} AS account_type,
  {_days_since('account_open_date', BATCH_AS_OF)} AS account_age_days
FROM b)
SELECT d.*, {R('account_age_days / 365.25', 1)} AS account_age_years,
  {_ymd('account_open_date')} AS account_open_date_clean, {_parts()}
FROM d"""
    if table == "kyc":
        return f"""
WITH b AS ({b})
SELECT b.*, {tier('age', *T.AGE_GROUP_STREAM)} AS age_group,
  {tier('annual_income', *T.INCOME_TIER_STREAM)} AS income_tier,
  {tier('net_worth', *T.NET_WORTH_TIER_STREAM)} AS net_worth_tier,
  {tier('investment_experience_years', *T.EXPERIENCE_LEVEL_STREAM)} AS experience_level,
  {code('kyc_status_code', *T.KYC_STATUS)} AS kyc_status,
  {_parts(date_as_string=False)}
FROM b"""
    if table == "purchases":
        return f"""
WITH b AS ({b})
SELECT b.*, {tier('age', *T.AGE_GROUP_STREAM)} AS age_group,
  {tier('purchase_amount', *T.PURCHASE_TIER)} AS purchase_tier,
  CAST(processing_timestamp AS DATE) AS processing_date,
  {_i('hour(processing_timestamp)')} AS processing_hour
FROM b"""
    raise KeyError(table)


def _keep(table: str) -> str:
    return " AND ".join(f"({r.predicate})" for r in quality.RULES[table] if r.action in ("drop", "filter"))


def silver_sql(table: str) -> str:
    return f"SELECT * FROM ({derived_sql(table)}) d WHERE {_keep(table)}"


# --- gold -------------------------------------------------------------------------

_SUM_INT = {("market_performance_analytics", "total_volume")}


def gold_sql(name: str) -> str:
    spec = gold.SPECS[name]
    keys = ", ".join(spec.keys)
    meas = []
    for m in spec.measures:
        text = measure_sql(m, R, gold.INTEGRAL_COLUMNS)
        if (name, m.name) in _SUM_INT:
            text = f"CAST({text.rsplit(' AS ', 1)[0]} AS BIGINT) AS {m.name}"
        meas.append(text)
    body = ", ".join(meas)
    if name == "processing_metrics":
        parts = " UNION ALL ".join(
            f"SELECT '{tag}' AS source_table, processing_date, processing_hour, processing_timestamp "
            f"FROM ({silver_sql(t)}) s{i}"
            for i, (t, tag) in enumerate(gold.SOURCE_TAGS)
        )
        return f"SELECT {keys}, {body} FROM ({parts}) u GROUP BY {keys}"
    if len(spec.inputs) == 1:
        return f"SELECT {keys}, {body} FROM ({silver_sql(spec.inputs[0])}) s GROUP BY {keys}"
    (lt, rt), (la, ra) = spec.inputs, spec.sides
    cond = " AND ".join(f"{la}.{a} = {ra}.{b}" for a, b in spec.on)
    return (f"SELECT {keys}, {body} FROM ({silver_sql(lt)}) {la} "
            f"JOIN ({silver_sql(rt)}) {ra} ON {cond} GROUP BY {keys}")


def hourly_sql() -> str:
    """Exact hourly KYC metrics, written out by hand."""
    return (
        "SELECT date_trunc('hour', kyc_timestamp::TIMESTAMP) AS window_start, count(*) AS kyc_records_processed, "
        "count(DISTINCT customer_id) AS unique_customers, "
        f"{measure_sql(avg('avg_annual_income', 'annual_income', 2), R)}, "
        f"{measure_sql(avg('avg_net_worth', 'net_worth', 2), R)} "
        f"FROM ({silver_sql('kyc')}) s GROUP BY 1"
    )


# --- quality ----------------------------------------------------------------------

def quality_report_sql() -> str:
    parts = []
    for t in ("holdings", "market", "transactions", "profiles", "kyc", "purchases"):
        for r in quality.RULES[t]:
            parts.append(
                f"SELECT '{t}' AS table_name, '{r.name}' AS rule, '{r.action}' AS action, "
                f"CAST(count(*) AS BIGINT) AS total_count, "
                f"CAST(count_if(NOT coalesce({r.predicate}, false)) AS BIGINT) AS failed_count "
                f"FROM ({derived_sql(t)}) d"
            )
    return " UNION ALL ".join(parts)


def quarantine_sql(table: str) -> str:
    arms = ", ".join(
        f"CASE WHEN NOT coalesce({r.predicate}, false) THEN '{r.name}' END"
        for r in quality.RULES[table] if r.action in ("drop", "filter")
    )
    return (f"SELECT * FROM (SELECT d.*, concat_ws(',', {arms}) AS failed_rules "
            f"FROM ({derived_sql(table)}) d) q WHERE failed_rules <> ''")


def position_share_sql() -> str:
    share = R("market_value / sum(market_value) OVER ()", SHARE_SCALE_QUERY)
    return (f"SELECT holding_id, market_value, {share} AS position_size_percentage "
            f"FROM ({bronze_sql('holdings')}) b")
