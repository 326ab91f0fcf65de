"""RA5: ordered-threshold tiers and code lookups as single CASE expressions.

A tier is a list of ``(upper_bound, label)`` cuts tested with ``<`` in order,
plus a default label for everything else (including NULL input, which fails
every comparison). A code map is ``(code, label)`` tested with ``=``.
Each call builds one ``CASE WHEN`` expression, so it stays inside whole-stage
codegen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Cuts = Sequence[tuple[float, str]]


def tier(col: Column | str, cuts: Cuts, default: str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    expr = None
    for bound, label in cuts:
        cond = c < F.lit(bound)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return F.lit(default) if expr is None else expr.otherwise(default)


def code_label(col: Column | str, codes: Sequence[tuple[object, str]], default: str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    expr = None
    for code, label in codes:
        cond = c == F.lit(code)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return F.lit(default) if expr is None else expr.otherwise(default)


def tier_sql(col: str, cuts: Cuts, default: str) -> str:
    """The same tier as ANSI SQL text (used by the SQL oracle)."""
    arms = " ".join(f"WHEN {col} < {_num(b)} THEN '{lbl}'" for b, lbl in cuts)
    return f"CASE {arms} ELSE '{default}' END"


def code_label_sql(col: str, codes: Sequence[tuple[object, str]], default: str) -> str:
    arms = " ".join(f"WHEN {col} = {_lit(c)} THEN '{lbl}'" for c, lbl in codes)
    return f"CASE {arms} ELSE '{default}' END"


def _num(v: float) -> str:
    return str(int(v)) if float(v).is_integer() else repr(v)


def _lit(v: object) -> str:
    return f"'{v}'" if isinstance(v, str) else _num(v)  # type: ignore[arg-type]


# --- fixed values: tier cuts and labels that define the published tables ---

RISK_LEVEL = ([(1, "Low"), (2, "Medium")], "High")
MARKET_CAP_TIER = ([(1e9, "Small Cap"), (1e10, "Mid Cap"), (1e11, "Large Cap")], "Mega Cap")
PE_RATIO_TIER = ([(10, "Low PE"), (20, "Medium PE"), (30, "High PE")], "Very High PE")
DIVIDEND_YIELD_TIER = (
    [(1, "Low Yield"), (3, "Medium Yield"), (5, "High Yield")],
    "Very High Yield",
)
TRANSACTION_CATEGORY = (
    [("BUY", "Purchase"), ("SELL", "Sale"), ("DIVIDEND", "Income")],
    "Reinvestment",
)
TRANSACTION_SIZE_TIER = ([(1000, "Small"), (10000, "Medium"), (100000, "Large")], "Very Large")
AGE_GROUP_BATCH = (
    [(30, "18-29"), (40, "30-39"), (50, "40-49"), (60, "50-59"), (70, "60-69")],
    "70+",
)
INCOME_TIER_BATCH = (
    [
        (50000, "Low Income"),
        (100000, "Medium Income"),
        (200000, "High Income"),
        (500000, "Very High Income"),
    ],
    "Ultra High Income",
)
NET_WORTH_TIER_BATCH = (
    [
        (100000, "Low Net Worth"),
        (500000, "Medium Net Worth"),
        (1000000, "High Net Worth"),
        (5000000, "Very High Net Worth"),
    ],
    "Ultra High Net Worth",
)
PORTFOLIO_VALUE_TIER = (
    [
        (100000, "Small Portfolio"),
        (500000, "Medium Portfolio"),
        (1000000, "Large Portfolio"),
        (5000000, "Very Large Portfolio"),
    ],
    "Ultra Large Portfolio",
)
EXPERIENCE_LEVEL_BATCH = (
    [(2, "Beginner"), (5, "Intermediate"), (10, "Advanced"), (20, "Expert")],
    "Veteran",
)
ACCOUNT_TYPE_BATCH = ([(1, "Individual"), (2, "Joint")], "Corporate")
AGE_GROUP_STREAM = (
    [(25, "18-24"), (35, "25-34"), (45, "35-44"), (55, "45-54"), (65, "55-64")],
    "65+",
)
INCOME_TIER_STREAM = ([(50000, "Low"), (100000, "Medium"), (200000, "High")], "Very High")
NET_WORTH_TIER_STREAM = ([(100000, "Low"), (500000, "Medium"), (1000000, "High")], "Very High")
EXPERIENCE_LEVEL_STREAM = ([(2, "Beginner"), (5, "Intermediate"), (10, "Advanced")], "Expert")
KYC_STATUS = ([(1, "Pending"), (2, "Approved")], "Rejected")
PURCHASE_TIER = ([(50, "Low"), (200, "Medium")], "High")
