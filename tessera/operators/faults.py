"""RA1: reproducible fault injection.

Each rule corrupts a fraction ``p`` of rows of one column, either to NULL or
to a value drawn from a range. Instead of ``rand()`` the choice is a pure
function of a per-row BIGINT key and the rule's salt, so the same rows are hit
in every run, on replay after an executor loss, in a stream and in the SQL
oracle. The arithmetic stays far from BIGINT overflow for any key: the key is
reduced modulo a prime before it is multiplied.

    u    = pmod(pmod(key + salt * 7919, 1000003) * 2654435761, 4294967291)
    hit  = pmod(u, 10000) < round(p * 10000)
    draw = (u div 10000) mod 10000            -- independent digits of u
    int value    = lo + draw mod span
    double value = lo + span * (draw / 10000.0)
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY_PRIME = 1000003
MULTIPLIER = 2654435761
MODULUS = 4294967291
SALT_STEP = 7919


@dataclass(frozen=True)
class Fault:
    column: str
    p: float
    salt: int
    lo: float | None = None  # None -> NULL
    span: float | None = None
    integer: bool = False

    @property
    def threshold(self) -> int:
        return int(round(self.p * 10000))


def _u(key: Column, salt: int) -> Column:
    inner = F.pmod(key + F.lit(salt * SALT_STEP), F.lit(KEY_PRIME))
    return F.pmod(inner * F.lit(MULTIPLIER), F.lit(MODULUS))


def fault_value(fault: Fault, key: Column, dtype: str) -> Column:
    u = _u(key, fault.salt)
    hit = F.pmod(u, F.lit(10000)) < F.lit(fault.threshold)
    if fault.lo is None:
        replacement = F.lit(None).cast(dtype)
    else:
        # u < 2^32, so the double quotient is exact enough for floor().
        draw = F.pmod(F.floor(u / 10000), F.lit(10000))
        if fault.integer:
            replacement = (F.lit(int(fault.lo)) + F.pmod(draw, F.lit(int(fault.span)))).cast(dtype)
        else:
            replacement = (F.lit(float(fault.lo)) + F.lit(float(fault.span)) * (draw / F.lit(10000.0))).cast(
                dtype
            )
    return F.when(hit, replacement).otherwise(F.col(fault.column))


def inject_faults(df: DataFrame, faults: Sequence[Fault], key: str = "_row_key") -> DataFrame:
    """Apply all rules in one projection (no extra stage, no shuffle)."""
    types = dict(df.dtypes)
    k = F.col(key).cast("bigint")
    return df.withColumns({f.column: fault_value(f, k, types[f.column]) for f in faults})


def fault_sql(fault: Fault, key: str, dtype: str) -> str:
    """DuckDB SQL for the same rule (oracle)."""
    def pmod(a: str, m: str) -> str:
        return f"((({a}) % {m}) + {m}) % {m}"

    u = pmod(f"{pmod(f'{key} + {fault.salt * SALT_STEP}', str(KEY_PRIME))} * {MULTIPLIER}", str(MODULUS))
    hit = f"{pmod(u, '10000')} < {fault.threshold}"
    if fault.lo is None:
        rep = f"CAST(NULL AS {dtype})"
    else:
        draw = pmod(f"({u}) // 10000", "10000")
        if fault.integer:
            rep = f"CAST({int(fault.lo)} + {pmod(draw, str(int(fault.span)))} AS {dtype})"
        else:
            rep = f"CAST({float(fault.lo)!r} + {float(fault.span)!r} * (({draw}) / 10000.0) AS {dtype})"
    return f"CASE WHEN {hit} THEN {rep} ELSE {fault.column} END"


# --- fixed values: fault rules (column, probability, replacement range) ---
# Ranges follow the corrupting generator: a double range is [lo, lo + span),
# an integer range is lo .. lo + span - 1; lo None means NULL.

FAULTS: dict[str, list[Fault]] = {
    "holdings": [
        Fault("holding_id", 0.02, 101),
        Fault("client_name", 0.01, 102),
        Fault("quantity", 0.05, 103, -50.0, 100.0),
        Fault("market_value", 0.03, 104, -50000.0, 100000.0),
        Fault("risk_rating", 0.02, 105, 4, 3, integer=True),
        Fault("cost_basis", 0.04, 106, -25000.0, 50000.0),
    ],
    "market": [
        Fault("symbol", 0.01, 201),
        Fault("open_price", 0.03, 202, -100.0, 200.0),
        Fault("high_price", 0.02, 203, -150.0, 300.0),
        Fault("low_price", 0.02, 204, -50.0, 100.0),
        Fault("close_price", 0.02, 205, -125.0, 250.0),
        Fault("pe_ratio", 0.05, 206, -25.0, 50.0),
        Fault("dividend_yield", 0.03, 207, -5.0, 10.0),
    ],
    "transactions": [
        Fault("transaction_id", 0.01, 301),
        Fault("client_name", 0.02, 302),
        Fault("quantity", 0.04, 303, -500.0, 1000.0),
        Fault("price_per_share", 0.03, 304, -100.0, 200.0),
        Fault("total_amount", 0.05, 305, -50000.0, 100000.0),
        Fault("fees", 0.06, 306, -50.0, 100.0),
    ],
    "profiles": [
        Fault("client_id", 0.01, 401),
        Fault("client_name", 0.02, 402),
        Fault("email_address", 0.03, 403),
        Fault("age", 0.05, 404, -9, 19, integer=True),
        Fault("annual_income", 0.04, 405, -100000.0, 200000.0),
        Fault("net_worth", 0.03, 406, -1000000.0, 2000000.0),
        Fault("investment_experience_years", 0.06, 407, -6, 14, integer=True),
        Fault("account_type_code", 0.03, 408, 4, 3, integer=True),
        Fault("total_portfolio_value", 0.04, 409, -500000.0, 1000000.0),
    ],
    "kyc": [
        Fault("customer_id", 0.05, 501),
        Fault("full_name", 0.03, 502),
        Fault("email_address", 0.04, 503),
        Fault("age", 0.08, 504, -9, 19, integer=True),
        Fault("annual_income", 0.06, 505, -10000.0, 50000.0),
        Fault("investment_experience_years", 0.07, 506, -4, 9, integer=True),
        Fault("net_worth", 0.05, 507, -50000.0, 100000.0),
        Fault("kyc_status_code", 0.04, 508, 4, 3, integer=True),
    ],
    "purchases": [],
}
