"""PRJ5 / PRJ6: regex buckets, first matching pattern wins.

``first_letter`` buckets test the leading lower-case letter (``^[...]``);
``contains`` buckets test a substring pattern anywhere in the text. A NULL
input fails every pattern and falls to the default label, as does an upper
case first letter for ``first_letter`` buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Patterns = Sequence[tuple[str, str]]


def regex_bucket(col: Column | str, patterns: Patterns, default: str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    expr = None
    for pattern, label in patterns:
        cond = c.rlike(pattern)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(default) if expr is not None else F.lit(default)


def regex_bucket_sql(col: str, patterns: Patterns, default: str) -> str:
    """Same bucket as DuckDB SQL (``regexp_matches`` is a partial match, like
    ``rlike``)."""
    arms = " ".join(
        f"WHEN regexp_matches({col}, '{p}') THEN '{lbl}'" for p, lbl in patterns
    )
    return f"CASE {arms} ELSE '{default}' END"


# --- fixed values: bucket patterns and labels ---

VOWEL = "^[aeiou]"
LETTERS_B = "^[bcdfg]"
LETTERS_H = "^[hjklm]"
LETTERS_N = "^[npqr]"

ASSET_TYPE = (
    [(VOWEL, "Equity"), (LETTERS_B, "Bond"), (LETTERS_H, "ETF"), (LETTERS_N, "Mutual Fund")],
    "Alternative Investment",
)
EXCHANGE = ([(VOWEL, "NYSE"), (LETTERS_B, "NASDAQ"), (LETTERS_H, "LSE")], "TSE")
TRANSACTION_TYPE = ([(VOWEL, "BUY"), (LETTERS_B, "SELL"), (LETTERS_H, "DIVIDEND")], "REINVEST")
RISK_TOLERANCE = (
    [(VOWEL, "Conservative"), (LETTERS_B, "Moderate"), (LETTERS_H, "Aggressive")],
    "Balanced",
)
PRODUCT_CATEGORY = (
    [
        (VOWEL, "Electronics"),
        (LETTERS_B, "Clothing"),
        (LETTERS_H, "Books"),
        (LETTERS_N, "Home & Garden"),
    ],
    "Sports",
)
SECTOR = (
    [
        ("[Tt]ech", "Technology"),
        ("[Ff]inance", "Financial Services"),
        ("[Hh]ealth", "Healthcare"),
        ("[Ee]nergy", "Energy"),
    ],
    "Consumer Goods",
)
REGION = (
    [("[Uu]nited", "North America"), ("[Gg]ermany", "Europe"), ("[Jj]apan", "Asia")],
    "Other",
)
CURRENCY = ([("@", "USD")], "EUR")
INVESTMENT_STRATEGY = (
    [("[Gg]rowth", "Growth"), ("[Vv]alue", "Value"), ("[Ii]ncome", "Income")],
    "Balanced",
)
EMPLOYMENT_STATUS = (
    [("[Mm]anager", "Employed"), ("[Cc]onsultant", "Self-Employed"), ("[Rr]etired", "Retired")],
    "Unemployed",
)
ACCOUNT_TYPE_STREAM = (
    [("[Ii]ndividual", "Individual"), ("[Jj]oint", "Joint"), ("[Cc]orporate", "Corporate")],
    "Trust",
)

# Allowed values the quality rules check against.
EXCHANGES = ("NYSE", "NASDAQ", "LSE", "TSE")
TRANSACTION_TYPES = ("BUY", "SELL", "DIVIDEND", "REINVEST")
RISK_TOLERANCES = ("Conservative", "Moderate", "Aggressive", "Balanced")
