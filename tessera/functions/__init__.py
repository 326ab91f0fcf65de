"""Scalar column builders: tiers, regex buckets, date parts, cleaning."""

from tessera.functions.buckets import regex_bucket, regex_bucket_sql
from tessera.functions.columns import (
    as_of_literal,
    clean_lower,
    clean_upper,
    days_since,
    guarded_pct,
    processing_parts,
    ymd,
)
from tessera.functions.tiers import code_label, code_label_sql, tier, tier_sql

__all__ = [
    "as_of_literal",
    "clean_lower",
    "clean_upper",
    "code_label",
    "code_label_sql",
    "days_since",
    "guarded_pct",
    "processing_parts",
    "regex_bucket",
    "regex_bucket_sql",
    "tier",
    "tier_sql",
    "ymd",
]
