"""Column functions shared by all models."""

from provwatch.functions.categories import code_lookup, ladder, order_index, tier
from provwatch.functions.numeric import (
    flag_count,
    pct_change,
    percentage,
    percentage_or_zero,
    quotient,
    ratio,
    ratio_or_null,
    ratio_or_zero,
    round_half_away,
)
from provwatch.functions.parsing import (
    COMPACT_DATE,
    ISO_DATE,
    US_DATE,
    try_count,
    try_date,
    try_money,
    try_number,
    try_percent,
)
from provwatch.functions.text import clean, concat_strict, describe, present, surrogate_key

__all__ = [
    "COMPACT_DATE",
    "ISO_DATE",
    "US_DATE",
    "clean",
    "code_lookup",
    "concat_strict",
    "describe",
    "flag_count",
    "ladder",
    "order_index",
    "pct_change",
    "percentage",
    "percentage_or_zero",
    "present",
    "quotient",
    "ratio",
    "ratio_or_null",
    "ratio_or_zero",
    "round_half_away",
    "surrogate_key",
    "tier",
    "try_count",
    "try_date",
    "try_money",
    "try_number",
    "try_percent",
]
