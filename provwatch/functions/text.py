"""Text cleaning, NULL-propagating concatenation and surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Placeholder that stands for NULL inside a hashed key (fixed value).
NULL_KEY_PART = "_dbt_utils_surrogate_key_null_"


def clean(text: Column) -> Column:
    return F.upper(F.trim(text))


def concat_strict(separator: str, *parts: Column) -> Column:
    """Join parts with a separator; NULL if any part is NULL (``F.concat_ws`` would skip it)."""
    pieces: list[Column] = []
    for part in parts:
        if pieces:
            pieces.append(F.lit(separator))
        pieces.append(part)
    return F.concat(*pieces)


def describe(template: str, *values: Column) -> Column:
    """Fill ``{}`` slots of a template with values cast to string; NULL if any value is NULL."""
    fragments = template.split("{}")
    if len(fragments) != len(values) + 1:
        raise ValueError(f"{len(values)} values for {len(fragments) - 1} slots in {template!r}")
    pieces = [F.lit(fragments[0])]
    for value, fragment in zip(values, fragments[1:]):
        pieces += [value.cast("string"), F.lit(fragment)]
    return F.concat(*pieces)


def surrogate_key(*parts: Column) -> Column:
    """MD5 over the parts joined by ``-``, NULL replaced by a fixed placeholder."""
    filled = [F.coalesce(part.cast("string"), F.lit(NULL_KEY_PART)) for part in parts]
    return F.md5(F.concat_ws("-", *filled))


def present(text: Column) -> Column:
    """True for text that is neither NULL nor empty, false (not NULL) otherwise."""
    return text.isNotNull() & (text != "")
