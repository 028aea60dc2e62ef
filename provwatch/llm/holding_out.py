"""Rows that are never learned from."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves ``remainder``; a row without id is never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % modulus == remainder, F.lit(True))
