"""Layout of written tables: rows near each other in several columns at once, and what a reader can skip by it."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE = 20_000
BITS = 5
FEW = 4


def cut_points(values: Sequence, ranges: int) -> list:
    """At most ``ranges`` - 1 values that cut the sorted sample into about equal parts; each distinct value once."""
    ordered = sorted(v for v in values if v is not None)
    distinct = sorted(set(ordered))
    if len(distinct) <= ranges:
        return distinct[1:]
    return sorted({ordered[len(ordered) * k // ranges] for k in range(1, ranges)} - {ordered[0]})


def range_number(column: Column, cuts: Sequence, first: int = 0) -> Column:
    """How many cut points lie at or below the value, by halving; NULL counts as the largest."""
    if not cuts:
        return F.lit(first)
    middle = len(cuts) // 2
    low = range_number(column, cuts[:middle], first)
    high = range_number(column, cuts[middle + 1 :], first + middle + 1)
    return F.when(column < F.lit(cuts[middle]), low).otherwise(high)


def z_value(table: DataFrame, columns: Sequence[str], bits: int = BITS, sample: int = SAMPLE) -> Column:
    """A number whose bits are, in turn, those of the columns' ranges; rows of near numbers are near in every column.

    Columns of at most ``FEW`` ranges are not mixed in but come first: they cost the others little, and a rare value
    then lies in one place. The ranges come from about ``sample`` rows of ``table``, which should be a written one: it
    is counted and sampled. The sample only shapes the layout; every row is kept.
    """
    rows = table.count()
    share = min(1.0, sample / rows) if rows else 1.0
    drawn = table.select(*columns).sample(share, seed=1).collect()
    cuts = {c: cut_points([r[c] for r in drawn], 1 << bits) for c in columns}
    few = [c for c in columns if len(cuts[c]) < FEW]
    mixed = [c for c in columns if c not in few]
    whole = F.lit(0)
    for c in few:
        whole = whole * F.lit(len(cuts[c]) + 1) + range_number(F.col(c), cuts[c])
    parts = [F.shiftleft(whole, bits * len(mixed))]
    for k, c in enumerate(mixed):
        # spread over all numbers, so that the highest bit halves the column whatever its ranges are
        number = F.floor(range_number(F.col(c), cuts[c]) * F.lit(1 << bits) / F.lit(len(cuts[c]) + 1)).cast("int")
        for bit in range(bits):
            one = F.shiftright(number, bit).bitwiseAND(F.lit(1))
            parts.append(F.shiftleft(one, bit * len(mixed) + len(mixed) - 1 - k))
    return reduce(Column.bitwiseOR, parts)


def row_groups(table: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per Parquet row group and column of a written table, from the footers alone.

    FILE, ROW_GROUP, ROWS, COLUMN, LOW and HIGH (as text; null if the file has no statistics).
    """
    files = table.select(F.input_file_name().alias("FILE")).distinct()

    def footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from urllib.parse import unquote

        import pyarrow.fs
        import pyarrow.parquet as pq

        for batch in batches:
            rows = []
            for name in batch.column(0).to_pylist():
                source, path = pyarrow.fs.FileSystem.from_uri(name)
                about = pq.ParquetFile(source.open_input_file(unquote(path))).metadata
                at = {about.schema.column(i).path: i for i in range(about.num_columns)}
                for g in range(about.num_row_groups):
                    group = about.row_group(g)
                    for c in columns:
                        stats = group.column(at[c]).statistics
                        known = stats is not None and stats.has_min_max
                        low, high = (str(stats.min), str(stats.max)) if known else (None, None)
                        rows.append((name, g, group.num_rows, c, low, high))
            kinds = (pa.string(), pa.int32(), pa.int64(), pa.string(), pa.string(), pa.string())
            names = ["FILE", "ROW_GROUP", "ROWS", "COLUMN", "LOW", "HIGH"]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

    return files.mapInArrow(footers, "FILE string, ROW_GROUP int, ROWS long, COLUMN string, LOW string, HIGH string")


def groups_read(table: DataFrame, wanted: dict[str, str]) -> DataFrame:
    """For a search of one text value in each column: row groups a reader cannot skip, and all (COLUMN, READ, GROUPS)."""
    groups = row_groups(table, list(wanted))
    values = F.create_map(*[F.lit(x) for pair in wanted.items() for x in pair])
    value = values[F.col("COLUMN")]
    may_hold = F.col("LOW").isNull() | ((F.col("LOW") <= value) & (value <= F.col("HIGH")))
    return groups.groupBy("COLUMN").agg(F.count_if(may_hold).alias("READ"), F.count("*").alias("GROUPS"))
