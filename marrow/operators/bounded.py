"""Driver-side copies of reference tables, behind a check of their size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row


def collect_bounded(df: DataFrame, limit: int, what: str) -> list[Row]:
    """Rows of a table that must stay small; an error beyond ``limit`` rows, never a cut."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{what} has more than {limit} rows; it is meant to be a small reference table")
    return rows
