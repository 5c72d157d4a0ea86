"""Sort orders chosen by the caller."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame


def sort_by_choice(
    df: DataFrame, choice: str, allowed: dict[str, Column], tie_break: Column
) -> DataFrame:
    """Sort by an allowed name, or only by the tie-break for any other name."""
    wanted = [allowed[choice]] if choice in allowed else []
    return df.orderBy(*wanted, tie_break)
