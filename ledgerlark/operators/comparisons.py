"""Comparisons with all or any value of a subquery."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _facts(listed: DataFrame, column: str) -> Column:
    """Size, NULLs and bounds of the list: one row from one pass."""
    return listed.agg(
        F.struct(
            F.count(F.lit(1)).alias("size"), F.count_if(F.col(column).isNull()).alias("nulls"),
            F.min(column).alias("low"), F.max(column).alias("high"),
        )
    ).scalar()


def above_all(value: str, listed: DataFrame, column: str) -> Column:
    """``value > ALL (SELECT column FROM listed)`` as a three-valued column.

    The maximum alone is not enough: an empty list is TRUE for every row, and a
    NULL in the list leaves UNKNOWN unless some other value already refutes it.
    """
    facts = _facts(listed, column)
    return (
        F.when(facts["size"] == 0, F.lit(True))
        .when(F.col(value) <= facts["high"], F.lit(False))
        .when(facts["nulls"] > 0, F.lit(None).cast("boolean"))
        .otherwise(F.col(value) > facts["high"])
    )


def above_any(value: str, listed: DataFrame, column: str) -> Column:
    """``value > ANY (SELECT column FROM listed)`` as a three-valued column."""
    facts = _facts(listed, column)
    return (
        F.when(facts["size"] == 0, F.lit(False))
        .when(F.col(value) > facts["low"], F.lit(True))
        .when(facts["nulls"] > 0, F.lit(None).cast("boolean"))
        .otherwise(F.col(value) > facts["low"])
    )


def single_value(df: DataFrame, column: str, default: object = None) -> Column:
    """A scalar subquery made safe: more than one row fails, none gives ``default``."""
    one = df.select(column).scalar()
    return one if default is None else F.coalesce(one, F.lit(default))
