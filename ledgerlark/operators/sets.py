"""Union and difference of row sets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.sources.scratch import materialize_counted


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _tagged(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.withColumn("_side", F.lit(1)).unionByName(right.withColumn("_side", F.lit(-1)))


def _sides() -> list[Column]:
    return [F.count_if(F.col("_side") == side).alias(name) for side, name in ((1, "left_rows"), (-1, "right_rows"))]


def row_counts(left: DataFrame, right: DataFrame) -> DataFrame:
    """Every distinct row with the number of times each input holds it."""
    return _tagged(left, right).groupBy(*left.columns).agg(*_sides())


def dealt_row_counts(left: DataFrame, right: DataFrame, rows_a_task: int, slices: int) -> DataFrame:
    """The same where nearly all rows differ, so that combining them first only fills memory.

    The rows are dealt to tasks of a bounded number before they are combined. Copies of a row
    go to as many tasks as there are slices. The slice of a row must stay the same when a task
    runs again, so the rows are written with it.
    """
    sliced, n = materialize_counted(
        _tagged(left, right).withColumn("_slice", F.monotonically_increasing_id() % slices), "row-counts")
    tasks = max(int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n // rows_a_task))
    some = sliced.repartition(tasks, *left.columns, "_slice").groupBy(*left.columns, "_slice").agg(*_sides())
    return some.repartition(tasks, *left.columns).groupBy(*left.columns).agg(
        F.sum("left_rows").alias("left_rows"), F.sum("right_rows").alias("right_rows"))


def row_differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows that occur a different number of times in the two inputs.

    Counts instead of repeated rows: a row copied a million times too often is
    one line of the report, and both counts come from a single aggregation that
    combines on the map side.
    """
    return row_counts(left, right).where(F.col("left_rows") != F.col("right_rows"))
