"""Statistics of columns that are kept, and merged instead of counted again.

What is kept of a column is its rows and NULLs, a sketch of its distinct values, and the
``ITEMS`` most frequent values with counts that are too low by at most ``missed``. Two such
lines merge into one of the same form, so what an append costs is one look at the rows
appended.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Frequent values kept per column. After any number of merges a count is too low by at most
# rows / (ITEMS + 1), so every value above that share is among them.
ITEMS = 64

# Two to this power registers; the relative standard error is 1.04 / 128, under one percent.
REGISTERS = 14

_LINES = "column_name string, row_count long, null_count long, sketch binary, items array<struct<value:string,n:long>>, missed long"


def summarize(df: DataFrame, columns: list[str]) -> DataFrame:
    """One line per column. Values are kept as text; a column without rows has no line.

    Equal values are counted before they are shuffled, so a value of a third of all rows
    costs one row a task.
    """
    cells = F.array(*[
        F.struct(F.lit(name).alias("column_name"), F.col(f"`{name}`").cast("string").alias("value")) for name in columns])
    counted = df.select(F.inline(cells)).groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    whole = counted.groupBy("column_name").agg(
        F.sum("n").alias("row_count"), F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("null_count"),
        F.hll_sketch_agg("value", F.lit(REGISTERS)).alias("sketch"))
    return _with_items(whole, counted, F.lit(0).cast("bigint"))


def merge(lines: DataFrame) -> DataFrame:
    """One line per column out of several: of versions, appended parts, or other tables."""
    whole = lines.groupBy("column_name").agg(
        F.sum("row_count").alias("row_count"), F.sum("null_count").alias("null_count"),
        F.hll_union_agg("sketch").alias("sketch"), F.sum("missed").alias("missed_before"))
    counted = lines.select("column_name", F.inline("items")).groupBy("column_name", "value").agg(F.sum("n").alias("n"))
    return _with_items(whole, counted, F.col("missed_before"))


def _with_items(whole: DataFrame, counted: DataFrame, missed) -> DataFrame:
    """Keep ``ITEMS`` values a column: the count of the next one is taken off all of them.

    Each unit taken off a kept count goes with one off ``ITEMS`` others, which is why all that
    is ever taken off stays below rows / (ITEMS + 1). The places are bounded before the shuffle.
    """
    order = Window.partitionBy("column_name").orderBy(F.desc("n"), "value")
    best = (
        counted.where(F.col("value").isNotNull()).withColumn("place", F.row_number().over(order))
        .where(F.col("place") <= ITEMS + 1)
        .groupBy("column_name").agg(F.sort_array(F.collect_list(F.struct("place", "value", "n"))).alias("best")))
    cut = F.coalesce(F.get("best", F.lit(ITEMS))["n"], F.lit(0))
    kept = F.filter(
        F.transform("best", lambda b: F.struct(b["value"].alias("value"), (b["n"] - cut).alias("n"))), lambda b: b["n"] > 0)
    none = F.array().cast("array<struct<value:string,n:bigint>>")
    return whole.join(best, "column_name", "left").select(
        "column_name", "row_count", "null_count", "sketch", F.coalesce(kept, none).alias("items"),
        (missed + cut).alias("missed"))


def estimates(lines: DataFrame) -> DataFrame:
    """Per column: rows, NULLs, about how many distinct values, rows per value, and the largest
    value's count, which lies between ``largest_least`` and ``largest_most``."""
    distinct = F.hll_sketch_estimate("sketch")
    largest = F.coalesce(F.array_max(F.transform("items", lambda item: item["n"])), F.lit(0))
    return lines.select(
        "column_name", "row_count", "null_count", distinct.alias("distinct_keys"),
        F.try_divide(F.col("row_count") - F.col("null_count"), distinct).alias("rows_per_key"),
        largest.alias("largest_least"), (largest + F.col("missed")).alias("largest_most"))


def frequent(lines: DataFrame, share: float) -> DataFrame:
    """Values that may have at least ``share`` of a column's rows: (column_name, value, least, most).

    None with that share is left out; one with a little less may be listed. ``share`` must be
    above 1 / (ITEMS + 1).
    """
    if share * (ITEMS + 1) <= 1:
        raise ValueError(f"share must be above 1 / {ITEMS + 1}")
    listed = lines.select("column_name", "row_count", "missed", F.inline("items"))
    return listed.select(
        "column_name", "value", F.col("n").alias("least"), (F.col("n") + F.col("missed")).alias("most"), "row_count"
    ).where(F.col("most") >= share * F.col("row_count")).drop("row_count")


@dataclass(frozen=True)
class KeptStatistics:
    """Statistics below ``path``, in a folder per appended part, numbered by the caller."""

    spark: SparkSession
    path: str
    columns: list[str]

    def add(self, part: int, rows: DataFrame) -> None:
        """Summarize the rows of one part. Adding a part again replaces what was kept of it."""
        summarize(rows, self.columns).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/part={part}")

    def read(self) -> DataFrame:
        """One line per column over all parts; no row of the table is read."""
        return merge(self.spark.read.schema(_LINES + ", part long").parquet(self.path).drop("part"))
