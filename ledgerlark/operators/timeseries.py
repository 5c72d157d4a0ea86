"""Time buckets and retention."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bucketed(df: DataFrame, time: str, width: str, by: list[str], measures: list[Column]) -> DataFrame:
    """Aggregates per time bucket, named by the bucket's start."""
    return (
        df.groupBy(F.window(time, width).alias("w"), *by)
        .agg(*measures)
        .withColumn("bucket", F.col("w.start"))
        .drop("w")
    )


def last_days(df: DataFrame, time: str, days: int) -> DataFrame:
    """Rows of the last days before the newest one."""
    newest = df.agg(F.max(time)).scalar()
    return df.where(F.col(time) >= newest - F.expr(f"INTERVAL {days} DAYS"))


def kept_partitions(df: DataFrame, day: str, days: int) -> DataFrame:
    """Rows of the newest ``days`` day folders.

    The newest day comes from the folder names, without reading a column, and enters
    the filter as a literal, so the read itself does not open older folders.
    """
    newest = df.agg(F.max(day)).first()[0]
    return df.where(F.col(day) > F.date_sub(F.lit(newest), days))
