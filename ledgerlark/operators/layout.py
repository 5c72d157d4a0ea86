"""Physical layouts that make selective reads skip files and row groups.

A layout is written once, to a path the caller names and keeps, and read many times.
"""

from __future__ import annotations

import datetime as dt
import uuid
import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerlark.sources import folders


def write_clustered(
    df: DataFrame, columns: list[str | Column], path: str, files: int | None = None
) -> DataFrame:
    """A copy range-partitioned and sorted by ``columns``, read back.

    Each file and row group then covers a narrow range of the first column, so a
    filter on it skips the rest by the minimum and maximum in the footers. A value
    too frequent for one file is split by the columns after it.
    """
    spark = df.sparkSession
    ranged = df.repartitionByRange(files, *columns) if files else df.repartitionByRange(*columns)
    ranged.sortWithinPartitions(*columns).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def write_hashed(
    df: DataFrame, spread_by: list[str | Column], order: list[str], path: str
) -> DataFrame:
    """A copy hash-partitioned by ``spread_by`` and sorted, read back.

    One pass over the input, where ranges would need a second one for sampling. A
    bloom filter on the first sort column lets a lookup skip the row groups that
    do not hold the value.
    """
    return write_sorted(df.repartition(*spread_by), order, path)


def write_sorted(df: DataFrame, order: list[str], path: str) -> DataFrame:
    """A copy of each partition sorted by itself, read back, with the same bloom filters."""
    spark = df.sparkSession
    (
        df.sortWithinPartitions(*order)
        .write.option(f"parquet.bloom.filter.enabled#{order[0]}", "true")
        .parquet(path)
    )
    return spark.read.schema(df.schema).parquet(path)


def write_partitioned(df: DataFrame, column: str, order: list[str], path: str) -> DataFrame:
    """A copy with one folder per value of ``column``, read back.

    Rows are spread by range over (column, order), so a value with very many rows
    is written by several tasks.
    """
    spark = df.sparkSession
    (
        df.repartitionByRange(column, *order)
        .sortWithinPartitions(column, *order)
        .write.partitionBy(column)
        .parquet(path)
    )
    return spark.read.schema(df.schema).parquet(path)


def overwrite_partitions(df: DataFrame, column: str, order: list[str], path: str) -> None:
    """Replace the folders of the values that ``df`` has, and leave all others as they are."""
    (
        df.repartitionByRange(column, *order)
        .sortWithinPartitions(column, *order)
        .write.partitionBy(column)
        .option("partitionOverwriteMode", "dynamic")
        .mode("overwrite")
        .parquet(path)
    )


def drop_old_days(spark: SparkSession, path: str, column: str, days: int) -> list[dt.date]:
    """Delete the day folders before the newest ``days`` days; the days dropped.

    Only names are read and whole folders deleted, so the cost does not depend on the rows,
    kept files are not touched, and doing it again changes nothing.
    """
    prefix = f"{column}="
    found = {}
    for name in folders.names(spark, path):
        if name.startswith(prefix) and name != f"{prefix}__HIVE_DEFAULT_PARTITION__":
            found[dt.date.fromisoformat(name.removeprefix(prefix))] = name
    if not found:
        return []
    dropped = sorted(day for day in found if day <= max(found) - dt.timedelta(days=days))
    for day in dropped:
        folders.delete(spark, f"{path}/{found[day]}")
    return dropped


def write_bucketed(df: DataFrame, columns: list[str], buckets: int, path: str) -> DataFrame:
    """A copy hashed into ``buckets`` files by the columns and sorted by them, read back as such.

    Copies with equal numbers of buckets join on their columns without moving a row, as often
    as they are read. Spark knows a copy's buckets by its entry in the catalog; the entry is
    taken out again once it was read, and the files belong to the caller.
    """
    spark, name = df.sparkSession, f"bucketed_{uuid.uuid4().hex}"
    writer = df.repartition(buckets, *columns).write.format("parquet")
    writer.bucketBy(buckets, *columns).sortBy(*columns).option("path", path).saveAsTable(name)
    copy = spark.table(name)
    copy.schema  # the columns are looked up now
    spark.sql(f"DROP TABLE {name}")
    return copy


def write_looked_up(df: DataFrame, key: str, order: list[str], files: int, path: str) -> None:
    """A copy with one folder, of one file, per value of a checksum of ``key``."""
    slot = F.pmod(F.crc32(F.col(key).cast("binary")), F.lit(files)).cast("int").alias("slot")
    (
        df.select("*", slot).repartition(files, "slot").sortWithinPartitions("slot", key, *order)
        .write.partitionBy("slot").parquet(path)
    )


def look_up(spark: SparkSession, schema: StructType, key: str, value: str, files: int, path: str) -> DataFrame:
    """Rows of one key: the folder follows from the key, so no other is opened."""
    slot = zlib.crc32(value.encode()) % files
    rows = spark.read.schema(StructType(list(schema.fields)).add("slot", "integer")).parquet(path)
    return rows.where((F.col("slot") == slot) & (F.col(key) == value)).drop("slot")


def file_ranges(df: DataFrame, column: str) -> DataFrame:
    """Per file: rows and the range of ``column``, as a reader sees them."""
    return df.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.count(F.lit(1)).alias("row_count"), F.max("_metadata.file_size").alias("bytes"),
        F.min(column).alias("low"), F.max(column).alias("high"),
    )


def files_for_smallest(ranges: DataFrame) -> DataFrame:
    """Files there are, and those a lookup of the smallest value must open."""
    per_low = ranges.groupBy("low").agg(
        F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes"),
        F.sum("row_count").alias("row_count"),
    )
    return per_low.agg(
        F.sum("n").alias("files"), F.sum("row_count").alias("row_count"),
        F.sum("bytes").alias("bytes"), F.min_by("n", "low").alias("files_opened"),
        F.min_by("bytes", "low").alias("bytes_opened"),
    )


def files_for(ranges: DataFrame, low, high) -> DataFrame:
    """Files and bytes there are, and those a filter on the range must open."""
    touched = (F.col("low") <= high) & (F.col("high") >= low)
    return ranges.agg(
        F.count(F.lit(1)).alias("files"),
        F.count_if(touched).alias("files_opened"),
        F.sum("bytes").alias("bytes"),
        F.sum(F.when(touched, F.col("bytes")).otherwise(0)).alias("bytes_opened"),
    )
