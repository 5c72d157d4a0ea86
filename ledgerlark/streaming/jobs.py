"""Streams over a folder of parquet files.

Each job runs until it has read what is there (``availableNow``) and can be
started again on the same folders: the checkpoint remembers what was read, and
each micro-batch writes to a place named by its number. Times without a zone become
instants of the session's zone, so run streams under UTC, which has no gaps.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerlark.operators import quality
from ledgerlark.operators.timeseries import bucketed
from ledgerlark.streaming.merged import MergedTable


def file_stream(
    spark: SparkSession, folder: str, schema: StructType, pattern: str = "*.parquet",
    files_per_batch: int = 1000,
) -> DataFrame:
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(folder)
    )


def stream_buckets(
    stream: DataFrame, time: str, delay: str, width: str, by: list[str], measures: list[Column],
    folder: str,
) -> DataFrame:
    """Closed time buckets; rows for a bucket already written are dropped.

    A bucket is written once, when the newest time seen is ``delay`` past its end.
    """
    timed = stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay)
    closed = bucketed(timed, time, width, by, measures)
    run = (
        closed.writeStream.outputMode("append").format("parquet")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start(f"{folder}/buckets")
    )
    run.awaitTermination()
    return stream.sparkSession.read.schema(closed.schema).parquet(f"{folder}/buckets")


def _batches(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    """Rows of all micro-batches written below ``folder``, with their number."""
    return spark.read.schema(schema.add("batch", "long")).parquet(folder)


def _run_batches(stream: DataFrame, write: Callable[[DataFrame], DataFrame], folder: str) -> None:
    """Write ``write(batch)`` for every micro-batch, in a folder named by its number.

    A batch that runs again replaces its own folder and nothing else.
    """

    def put(batch: DataFrame, number: int) -> None:
        # Several checks read the batch; without this each would read the source.
        kept = batch.persist()
        try:
            write(kept).write.mode("overwrite").parquet(f"{folder}/rows/batch={number}")
        finally:
            kept.unpersist()

    run = (
        stream.writeStream.foreachBatch(put)
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()


def stream_validated(
    stream: DataFrame, table: str, row_key: Column, rules: list[quality.Rule],
    parents: dict[str, DataFrame], folder: str,
) -> tuple[DataFrame, DataFrame]:
    """Each micro-batch split into accepted and quarantined rows."""

    def judge(batch: DataFrame) -> DataFrame:
        broken = quality.violations(batch, table, row_key, rules, parents)
        return quality.judged(batch, row_key, broken)

    _run_batches(stream, judge, folder)
    schema = StructType(list(stream.schema.fields)).add("refused_for", "string")
    rows = _batches(stream.sparkSession, f"{folder}/rows", schema.add("refused_rule", "string"))
    refused = F.col("refused_for").isNotNull()
    return rows.where(~refused).select(stream.columns), rows.where(refused)


def stream_unique(
    stream: DataFrame, sequence: str, rules: list[quality.Rule], parents: dict[str, DataFrame], unique: quality.Unique,
    time: str, delay: str, folder: str, stored: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Rows split into accepted and quarantined ones, with a key no two accepted rows share,
    in whatever micro-batches they come and however often the job is started again.

    A row that breaks another rule, or whose key a ``stored`` row has, claims no key. Of the
    others, those that come first to a key claim it in the state of the stream, which holds
    one entry per key and lets it go once the watermark is ``delay`` past the claiming row.
    Of several in one micro-batch the lowest ``sequence`` wins. A row older than the
    watermark can no longer be compared and is quarantined like a repeated one. A key with
    a NULL in it clashes with nothing.
    """
    columns, keys = stream.columns, list(unique.columns)
    own = [r for r in rules if isinstance(r, quality.NotNull | quality.Check)]
    judged = stream.withColumn("_why", quality.first_broken(stream, own))
    if stored is not None:
        judged = quality.refuse_by_lookup(judged, "_why", unique, stored.select(*keys).distinct())
    for rule in rules:
        if isinstance(rule, quality.ForeignKey):
            judged = quality.refuse_by_lookup(judged, "_why", rule, parents[rule.parent])
    judged = judged.withColumn("_time", F.col(time).cast("timestamp")).withWatermark("_time", delay)
    complete = reduce(and_, [F.col(c).isNotNull() for c in keys])
    claims = judged.where(F.col("_why").isNull() & complete).dropDuplicatesWithinWatermark(keys)
    both = judged.withColumn("_claim", F.lit(False)).unionByName(claims.withColumn("_claim", F.lit(True))).drop("_time")

    def settle(batch: DataFrame) -> DataFrame:
        # The number is that of a row of this micro-batch, which is held while it is used.
        rows = batch.where(~F.col("_claim")).withColumn("_row", F.monotonically_increasing_id())
        claimed = batch.where("_claim").select(*keys)
        open_ = F.col("_why").isNull() & complete
        winners = (
            rows.where(open_).groupBy(*keys).agg(F.min(F.struct(sequence, "_row")).alias("_first"))
            .join(claimed, keys, "left_semi").select(F.col("_first._row").alias("_row"), F.lit(True).alias("_wins"))
        )
        taken = F.when(open_ & F.col("_wins").isNull(), quality.named("UNIQUE", unique))
        return rows.join(winners, "_row", "left").withColumn("_why", F.coalesce("_why", taken)).select(*columns, "_why.*")

    _run_batches(both, settle, folder)
    schema = StructType(list(stream.schema.fields)).add("refused_for", "string").add("refused_rule", "string")
    rows = _batches(stream.sparkSession, f"{folder}/rows", schema)
    refused = F.col("refused_for").isNotNull()
    return rows.where(~refused).select(columns), rows.where(refused)


def stream_upserted(
    stream: DataFrame, time: str, delay: str, event_key: str, key: str, columns: list[str],
    current: DataFrame, sequence: str, folder: str,
) -> MergedTable:
    """``current`` with every micro-batch applied as an upsert, to be read merged.

    A repeated event is dropped while the watermark still covers it; beyond that the
    guarantee ends. ``current`` counts when the folder is new; later starts go on from what
    is there, compacted or not.
    """
    once = (
        stream.withColumn("_seen", F.col(time).cast("timestamp"))
        .withWatermark("_seen", delay)
        .dropDuplicatesWithinWatermark([event_key])
        .drop("_seen")
    )
    table = MergedTable(stream.sparkSession, folder, stream.schema, key, columns, sequence)
    table.start(current)
    _run_batches(once, lambda batch: batch, folder)
    return table
