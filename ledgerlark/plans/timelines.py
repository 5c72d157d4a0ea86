"""Time buckets in batch and as streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.functions.columns import cents, count_rows
from ledgerlark.operators import layout, timeseries
from ledgerlark.operators.quality import Check, ForeignKey, Unique
from ledgerlark.plans.registry import query
from ledgerlark.sources.scratch import run_folder
from ledgerlark.sources.tables import Tables, schema_of
from ledgerlark.streaming import jobs
from ledgerlark.streaming.merged import MergedTable


def measures() -> list[Column]:
    return [count_rows().alias("n"), F.sum(cents("value")).alias("value_cents")]


_BUCKET_SQL = """
    SELECT time_bucket(INTERVAL 5 MINUTES, ts) AS bucket, event_type, COUNT(*) AS n,
           CAST(SUM(CAST(ROUND(value * 100) AS BIGINT)) AS BIGINT) AS value_cents
    FROM events
"""


@query(_BUCKET_SQL + """
    WHERE ts >= (SELECT MAX(ts) FROM events) - INTERVAL 7 DAYS GROUP BY 1, 2
""")
def bucket_5min(t: Tables) -> DataFrame:
    """Five-minute buckets of the last seven days."""
    recent = timeseries.last_days(t.events, "ts", 7)
    return timeseries.bucketed(recent, "ts", "5 minutes", ["event_type"], measures())


@query("""
    SELECT CAST(ts AS DATE) AS day, COUNT(*) AS n FROM events
    WHERE date_diff('day', CAST(ts AS DATE), (SELECT CAST(MAX(ts) AS DATE) FROM events)) < 7
    GROUP BY 1
""")
def retention_drop(t: Tables) -> DataFrame:
    """Old day folders dropped whole: the newest seven days stay, as they were written."""
    path = run_folder(t.spark, "events-by-day")
    by_day = layout.write_partitioned(t.events.withColumn("day", F.to_date("ts")), "day", ["event_id"], path)
    layout.drop_old_days(t.spark, path, "day", 7)
    return t.spark.read.schema(by_day.schema).parquet(path).groupBy("day").agg(count_rows().alias("n"))


def event_stream(t: Tables) -> DataFrame:
    return jobs.file_stream(t.spark, t.folder, schema_of("events"), "events.parquet")


@query(_BUCKET_SQL + """
    GROUP BY 1, 2 HAVING time_bucket(INTERVAL 5 MINUTES, ts) + INTERVAL 5 MINUTES
        <= (SELECT MAX(ts) FROM events) - INTERVAL 1 DAY
""")
def stream_bucket(t: Tables) -> DataFrame:
    """The same buckets as a stream; those the watermark has not closed stay open."""
    closed = jobs.stream_buckets(
        event_stream(t), "ts", "1 day", "5 minutes", ["event_type"], measures(),
        run_folder(t.spark, "stream-bucket"),
    )
    return closed.withColumn("bucket", F.col("bucket").cast("timestamp_ntz"))


@query("""
    SELECT event_type, COUNT(*) FILTER (WHERE ok) AS accepted,
           COUNT(*) FILTER (WHERE NOT low) - COUNT(*) FILTER (WHERE ok) AS no_customer,
           COUNT(*) FILTER (WHERE low) AS too_low
    FROM (SELECT event_type, value < 1 AS low, value >= 1 AND user_id IN (
              SELECT c_custkey FROM customer WHERE c_acctbal >= 0) AS ok FROM events)
    GROUP BY event_type
""")
def stream_validate(t: Tables) -> DataFrame:
    """Row rules and a lookup of the customer on each micro-batch."""
    rules = [
        Check("chk_value", "value", "value >= 1"),
        ForeignKey("fk_user", "user_id", "customer", "c_custkey"),
    ]
    accepted, refused = jobs.stream_validated(
        event_stream(t), "events", F.col("event_id"), rules,
        {"customer": t.customer.where(F.col("c_acctbal") >= 0)},
        run_folder(t.spark, "stream-validate"),
    )
    rows = accepted.select("event_type", F.lit("").alias("why")).union(
        refused.select("event_type", "refused_rule")
    )
    return rows.groupBy("event_type").agg(
        F.count_if(F.col("why") == "").alias("accepted"),
        F.count_if(F.col("why") == "fk_user").alias("no_customer"),
        F.count_if(F.col("why") == "chk_value").alias("too_low"),
    )


@query("""
    SELECT event_type, COUNT(DISTINCT (user_id, CAST(ts AS DATE))) FILTER (WHERE ok) AS accepted,
           COUNT(*) FILTER (WHERE ok) - COUNT(DISTINCT (user_id, CAST(ts AS DATE))) FILTER (WHERE ok) AS repeated,
           COUNT(*) FILTER (WHERE NOT ok) AS other
    FROM (SELECT *, value >= 1 AND user_id IN (SELECT c_custkey FROM customer) AS ok FROM events)
    GROUP BY event_type
""")
def stream_unique(t: Tables) -> DataFrame:
    """One event per user, type and day, over three arrivals with a restart of the stream before each."""
    arrivals, folder = run_folder(t.spark, "arrivals"), run_folder(t.spark, "stream-unique")
    rules = [Check("chk_value", "value", "value >= 1"), ForeignKey("fk_user", "user_id", "customer", "c_custkey")]
    events = t.events.withColumn("day", F.to_date("ts"))
    for part in range(3):
        events.where(F.col("event_id") % 3 == part).write.mode("append").parquet(arrivals)
        accepted, refused = jobs.stream_unique(
            jobs.file_stream(t.spark, arrivals, events.schema), "event_id", rules, {"customer": t.customer},
            Unique("uq_daily", ("user_id", "event_type", "day")), "ts", "3650 days", folder)
    rows = accepted.select("event_type", F.lit("").alias("why")).union(refused.select("event_type", "refused_rule"))
    return rows.groupBy("event_type").agg(
        F.count_if(F.col("why") == "").alias("accepted"),
        F.count_if(F.col("why") == "uq_daily").alias("repeated"),
        F.count_if(~F.col("why").isin("", "uq_daily")).alias("other"),
    )


_LAST_EVENT_SQL = """
    SELECT COALESCE(c_custkey, user_id) AS user_id, COALESCE(last_type, 'none') AS last_type,
           COALESCE(last_event, -1) AS last_event
    FROM customer FULL JOIN (SELECT user_id, arg_max(event_type, event_id) AS last_type,
                                    MAX(event_id) AS last_event FROM events GROUP BY user_id)
        ON user_id = c_custkey
"""


def upserted_events(t: Tables, stream: DataFrame, folder: str) -> MergedTable:
    start = t.customer.select(
        F.col("c_custkey").alias("user_id"), F.lit("none").alias("last_type"),
        F.lit(-1).cast("bigint").alias("last_event"),
    )
    events = stream.select(
        "event_id", "ts", "user_id", F.col("event_type").alias("last_type"),
        F.col("event_id").alias("last_event"),
    )
    return jobs.stream_upserted(
        events, "ts", "1 day", "event_id", "user_id", ["last_type", "last_event"], start, "event_id", folder)


@query(_LAST_EVENT_SQL)
def stream_upsert(t: Tables) -> DataFrame:
    """Every customer's last event, kept by upserting each micro-batch."""
    return upserted_events(t, event_stream(t), run_folder(t.spark, "stream-upsert")).read()


@query(_LAST_EVENT_SQL)
def stream_upsert_compacted(t: Tables) -> DataFrame:
    """The same over three arrivals; the log is folded into a version after the first two."""
    arrivals, folder = run_folder(t.spark, "arrivals"), run_folder(t.spark, "stream-compacted")
    third = F.floor(F.col("event_id") * 3 / (t.events.agg(F.max("event_id")).scalar() + 1))
    for part in range(3):
        t.events.where(third == part).write.mode("append").parquet(arrivals)
        table = upserted_events(t, jobs.file_stream(t.spark, arrivals, schema_of("events")), folder)
        if part < 2:
            table.compact()
    return table.read()
