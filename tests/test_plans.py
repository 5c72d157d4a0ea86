"""What the physical plans must and must not contain."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import SMALLEST
from ledgerlark.operators import joins, layout, ranking
from ledgerlark.plans import all_queries
from ledgerlark.sources import scratch
from ledgerlark.sources.scratch import run_folder
from ledgerlark.sources.tables import Tables

# One row per range partition is numbered in one task and broadcast, or the keys
# holding more than a thousandth of all rows are broadcast, at most a thousand, or the
# frequent values of kept statistics, at most 64 a column and part.
MAY_BROADCAST = {
    "win_rank", "sort_nulls", "insert_defaults", "insert_or_ignore", "upsert_natural_ignore",
    "upsert_natural_update",
    "dq_unique", "dq_unique_nocase", "dq_nulls_not_distinct", "dq_pk", "dq_precedence",
    "dq_messages", "dq_split", "dq_expectations", "bridge_priced_lines", "agg_kept_stats", "agg_kept_frequent",
}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def large(spark):
    """No table counts as small enough to broadcast."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for name in names:
        spark.conf.set(name, "-1")
    yield spark
    for name in names:
        spark.conf.unset(name)


@pytest.mark.parametrize("name", list(all_queries()))
def test_no_plan_depends_on_a_small_side(name, large):
    plan = plan_of(all_queries()[name].run(large, SMALLEST))
    for refused in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "InPandas"):
        assert refused not in plan
    if name not in MAY_BROADCAST:
        assert "BroadcastHashJoin" not in plan and "Window [" not in plan


@pytest.mark.parametrize("name, columns, filters", [
    ("layout_covering", {"o_custkey"}, []),
    ("agg_item_qty", {"l_partkey", "l_quantity"}, []),
    ("filter_between", {"o_orderkey", "o_custkey", "o_orderdate"}, ["GreaterThanOrEqual(o_orderdate"]),
    ("row_value_cmp", {"o_orderkey", "o_orderdate"}, ["LessThanOrEqual(o_orderdate"]),
    ("page_keyset", {"o_orderkey", "o_orderdate"}, ["LessThanOrEqual(o_orderdate"]),
    ("filter_and", {"p_partkey", "p_name", "p_size", "p_retailprice"}, ["GreaterThan(p_size,10)"]),
    ("topk_filtered", {"o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus"},
     ["EqualTo(o_orderstatus,F)"]),
])
def test_pushdown_and_pruning(spark, name, columns, filters):
    plan = plan_of(all_queries()[name].run(spark, SMALLEST))
    read = plan.split("ReadSchema: struct<")[1].split(">")[0]
    assert {field.split(":")[0] for field in read.split(",")} == columns
    for text in filters:
        assert text in plan


def test_sum_reuses_the_partitioning_of_the_join(large):
    """Lines are shuffled once by order for the sum and the join together."""
    plan = plan_of(all_queries()["agg_daily_revenue"].run(large, SMALLEST))
    assert plan.count("Exchange hashpartitioning(o_orderkey") == 1
    assert plan.count("Exchange hashpartitioning(l_orderkey") == 1


HOT_ROWS = 300_000


@pytest.fixture
def hot(spark):
    """A third of the rows on key 0; partitions above 100 kB count as skewed."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.files.maxPartitionBytes": "100KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50_000)
    yield spark.range(0, HOT_ROWS, 1, 8).select("id", key.alias("k"))
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def largest_task(df) -> int:
    """Rows of the fullest task of a result."""
    counts = df.select(F.spark_partition_id().alias("task")).groupBy("task").count()
    return counts.agg(F.max("count")).first()[0]


def test_hot_keys_of_unique_lookups_are_split(spark, hot):
    parents = spark.range(0, 40_000, 1, 8).select(F.col("id").alias("p"))
    for found, rows in (
        (joins.having_match(hot, "k", parents, "p", unique=True), None),
        (joins.without_match(hot, "k", parents, "p", unique=True), None),
        (hot.join(parents, F.col("k") == F.col("p"), "left"), HOT_ROWS),
    ):
        count = found._jdf.queryExecution().toRdd().count()
        assert rows is None or count == rows
        found.collect()
        assert "skew=true" in plan_of(found)


def test_hot_keys_of_summaries_are_salted(hot):
    summary = hot.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("low"))
    joined = joins.join_to_summary(hot, summary, "k", "n")
    assert joined.count() == HOT_ROWS
    assert joined.where("k = 0 AND (low <> 0 OR n < 100000)").count() == 0
    assert joined.select("id").distinct().count() == HOT_ROWS
    assert largest_task(joined) < HOT_ROWS / 6


def test_hot_rank_is_spread(hot):
    ranked = ranking.with_rank(hot, "k", [F.asc("k"), F.asc("id")])
    assert largest_task(ranked) < HOT_ROWS / 6
    assert ranked.where("k = 0").agg(F.max("rank")).first()[0] == 1


def test_top_k_does_not_sort_everything(spark):
    plan = plan_of(all_queries()["topk_recent"].run(spark, SMALLEST))
    assert "TakeOrderedAndProject" in plan and "Exchange" not in plan


def test_clustered_copy_opens_fewer_files(spark):
    orders = Tables(spark, SMALLEST).orders
    copy = layout.write_clustered(orders, ["o_custkey", "o_orderkey"], run_folder(spark, "test-clustered"), 8)
    ranges = layout.file_ranges(copy, "o_custkey")
    opened = layout.files_for(ranges, 7, 7).first()
    assert opened.files == 8 and opened.files_opened <= 2
    assert opened.bytes_opened < opened.bytes / 3
    assert "EqualTo(o_custkey,7)" in plan_of(copy.where("o_custkey = 7"))
    assert sorted(copy.collect()) == sorted(orders.collect())


def test_hot_value_is_split_over_files(spark):
    rows = spark.range(4000).select(F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id")).alias("k"), "id")
    copy = layout.write_clustered(rows, ["k", "id"], run_folder(spark, "test-hot"), 8)
    sizes = [r.row_count for r in layout.file_ranges(copy, "k").collect()]
    assert max(sizes) < 4000 / 3


def test_old_days_are_not_opened(spark):
    from ledgerlark.operators.timeseries import kept_partitions

    events = Tables(spark, SMALLEST).events.withColumn("day", F.to_date("ts"))
    kept = kept_partitions(layout.write_partitioned(events, "day", ["event_id"], run_folder(spark, "test-days")), "day", 7)
    assert "PartitionFilters: [isnotnull(day" in plan_of(kept)
    assert kept.select("day").distinct().count() == 7
    assert {r.day for r in kept.select("day").distinct().collect()} == {
        r.day for r in events.select("day").distinct().orderBy(F.desc("day")).limit(7).collect()
    }


def test_scratch_follows_the_session(spark):
    assert scratch.run_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert scratch.run_folder(spark, "x") != scratch.run_folder(spark, "x")


def test_positions_survive_a_second_reading(spark):
    """The numbered rows come from a written table, not from a repeated shuffle."""
    placed = ranking.with_position(spark.range(100).toDF("id"), [F.asc("id")])
    assert "FileScan parquet" in plan_of(placed) and "rangepartitioning" not in plan_of(placed)
