"""Layouts that are kept: day folders and buckets."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from conftest import SMALLEST
from ledgerlark.operators import layout
from ledgerlark.plans import reshaping
from ledgerlark.sources import folders
from ledgerlark.sources.scratch import run_folder
from ledgerlark.sources.tables import Tables

FIRST = dt.date(2024, 1, 1)


def listing(path: str) -> dict[str, tuple]:
    """Every file of a folder with its size and time of writing."""
    return {os.path.join(top, f): (os.stat(os.path.join(top, f)).st_size, os.stat(os.path.join(top, f)).st_mtime_ns)
            for top, _, files in os.walk(path) for f in files}


@pytest.fixture
def by_day(spark):
    path = run_folder(spark, "test-days")
    rows = spark.range(300).select("id", F.date_add(F.lit(FIRST), (F.col("id") % 10).cast("int")).alias("day"))
    layout.write_partitioned(rows, "day", ["id"], path)
    return path


def test_old_days_go_whole_and_kept_files_stay(spark, by_day):
    before = listing(by_day)
    assert layout.drop_old_days(spark, by_day, "day", 4) == [FIRST + dt.timedelta(days=i) for i in range(6)]
    after = listing(by_day)
    assert after.items() <= before.items()
    assert {name for name in folders.names(spark, by_day) if name.startswith("day=")} == {f"day=2024-01-{d:02d}" for d in range(7, 11)}
    assert layout.drop_old_days(spark, by_day, "day", 4) == [] and listing(by_day) == after
    assert spark.read.parquet(by_day).count() == 120
    assert layout.drop_old_days(spark, run_folder(spark, "test-none"), "day", 4) == []


def test_late_rows_replace_their_days_only(spark, by_day):
    before = listing(by_day)
    day = FIRST + dt.timedelta(days=2)
    fresh = spark.range(1000, 1005).select("id", F.lit(day).alias("day"))
    layout.overwrite_partitions(fresh, "day", ["id"], by_day)
    after = listing(by_day)
    other = {path: facts for path, facts in before.items() if f"day={day}" not in path and "_SUCCESS" not in path}
    assert other.items() <= after.items()
    rows = spark.read.parquet(by_day)
    assert rows.where(F.col("day") == F.lit(day)).count() == 5 and rows.count() == 275


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("query", [reshaping.bridge_bucketed_forward, reshaping.bridge_bucketed_reverse])
def test_buckets_join_without_moving_rows(spark, query):
    before = {t.name for t in spark.catalog.listTables()}
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for name in names:
        spark.conf.set(name, "-1")
    try:
        joined = query(Tables(spark, SMALLEST))
        joined.collect()
        plan = plan_of(joined)
    finally:
        for name in names:
            spark.conf.unset(name)
    assert "SortMergeJoin" in plan and "Exchange" not in plan and "SelectedBucketsCount" in plan
    assert {t.name for t in spark.catalog.listTables()} == before
