"""Positions over many partitions, ties, and pages."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from conftest import PLAIN
from ledgerlark.operators import ranking
from ledgerlark.sources.tables import Tables


@pytest.fixture
def scored(spark):
    """A third of the rows share one score."""
    score = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") * 7919 % 101)
    return spark.range(3000).select("id", score.alias("score")).repartition(7)


def expected(scored):
    rows = sorted(((r.score, r.id) for r in scored.collect()), key=lambda r: (-r[0], r[1]))
    first = {}
    for place, (score, _) in enumerate(rows, 1):
        first.setdefault(score, place)
    return {id_: (first[score], place) for place, (score, id_) in enumerate(rows, 1)}


def test_rank_and_position(scored):
    order = [F.desc("score"), F.asc("id")]
    got = ranking.with_rank(scored, "score", order).collect()
    assert {r.id: (r.rank, r.position) for r in got} == expected(scored)


def test_position_of_nothing(spark):
    assert ranking.with_position(spark.range(0).toDF("id"), [F.asc("id")]).count() == 0


def test_position_is_stable_when_read_again(scored):
    placed = ranking.with_position(scored, [F.desc("score"), F.asc("id")])
    assert sorted(placed.collect()) == sorted(placed.collect())


def test_rank_of_missing_values(spark):
    """Rows without a value are ranked like any other value, in whatever partitions they lie."""
    rows = spark.range(400).select("id", F.when(F.col("id") % 2 == 0, F.col("id") % 7).alias("score"))
    for score in (F.asc("score"), F.desc("score")):
        got = {r.id: (r.rank, r.position) for r in ranking.with_rank(rows, "score", [score, F.asc("id")]).collect()}
        order = Window.orderBy(score)
        want = rows.select("id", F.rank().over(order).alias("r"),
                           F.row_number().over(Window.orderBy(score, "id")).alias("p")).collect()
        assert got == {r.id: (r.r, r.p) for r in want}


@pytest.mark.parametrize("few", [100_000, 40])
def test_pages_cover_everything_once(scored, monkeypatch, few):
    """The same pages however far the order is narrowed, and nothing written."""
    monkeypatch.setattr(ranking, "PAGE_ROWS", few)
    monkeypatch.setattr(ranking, "materialize", None)
    holed = scored.withColumn("score", F.when(F.col("id") % 10 > 0, F.col("score")))
    for ascending in (True, False):
        sort = F.asc("score") if ascending else F.desc("score")
        whole = [r.id for r in holed.orderBy(sort, F.asc("id")).collect()]
        for skip in (0, 290, 990, 2695, 2995, 4000):
            page = ranking.page_by_offset(holed, [("score", ascending), ("id", True)], skip, 10)
            assert [r.id for r in page.collect()] == whole[skip:skip + 10]


@pytest.mark.parametrize("kind", ["string", "date", "decimal(12,2)", "timestamp_ntz", "boolean", "double"])
def test_pages_of_any_type(spark, monkeypatch, kind):
    monkeypatch.setattr(ranking, "PAGE_ROWS", 30)
    number = F.col("id") * 37 % 91
    value = {"string": F.concat(F.lit("é"), number.cast("string")), "date": F.date_add(F.lit("2024-01-01"), number.cast("int")),
             "timestamp_ntz": F.timestamp_seconds(number * 3600).cast("timestamp_ntz"), "boolean": number > 40}.get(kind, number).cast(kind)
    rows = spark.range(600).select("id", F.when(F.col("id") % 9 > 0, value).alias("v"))
    for ascending in (True, False):
        sort = F.asc("v") if ascending else F.desc("v")
        whole = [r.id for r in rows.orderBy(sort, F.asc("id")).collect()]
        for skip in (0, 60, 333, 595):
            assert [r.id for r in ranking.page_by_offset(rows, [("v", ascending), ("id", True)], skip, 25).collect()] == whole[skip:skip + 25]


def test_a_page_across_two_frequent_values(spark, monkeypatch):
    """No task keeps more than the rows of a narrowed piece, whatever the page's place."""
    monkeypatch.setattr(ranking, "PAGE_ROWS", 200)
    rows = spark.range(20_000).select("id", F.when(F.col("id") < 10_000, "a").otherwise("b").alias("v"))
    page = ranking.page_by_offset(rows, [("v", True), ("id", True)], 9_995, 10)
    assert [r.id for r in page.collect()] == list(range(9_995, 10_005))
    plan = page._jdf.queryExecution().executedPlan().toString()
    kept = [int(n) for n in re.findall(r"TakeOrderedAndProject\(limit=(\d+)", plan)]
    assert kept and max(kept) <= 200
    alike = spark.range(1000).select(F.lit(1).alias("v"))
    assert ranking.page_by_offset(alike, [("v", True)], 990, 20).count() == 10


def test_a_deep_page_reads_its_range_only(spark, monkeypatch):
    monkeypatch.setattr(ranking, "PAGE_ROWS", 100)
    orders = Tables(spark, PLAIN).orders.select("o_orderkey")
    page = ranking.page_by_offset(orders, [("o_orderkey", True)], 12_000, 20)
    assert "GreaterThan(o_orderkey" in page._jdf.queryExecution().executedPlan().toString()
    assert page.count() == 20


def test_new_ids_are_dense(spark):
    batch = spark.createDataFrame([("b",), ("a",), ("c",)], "name string")
    got = ranking.with_new_ids(batch, [F.asc("name")], F.lit(40), "id").collect()
    assert {r.name: r.id for r in got} == {"a": 41, "b": 42, "c": 43}
