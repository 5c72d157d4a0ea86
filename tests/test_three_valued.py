"""Rules of NULL: lists, quantifiers, deletes and checks."""

from __future__ import annotations

import itertools

import pytest
from pyspark.sql import functions as F

from ledgerlark.operators import changes, comparisons, joins, quality

LISTS = [[], [None], [1, 2], [1, 2, None], [2], [5, 5, None]]
KEYS = [1, 2, 3, None]


def numbers(spark, values, name="x"):
    return spark.createDataFrame([(v,) for v in values], f"{name} bigint")


@pytest.mark.parametrize("listed", LISTS, ids=str)
def test_not_in_follows_sql(spark, listed):
    left, right = numbers(spark, KEYS, "k"), numbers(spark, listed)
    mine = joins.not_in(left, "k", right, "x")
    theirs = spark.sql("SELECT k FROM {l} WHERE k NOT IN (SELECT x FROM {r})", l=left, r=right)
    assert sorted(map(repr, mine.collect())) == sorted(map(repr, theirs.collect()))


def test_not_in_never_broadcasts_the_list(spark):
    plan = joins.not_in(
        spark.range(10).toDF("k"), "k", spark.range(5).toDF("x").hint("merge"), "x"
    )._jdf.queryExecution().sparkPlan().toString()
    assert "isNullAwareAntiJoin" not in plan and "LeftAnti, true" not in plan


def greater(value, other):
    return None if value is None or other is None else value > other


def quantified(value, listed, fold_all: bool):
    answers = [greater(value, other) for other in listed]
    decisive = False if fold_all else True
    if decisive in answers:
        return decisive
    return None if None in answers else not decisive


@pytest.mark.parametrize("listed", LISTS, ids=str)
@pytest.mark.parametrize("compare, fold_all", [
    (comparisons.above_all, True), (comparisons.above_any, False),
])
def test_quantifiers(spark, listed, compare, fold_all):
    left = numbers(spark, KEYS, "k")
    right = numbers(spark, listed)
    got = left.select("k", compare("k", right, "x").alias("h")).collect()
    assert {row.k: row.h for row in got} == {k: quantified(k, listed, fold_all) for k in KEYS}


def test_scalar_with_several_rows_fails(spark):
    several = numbers(spark, [1, 2])
    with pytest.raises(Exception, match="SCALAR_SUBQUERY_TOO_MANY_ROWS"):
        spark.range(1).select(comparisons.single_value(several, "x")).collect()


def test_scalar_without_rows_is_null_or_default(spark):
    none = numbers(spark, [])
    row = spark.range(1).select(
        comparisons.single_value(none, "x").alias("bare"),
        comparisons.single_value(none, "x", 0).alias("guarded"),
    ).first()
    assert row.bare is None and row.guarded == 0


def test_delete_keeps_unknown(spark):
    left = changes.delete_rows(numbers(spark, [1, 2, None]), F.col("x") == 1).collect()
    assert sorted(map(repr, [r.x for r in left])) == ["2", "None"]


def test_check_passes_unknown(spark):
    rows = numbers(spark, [1, -1, None])
    broken = quality.row_violations(rows, "t", F.col("x"), [quality.Check("c", "x", "x >= 0")])
    assert [r.row_key for r in broken.collect()] == ["-1"]


def test_truth_of_joins_and_grouping(spark):
    """NULL keys never match, group together, and count only as rows."""
    left, right = numbers(spark, [1, None, None]), numbers(spark, [1, None])
    assert left.join(right, "x").count() == 1
    groups = {r.x: r["count"] for r in left.groupBy("x").count().collect()}
    assert groups == {1: 1, None: 2}
    for a, b in itertools.product([1, None], repeat=2):
        row = spark.range(1).select(
            F.lit(a).cast("int").eqNullSafe(F.lit(b).cast("int")).alias("same")
        ).first()
        assert row.same == (a == b)
