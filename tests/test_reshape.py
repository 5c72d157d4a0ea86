"""Lists to rows, dependencies, and joins that lose nothing."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ledgerlark.operators import joins, reshape
from ledgerlark.operators.sets import dealt_row_counts, row_counts, row_differences


def test_parallel_lists(spark):
    bills = spark.createDataFrame(
        [(1, "tea,pie", "2,1"), (2, "차", "4"), (3, "a,b", "1")],
        "id bigint, items string, counts string",
    )
    rows = reshape.explode_lists(bills, {"items": "item", "counts": "n"}).collect()
    assert {(r.id, r.position, r.item, r.n) for r in rows} == {
        (1, 0, "tea", "2"), (1, 1, "pie", "1"), (2, 0, "차", "4"),
        (3, 0, "a", "1"), (3, 1, "b", None),
    }


def test_missing_lists_keep_their_row(spark):
    bills = spark.createDataFrame([(1, "tea", "2"), (2, None, "4,5"), (3, "a", None), (4, None, None)],
                                  "id bigint, items string, counts string")
    rows = reshape.explode_lists(bills, {"items": "item", "counts": "n"}).collect()
    assert {(r.id, r.position, r.item, r.n) for r in rows} == {
        (1, 0, "tea", "2"), (2, 0, None, "4"), (2, 1, None, "5"), (3, 0, "a", None), (4, None, None, None),
    }


@pytest.fixture
def shift(spark):
    return spark.createDataFrame(
        [("ann", 1, 3), ("bob", 1, 3), ("ann", 2, 4), ("cyd", None, 5), ("dee", None, 5),
         ("eve", 1, 6), ("fay", None, 6)],
        "worker string, kind int, station int",
    )


def test_dependency_sees_null_as_a_value(shift):
    broken = reshape.dependency_violations(shift, ["station"], ["kind"]).collect()
    assert [r.station for r in broken] == [6]


def test_determines(spark, shift):
    row = spark.range(1).select(
        reshape.determines(shift, ["station"], ["kind"]).alias("bad"),
        reshape.determines(shift.where("station < 6"), ["station"], ["kind"]).alias("good"),
    ).first()
    assert (row.bad, row.good) == (False, True)


def test_lossless_and_lossy(shift):
    stations = reshape.dimension(shift.where("station < 5"), ["station", "kind"])
    small = shift.where("station < 5")
    good = reshape.lossless(small, small.drop("kind").join(stations, "station")).first()
    assert (good.original_rows, good.rejoined_rows, good.differing_rows) == (3, 3, 0)
    kinds = reshape.dimension(small, ["kind", "worker"])
    bad = reshape.lossless(small, small.drop("worker").join(kinds, "kind")).first()
    assert bad.rejoined_rows > bad.original_rows and bad.differing_rows > 0


def test_differences_count_copies(spark):
    left = spark.createDataFrame([(1, "a")] * 3 + [(2, None)], "k int, v string")
    right = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "k int, v string")
    got = {(r.k, r.left_rows, r.right_rows) for r in row_differences(left, right).collect()}
    assert got == {(1, 3, 1), (3, 0, 1)}


@pytest.mark.parametrize("rows_a_task, slices", [(10, 3), (10_000, 64)])
def test_dealt_counts_are_the_same(spark, rows_a_task, slices):
    left = spark.createDataFrame([(1, "a")] * 300 + [(i, None) for i in range(200)] + [(None, "b")], "k int, v string")
    right = spark.createDataFrame([(i, None) for i in range(150, 250)] + [(1, "a")] * 299 + [(None, "b")] * 2, "k int, v string")
    dealt = dealt_row_counts(left, right, rows_a_task, slices)
    assert sorted(map(str, dealt.collect())) == sorted(map(str, row_counts(left, right).collect()))
    assert sum(r.left_rows for r in dealt.collect()) == 501
    if rows_a_task == 10:
        assert dealt.rdd.getNumPartitions() > 50


def test_lossless_deals_rows_by_their_number(spark, monkeypatch):
    asked = []
    monkeypatch.setattr(reshape, "dealt_row_counts", lambda *args: asked.append(args[2:]) or dealt_row_counts(*args))
    rows = spark.range(30).select("id", (F.col("id") % 3).alias("v"))
    assert tuple(reshape.lossless(rows, rows.where("id < 20")).first()) == (30, 20, 10)
    assert asked == [(reshape.ROWS_A_TASK, reshape.SLICES)]


def test_pairs_equal_brute_force(spark):
    data = [(g, v) for g in "abc" for v in ([1, 1, 4, 9, 9, 9] if g != "c" else [5])]
    got = {
        r.g: (r.members, r.pairs, r.equal_pairs, r.widest_gap)
        for r in joins.group_pairs(spark.createDataFrame(data, "g string, v bigint"), "g", "v").collect()
    }
    for group in "abc":
        values = [v for g, v in data if g == group]
        pairs = [(x, y) for i, x in enumerate(values) for y in values[i + 1:]]
        assert got[group] == (
            len(values), len(pairs), sum(x == y for x, y in pairs),
            max((abs(x - y) for x, y in pairs), default=0),
        )


def test_empty_cells_are_counted(spark):
    """A missing category is one, and thousands of categories are no list."""
    people = spark.createDataFrame([(1,), (2,)], "id bigint")
    facts = spark.createDataFrame(
        [(1, "x", 3), (1, "x", 4), (1, None, 5)], "id bigint, kind string, n bigint")
    kinds = spark.createDataFrame([("x",), ("y z",), (None,), ("x",)], "kind string")
    cells = joins.coverage(people, "id", facts, "kind", kinds, "n").collect()
    assert {tuple(r) for r in cells} == {(1, 12, 2, 1), (2, 0, 0, 3)}
    many = spark.range(5000).select(F.col("id").cast("string").alias("kind"))
    assert {r.lacking for r in joins.coverage(people, "id", facts, "kind", many, "n").collect()} == {4998, 5000}


def test_pairs_of_very_large_groups(spark):
    sizes = spark.createDataFrame([(150_000_003,), (10_000_000_000,), (1,), (0,), (2,)], "n bigint")
    got = {r.n: int(r.p) for r in sizes.select("n", joins.pairs_of("n").alias("p")).collect()}
    assert got == {n: n * (n - 1) // 2 for n in got}


def test_keys_are_checked(spark):
    with pytest.raises(ValueError):
        joins.natural_join(spark.range(1).toDF("a"), spark.range(1).toDF("b"))


def test_full_from_sides_equals_full(spark):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "k int, l string")
    right = spark.createDataFrame([(1, "x"), (3, "y"), (3, "y"), (None, "z")], "k int, r string")
    mine = joins.full_from_sides(left, right, "k", ["l"], ["r"])
    full = left.join(right, "k", "full").select("k", "l", "r")
    assert sorted(map(repr, mine.collect())) == sorted(map(repr, full.collect()))


def test_anti_forms_agree(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    right = spark.createDataFrame([(1,), (1,)], "x int")
    none = joins.without_match(left, "k", right, "x")
    by_null = left.join(right, F.col("k") == F.col("x"), "left").where("x IS NULL").select("k")
    assert sorted(map(repr, none.collect())) == sorted(map(repr, by_null.collect()))
