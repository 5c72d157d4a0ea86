"""Deletes that carry on, and reachability, against plain Python."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from ledgerlark.operators import closure
from ledgerlark.sources.tables import Reference


def shortest(edges, start, depth=None):
    found, frontier, step = {n: 0 for n in start if n is not None}, {n for n in start if n is not None}, 0
    while frontier and (depth is None or step < depth):
        step += 1
        frontier = {b for a, b in edges if a in frontier and a is not None and b is not None} - found.keys()
        found |= dict.fromkeys(frontier, step)
    return found


@pytest.mark.parametrize("depth", [None, 0, 2])
def test_reached(spark, depth):
    draw = random.Random(4)
    edges = [(draw.randrange(40), draw.randrange(40)) for _ in range(50)] + [(1, 2), (2, 3), (3, 1), (None, 5), (5, None), (7, 7)] * 2
    edges += [(50, 100 + i) for i in range(60)]  # a hub
    start = [1, 50, None, 1]
    got = closure.reached(spark.createDataFrame(edges, "a int, b int"), "a", "b",
                          spark.createDataFrame([(n,) for n in start], "n int"), "n", depth).collect()
    assert {r.node: r.step for r in got} == shortest(edges, start, depth) and len(got) == len({r.node for r in got})


def test_reached_from_nothing(spark):
    edges = spark.createDataFrame([(1, 2)], "a int, b int")
    assert closure.reached(edges, "a", "b", spark.createDataFrame([], "n int"), "n").count() == 0


@pytest.fixture
def shop(spark):
    """Guests invite guests (a ring of three and a line behind it), guests have bills, bills lines."""
    return {
        "guest": spark.createDataFrame([(1, 3), (2, 1), (3, 2), (4, 3), (5, 4), (6, None), (None, 1)], "id bigint, host bigint"),
        "bill": spark.createDataFrame([(10, 1), (11, 5), (12, 6), (13, None)], "id bigint, guest bigint"),
        "line": spark.createDataFrame([(10, "a", 7), (10, "b", 8), (11, "a", 7), (12, "c", 8), (None, "d", 7)], "bill bigint, item string, cook bigint"),
        "review": spark.createDataFrame([(1, 10), (2, 12), (3, None)], "id bigint, bill bigint"),
    }


def references(review: str, line: str = "CASCADE"):
    return [Reference("guest", "host", "guest", "id", "CASCADE"), Reference("bill", "guest", "guest", "id", "CASCADE"),
            Reference("line", "bill", "bill", "id", line), Reference("review", "bill", "bill", "id", review)]


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def victims(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "v bigint")


def test_three_levels_and_a_ring(spark, shop):
    done = closure.delete_through(shop, references("SET NULL"), "guest", victims(spark, 2, 99, None))
    assert rows(done.tables["guest"]) == [(6, None)]  # the ring, those behind it, and the one without an id
    assert rows(done.tables["bill"]) == [(12, 6), (13, None)]
    assert rows(done.tables["line"]) == [(12, "c", 8), (None, "d", 7)]
    assert rows(done.tables["review"]) == [(1, None), (2, 12), (3, None)]
    assert sorted(r[0] for r in done.gone["guest"].collect()) == [1, 2, 3, 4, 5] and done.held.count() == 0


@pytest.mark.parametrize("rule", ["RESTRICT", "NO ACTION"])
def test_what_holds_a_delete_back(spark, shop, rule):
    held = closure.delete_through(shop, references(rule), "guest", victims(spark, 4)).held
    assert held.count() == 0  # the bill that goes has no review
    held = closure.delete_through(shop, references(rule), "guest", victims(spark, 1)).held
    assert rows(held) == [("review", "bill", rule, 1)]


def test_restrict_looks_at_rows_that_go_as_well(spark):
    tables = {"a": spark.createDataFrame([(1,)], "id bigint"), "b": spark.createDataFrame([(5, 1, 1)], "id bigint, a bigint, again bigint")}
    for rule, want in (("RESTRICT", [("b", "again", "RESTRICT", 1)]), ("NO ACTION", [])):
        both = [Reference("b", "a", "a", "id", "CASCADE"), Reference("b", "again", "a", "id", rule)]
        assert rows(closure.delete_through(tables, both, "a", victims(spark, 1)).held) == want


def test_nothing_to_delete(spark, shop):
    done = closure.delete_through(shop, references("RESTRICT"), "guest", victims(spark))
    assert all(rows(done.tables[name]) == rows(shop[name]) for name in shop) and done.held.count() == 0


def test_a_long_line(spark):
    table = {"n": spark.range(1, 30).select(F.col("id"), (F.col("id") - 1).alias("up"))}
    done = closure.delete_through(table, [Reference("n", "up", "n", "id", "CASCADE")], "n", victims(spark, 12))
    assert [r.id for r in done.tables["n"].orderBy("id").collect()] == list(range(1, 12))
