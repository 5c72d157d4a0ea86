"""Kept statistics against exact counts, over appends and merges."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerlark.operators import statistics


@pytest.fixture
def rows(spark):
    """A third of the rows has one value; the rest spreads over thousands."""
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.pmod(F.xxhash64("id"), F.lit(4000)))
    some = F.when(F.col("id") % 4 > 0, F.concat(F.lit("s"), F.col("id") % 12))
    return spark.range(30_000).select("id", key.alias("k"), some.alias("some"), F.lit(None).cast("int").alias("none"))


def true_counts(rows, column) -> Counter:
    return Counter(row[0] for row in rows.select(F.col(column).cast("string")).collect())


def check(lines, rows):
    total = rows.count()
    found = {row.column_name: row for row in lines.collect()}
    assert set(found) == {"k", "some", "none"}
    for column, line in found.items():
        exact = true_counts(rows, column)
        assert (line.row_count, line.null_count) == (total, exact.pop(None, 0))
        assert line.missed * (statistics.ITEMS + 1) <= total and len(line["items"]) <= statistics.ITEMS
        kept = {item.value: item.n for item in line["items"]}
        for value, n in exact.items():
            assert kept.get(value, 0) <= n <= kept.get(value, 0) + line.missed
    for line in statistics.estimates(lines).collect():
        exact = true_counts(rows, line.column_name)
        exact.pop(None, None)
        assert abs(line.distinct_keys - len(exact)) <= 0.033 * len(exact)
        assert line.largest_least <= max(exact.values(), default=0) <= line.largest_most
        assert (line.rows_per_key is None) == (not exact)


def test_one_part(rows):
    check(statistics.summarize(rows, ["k", "some", "none"]), rows)


def test_appends_merge_without_reading_rows(spark, rows, tmp_path):
    kept = statistics.KeptStatistics(spark, str(tmp_path / "kept"), ["k", "some", "none"])
    for part, (start, end) in enumerate([(0, 100), (100, 20_000), (20_000, 30_000)]):
        kept.add(part, rows.where(F.col("id").between(start, end - 1)))
    kept.add(1, rows.where(F.col("id").between(100, 19_999)))
    assert all("/kept/part=" in name for name in kept.read().inputFiles())
    check(kept.read(), rows)
    check(statistics.merge(kept.read()), rows)


def test_frequent_values(rows):
    lines = statistics.merge(statistics.summarize(rows, ["k", "some"]))
    found = {(row.column_name, row.value): (row.least, row.most) for row in statistics.frequent(lines, 0.05).collect()}
    wanted = {(column, value): n for column in ("k", "some") for value, n in true_counts(rows, column).items()
              if value is not None and n >= 0.05 * 30_000}
    assert set(wanted) <= set(found) and ("k", "7") in wanted
    assert all(found[key][0] <= n <= found[key][1] for key, n in wanted.items())
    with pytest.raises(ValueError):
        statistics.frequent(lines, 0.01)


def test_no_rows(rows):
    none = statistics.summarize(rows.where("id < 0"), ["k"])
    assert none.collect() == [] and statistics.merge(none).collect() == []
