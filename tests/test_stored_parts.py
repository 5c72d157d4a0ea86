"""Copies compared by checksums of their parts."""

from __future__ import annotations

import glob

import pytest
from pyspark.sql import functions as F

from ledgerlark.operators.sets import row_differences
from ledgerlark.operators.stored_parts import StoredParts, differing_parts, stored_differences

SCHEMA = "k string, v int, w int"
ROWS = [(str(i), i, None) for i in range(200)] + [(None, 1, 2), ("9", 9, None), ("9", 9, None)] + [("hot", i % 3, 0) for i in range(100)]


@pytest.fixture
def stored(spark, tmp_path):
    def make(name, rows):
        df = spark.createDataFrame(rows, SCHEMA)
        return StoredParts(spark, str(tmp_path / name), df.schema, "k", 16).write(df)

    return make


def lines(df):
    return sorted(map(str, df.collect()))


def test_equal_copies_open_nothing(stored):
    left, right = stored("a", ROWS), stored("b", ROWS[::-1])
    assert differing_parts(left, right) == []
    assert lines(stored_differences(left, right)) == []
    assert left.rows().columns == ["k", "v", "w"] and left.rows().count() == len(ROWS)


@pytest.mark.parametrize("change", [
    lambda rows: [("5", 6, None), *(r for r in rows if r[0] != "5")],           # changed
    lambda rows: [r for r in rows if r[0] is not None],                          # a NULL key gone
    lambda rows: [*rows, ("hot", 1, 0)],                                         # one copy more
    lambda rows: [r if r[0] != "5" else ("5", None, 5) for r in rows],           # NULL in another column
    lambda rows: [],
])
def test_differences(spark, stored, change):
    left, right = stored("a", ROWS), stored("b", change(ROWS))
    want = row_differences(*(spark.createDataFrame(rows, SCHEMA) for rows in (ROWS, change(ROWS))))
    assert lines(stored_differences(left, right)) == lines(want) != []


def test_one_changed_row_opens_one_part(spark, tmp_path):
    df = spark.range(20_000).select("id", F.xxhash64("id").alias("v"))
    changed = df.withColumn("v", F.when(F.col("id") == 777, F.lit(0)).otherwise(F.col("v")))
    left, right = (StoredParts(spark, str(tmp_path / name), df.schema, "id", 64).write(copy)
                   for name, copy in (("a", df), ("b", changed)))
    (part,) = differing_parts(left, right)
    for path in glob.glob(f"{tmp_path}/*/rows/_part=*/*.parquet"):
        if f"_part={part}/" not in path:
            with open(path, "wb") as file:  # opening one of these would fail
                file.write(b"broken")
    assert {(r.id, r.left_rows, r.right_rows) for r in stored_differences(left, right).collect()} == {(777, 1, 0), (777, 0, 1)}


def test_copies_that_cannot_be_compared(spark, stored, tmp_path):
    left = stored("a", ROWS)
    other = StoredParts(spark, str(tmp_path / "b"), left.schema, "k", 8)
    with pytest.raises(ValueError):
        differing_parts(left, other)
    with pytest.raises(ValueError):
        other.write(spark.createDataFrame(ROWS, SCHEMA).withColumn("_part", F.lit(1)))
