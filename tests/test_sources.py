"""Schemas, versions, reports and key statistics."""

from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from conftest import PLAIN, SMALLEST
from ledgerlark.operators.sorting import sort_by_choice
from ledgerlark.plans import all_queries
from ledgerlark.plans.aggregation import key_stats
from ledgerlark.sources import scratch, sinks
from ledgerlark.sources.tables import PRIMARY_KEYS, REFERENCES, TABLE_NAMES, Tables, schema_of


@pytest.mark.parametrize("name", TABLE_NAMES)
def test_declared_schema_is_the_stored_one(spark, name):
    stored = spark.read.parquet(f"{SMALLEST}/{name}.parquet").schema
    declared = schema_of(name)
    assert [(f.name, f.dataType.simpleString()) for f in stored] == [
        (f.name, f.dataType.simpleString()) for f in declared
    ]


def test_keys_and_references_name_real_columns():
    for key in PRIMARY_KEYS:
        assert set(key.columns) <= set(schema_of(key.table).names)
    for ref in REFERENCES:
        assert ref.column in schema_of(ref.child).names
        assert ref.parent_column in schema_of(ref.parent).names


def test_unknown_table_is_an_attribute_error(spark):
    with pytest.raises(AttributeError):
        Tables(spark, SMALLEST).nothing


def test_a_version_written_twice_is_one_version(spark):
    table = sinks.VersionedTable(spark, scratch.run_folder(spark, "versions"))
    first = table.write(spark.range(3), 1)
    for _ in range(2):
        second = table.write(first.where("id > 0"), 2)
    assert sorted(r.id for r in second.collect()) == [1, 2]
    assert first.count() == 3


def test_switching_versions(spark):
    table = sinks.VersionedTable(spark, scratch.run_folder(spark, "switch"))
    with pytest.raises(ValueError):
        table.read()
    table.write(spark.range(3), 1)
    table.switch(1)
    failing = spark.range(5).select(F.when(F.col("id") == 4, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        table.write(failing, 2)
    with pytest.raises(ValueError, match="end"):
        table.switch(2)
    assert table.read().count() == 3
    fresh = table.write(spark.range(1, 9), 2)
    with pytest.raises(ValueError, match="orphans"):
        table.switch(2, {"orphans": fresh.where("id > 7")})
    assert table.current() == 1
    table.switch(2, {"orphans": fresh.where("id > 8")})
    assert table.current() == 2 and table.read().count() == 8


def test_report_counts_what_it_wrote(spark):
    manifest = sinks.write_report(spark, {"a b": spark.range(5), "none": spark.range(0)})
    rows = {r.label: r for r in manifest.collect()}
    assert (rows["a b"].row_count, rows["none"].row_count) == (5, 0)
    assert spark.read.parquet(rows["a b"].path).count() == 5


def test_cluster_without_a_shared_folder_is_an_error():
    session = SimpleNamespace(
        conf=SimpleNamespace(get=lambda name, default: default),
        sparkContext=SimpleNamespace(master="yarn"),
    )
    with pytest.raises(RuntimeError):
        scratch.shared_folder(session)


@pytest.mark.parametrize("master", ["local-cluster[2,1,1024]", "spark://host:7077"])
def test_only_one_process_is_local(master):
    session = SimpleNamespace(
        conf=SimpleNamespace(get=lambda name, default: default), sparkContext=SimpleNamespace(master=master))
    with pytest.raises(RuntimeError):
        scratch.shared_folder(session)


def test_local_folder_without_the_setting(tmp_path):
    """A session of its own process, without spark.checkpoint.dir, writes, reads and clears."""
    script = """
import os, sys
from pyspark.sql import SparkSession
from ledgerlark.sources import scratch
spark = (SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate())
folder = scratch.shared_folder(spark)
assert folder == scratch.shared_folder(spark)
assert scratch.materialize(spark.range(5), "t").count() == 5
print("FOLDER", folder)
"""
    (tmp_path / "conf").mkdir()
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run(
        [sys.executable, "-c", script], capture_output=True, text=True, timeout=300,
        env=os.environ | {"SPARK_CONF_DIR": str(tmp_path / "conf"), "PYTHONPATH": root})
    assert done.returncode == 0, done.stderr[-2000:]
    folder = done.stdout.split("FOLDER ")[1].strip()
    assert not list(Path(folder).rglob("*.parquet"))


def test_a_query_run_twice_leaves_nothing_more(spark):
    def left() -> int:
        return sum(1 for _ in Path(scratch.shared_folder(spark)).rglob("*.parquet"))

    before = left()
    for _ in range(2):
        with scratch.scope():
            assert all_queries()["win_rank"].run(spark, SMALLEST).count() > 0
            assert left() > before
        assert left() == before


def test_approximate_statistics_are_close(spark):
    orders = Tables(spark, PLAIN).orders
    exact = key_stats(orders, "o_custkey").first()
    close = key_stats(orders, "o_custkey", exact=False).first()
    assert exact.row_count == close.row_count == 15_000
    assert abs(close.distinct_keys - exact.distinct_keys) < 0.15 * exact.distinct_keys


def test_only_listed_sort_columns_are_used(spark):
    rows = spark.createDataFrame([(1, "b"), (2, "a")], "id int, name string")
    allowed = {"name": F.asc("name")}
    by_name = sort_by_choice(rows, "name", allowed, F.asc("id")).collect()
    hostile = sort_by_choice(rows, "name; DROP TABLE x", allowed, F.asc("id")).collect()
    assert [r.id for r in by_name] == [2, 1] and [r.id for r in hostile] == [1, 2]
