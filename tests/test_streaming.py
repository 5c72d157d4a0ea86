"""Streams over several files, late and repeated rows, and restarts."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerlark.operators.quality import Check, ForeignKey, NotNull, Unique
from ledgerlark.sources.scratch import run_folder
from ledgerlark.streaming import jobs

START = dt.datetime(2024, 1, 1)
SCHEMA = "id bigint, at timestamp_ntz, key bigint, value bigint"


def minute(n: int) -> dt.datetime:
    return START + dt.timedelta(minutes=n)


@pytest.fixture
def source(spark):
    """Writes one file per call; files are read in the order they were written."""
    folder = run_folder(spark, "source")

    def add(*rows):
        spark.createDataFrame(list(rows), SCHEMA).coalesce(1).write.mode("append").parquet(folder)

    def stream():
        schema = spark.createDataFrame([], SCHEMA).schema
        return jobs.file_stream(spark, folder, schema, files_per_batch=1)

    return add, stream


def buckets(stream, folder):
    measures = [F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")]
    return jobs.stream_buckets(stream, "at", "10 minutes", "5 minutes", ["key"], measures, folder)


def test_late_rows_are_dropped_and_open_buckets_wait(spark, source):
    add, stream = source
    folder = run_folder(spark, "buckets")
    add((1, minute(0), 1, 5), (2, minute(4), 1, 6))
    add((3, minute(30), 1, 7))
    # The bound for late rows is the one the batch before had already applied.
    add((4, minute(31), 1, 1))
    add((5, minute(1), 1, 100), (6, minute(60), 1, 8))
    rows = buckets(stream(), folder).collect()
    assert sorted((r.bucket.minute, r.n, r.total) for r in rows) == [(0, 2, 11), (30, 2, 8)]


def test_restart_reads_only_new_files(spark, source):
    add, stream = source
    folder = run_folder(spark, "buckets")
    add((1, minute(0), 1, 5))
    add((2, minute(30), 1, 7))
    assert buckets(stream(), folder).count() == 1
    add((3, minute(90), 1, 9))
    rows = buckets(stream(), folder).collect()
    assert sorted((r.bucket.hour, r.bucket.minute, r.n) for r in rows) == [(0, 0, 1), (0, 30, 1)]


def test_rows_are_split_as_they_arrive(spark, source):
    add, stream = source
    parents = spark.createDataFrame([(1,), (2,)], "k bigint")
    rules = [Check("chk", "value", "value > 0"), ForeignKey("fk", "key", "parents", "k")]
    add((1, minute(0), 1, 5), (2, minute(1), 9, 5), (3, minute(1), 9, -1))
    add((4, minute(2), 2, 0), (5, minute(3), 2, 1))
    folder = run_folder(spark, "validate")
    for _ in range(2):  # the second start finds nothing new
        accepted, refused = jobs.stream_validated(
            stream(), "t", F.col("id"), rules, {"parents": parents}, folder
        )
        assert sorted(r.id for r in accepted.collect()) == [1, 5]
        assert {(r.id, r.refused_rule) for r in refused.collect()} == {
            (2, "fk"), (3, "chk"), (4, "chk"),
        }


def test_upsert_over_batches(spark, source):
    add, stream = source
    current = spark.createDataFrame([(1, 0, "old"), (3, 0, "old")], "key bigint, value bigint, note string")
    folder = run_folder(spark, "upsert")

    def result():
        rows = jobs.stream_upserted(
            stream().withColumn("note", F.lit("new")), "at", "1 hour", "id", "key", ["value"],
            current, "id", folder,
        ).read().collect()
        return {(r.key, r.value, r.note) for r in rows}

    add((1, minute(0), 1, 10), (2, minute(1), 2, 20))
    add((3, minute(2), 1, 11), (1, minute(0), 1, 999))  # id 1 comes again: dropped
    assert result() == {(1, 11, "old"), (2, 20, "new"), (3, 0, "old")}
    assert result() == {(1, 11, "old"), (2, 20, "new"), (3, 0, "old")}
    add((4, minute(5), 2, 21))
    assert result() == {(1, 11, "old"), (2, 21, "new"), (3, 0, "old")}


def unique_run(stream, folder, delay="1 hour", stored=None, parents=None):
    rules = [NotNull("value"), Check("chk", "value", "value > 0"), ForeignKey("fk", "key", "parents", "k")]
    accepted, refused = jobs.stream_unique(
        stream(), "id", rules, {"parents": parents}, Unique("uq", ("key", "value")), "at", delay, folder, stored)
    return sorted(r.id for r in accepted.collect()), {(r.id, r.refused_for, r.refused_rule) for r in refused.collect()}


@pytest.fixture
def parents(spark):
    return spark.createDataFrame([(k,) for k in range(5)], "k bigint")


def test_keys_stay_taken_over_batches_and_restarts(spark, source, parents):
    add, stream = source
    folder = run_folder(spark, "unique")
    add((2, minute(0), 1, 5), (1, minute(0), 1, 5), (3, minute(0), 1, 6))  # the lowest id wins inside a batch
    add((4, minute(1), 1, 5), (5, minute(1), 2, 5))
    want = [1, 3, 5], {(2, "UNIQUE", "uq"), (4, "UNIQUE", "uq")}
    assert unique_run(stream, folder, parents=parents) == want
    assert unique_run(stream, folder, parents=parents) == want  # nothing new
    add((6, minute(2), 1, 6), (7, minute(2), 3, 1), (7, minute(2), 3, 1))  # one of two copies is accepted
    accepted, refused = unique_run(stream, folder, parents=parents)
    assert accepted == [1, 3, 5, 7] and refused == want[1] | {(6, "UNIQUE", "uq"), (7, "UNIQUE", "uq")}


def test_refused_rows_claim_no_key(spark, source, parents):
    add, stream = source
    stored = spark.createDataFrame([(4, 9), (4, 9), (None, 2)], "key bigint, value bigint")
    add((1, minute(0), 9, 5), (2, minute(0), 1, -5), (3, minute(0), 1, None), (4, minute(0), 4, 9))
    add((5, minute(1), 1, 7), (6, minute(1), None, 7), (7, minute(1), None, 7))
    add((8, minute(2), 9, 5))
    accepted, refused = unique_run(stream, run_folder(spark, "unique"), stored=stored, parents=parents)
    assert accepted == [5, 6, 7]  # a NULL in the key clashes with nothing
    assert refused == {(1, "FOREIGN KEY", "fk"), (2, "CHECK", "chk"), (3, "NOT NULL", "nn_value"), (4, "UNIQUE", "uq"),
                       (8, "FOREIGN KEY", "fk")}


def test_state_expires_with_the_watermark(spark, source, parents):
    add, stream = source
    folder = run_folder(spark, "unique")
    add((1, minute(0), 1, 5))
    add((2, minute(50), 1, 5))  # within an hour of the first
    add((3, minute(300), 2, 5))  # moves the watermark to minute 240
    add((6, minute(300), 4, 5))  # the batch that lets the key go
    add((4, minute(301), 1, 5))
    add((5, minute(10), 3, 5))  # older than the watermark
    accepted, refused = unique_run(stream, folder, parents=parents)
    assert accepted == [1, 3, 4, 6] and {r[0] for r in refused} == {2, 5}


def test_unique_equals_one_pass_over_everything(spark, source, parents):
    add, stream = source
    folder = run_folder(spark, "unique")
    rows = [(i, minute(i % 50), (i * 7) % 6, (i * 11) % 5) for i in range(120)]
    for first in range(0, 120, 40):
        add(*rows[first:first + 40])
        accepted, _ = unique_run(stream, folder, "2 hours", parents=parents)
    best = {}
    for i, _, key, value in rows:
        if value > 0 and key < 5:
            best.setdefault((key, value), i)
    assert accepted == sorted(best.values())


@pytest.fixture
def merged(spark, source):
    """A table over three batches, and what it must hold."""
    add, stream = source
    folder = run_folder(spark, "merged")
    current = spark.createDataFrame([(1, 0), (3, 0)], "key bigint, value bigint")

    def run(*rows):
        add(*rows)
        return jobs.stream_upserted(stream(), "at", "1 day", "id", "key", ["value"], current, "id", folder)

    run((1, minute(0), 1, 10))
    run((2, minute(1), 2, 20), (3, minute(1), 1, 11))
    return run, run((4, minute(2), 1, 12), (5, minute(2), 4, 40))


HELD = {(1, 12), (2, 20), (3, 0), (4, 40)}


def held(table):
    return {(r.key, r.value) for r in table.read().collect()}


def opened(table):
    """Versions read, and whether batches are read beside them."""
    parts = [part for path in table.read().inputFiles() for part in path.split("/")]
    return {p for p in parts if p.startswith("v0")}, any(p.startswith("batch=") for p in parts)


def test_a_read_opens_the_log_since_the_last_version(merged):
    run, table = merged
    assert held(table) == HELD and opened(table) == ({"v00000000"}, True)
    first = table.compact()
    assert held(table) == HELD and opened(table) == ({f"v{first:08d}"}, False)
    assert table.compact() == first  # nothing new
    table = run((6, minute(3), 2, 21))
    after = {(1, 12), (2, 21), (3, 0), (4, 40)}
    assert held(table) == after and opened(table) == ({f"v{first:08d}"}, True)
    assert all(int(path.split("batch=")[1].split("/")[0]) >= first for path in table.log()[0].inputFiles())
    second = table.compact()
    table.clean()
    assert second > first and held(table) == after and opened(table) == ({f"v{second:08d}"}, False)
    assert held(run((7, minute(4), 9, 90))) == after | {(9, 90)}


def test_a_compaction_that_breaks_off_changes_nothing(spark, merged, monkeypatch):
    run, table = merged

    def broken(version):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch, pytest.raises(RuntimeError):
        patch.setattr(table.versions, "switch", broken)
        table.compact()
    assert table.versions.current() == 0 and held(table) == HELD  # written, not switched to
    table = run((6, minute(3), 3, 31))
    after = {(1, 12), (2, 20), (3, 31), (4, 40)}
    assert held(table) == after
    assert table.compact() > 0 and held(table) == after


def test_unfinished_batches_are_not_read(spark, merged):
    _, table = merged
    spark.createDataFrame([(9, minute(9), 9, 9)], SCHEMA).write.option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{table.folder}/rows/batch=99")
    assert held(table) == HELD and table.compact() < 99
