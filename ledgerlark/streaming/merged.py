"""A keyed table kept as a version and a log of micro-batches, merged when it is read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerlark.operators import changes
from ledgerlark.sources import folders
from ledgerlark.sources.sinks import VersionedTable

BATCH = "batch="


class MergedTable:
    """Upserts of a stream over a base.

    A micro-batch only adds a folder to the log, so its cost does not grow with the table.
    Version n of the base has all batches below n in it, so a reader opens the current
    version and the folders from its number on, and what a read costs depends on the log
    since the last version. ``compact`` folds the log into the next version and then
    switches to it by one new empty file: before that file is there readers merge the old
    version with the same log, after it the new one with what has come since, and both give
    the same rows. A compaction that broke off is simply done again.
    """

    def __init__(self, spark: SparkSession, folder: str, log_schema: StructType, key: str, columns: list[str], sequence: str):
        self.spark, self.folder = spark, folder
        self.key, self.columns, self.sequence = key, columns, sequence
        self.schema = StructType(list(log_schema.fields)).add("batch", "long")
        self.versions = VersionedTable(spark, f"{folder}/base")

    def start(self, base: DataFrame) -> None:
        """Make ``base`` version 0, unless there is a version already."""
        if self.versions.current() is None:
            self.versions.write(base, 0)
            self.versions.switch(0)

    def _batches(self) -> list[tuple[int, str]]:
        """Number and folder of every batch that was written to its end."""
        rows = f"{self.folder}/rows"
        found = [name for name in folders.names(self.spark, rows) if name.startswith(BATCH)]
        done = [name for name in found if folders.exists(self.spark, f"{rows}/{name}/_SUCCESS")]
        return sorted((int(name.removeprefix(BATCH)), f"{rows}/{name}") for name in done)

    def log(self) -> tuple[DataFrame | None, int]:
        """The batches that the current version lacks, and the version that has them all."""
        folded = self.versions.current()
        fresh = [(number, path) for number, path in self._batches() if number >= folded]
        if not fresh:
            return None, folded
        read = self.spark.read.schema(self.schema).option("basePath", f"{self.folder}/rows")
        return read.parquet(*[path for _, path in fresh]), fresh[-1][0] + 1

    def _merged(self) -> tuple[DataFrame, int]:
        log, version = self.log()
        base = self.versions.read()
        if log is None:
            return base, version
        ordered = log.withColumn("_order", F.struct("batch", self.sequence))
        return changes.upsert_update(base, ordered, self.key, self.columns, "_order"), version

    def read(self) -> DataFrame:
        return self._merged()[0]

    def compact(self) -> int:
        """Fold the log into the next version and switch to it; the version that is current then."""
        merged, version = self._merged()
        if version > self.versions.current():
            self.versions.write(merged, version)
            self.versions.switch(version)
        return version

    def clean(self) -> None:
        """Delete versions and batches that the current version replaces, once no reader has them open."""
        current = self.versions.current()
        self.versions.remove_before(current)
        for number, path in self._batches():
            if number < current:
                folders.delete(self.spark, path)
