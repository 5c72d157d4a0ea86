"""Writing labelled results and table versions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerlark.sources.scratch import run_folder


def write_report(spark: SparkSession, results: dict[str, DataFrame]) -> DataFrame:
    """Write each result as parquet and return the manifest, one row per result.

    Rows are counted while they are written, so no result is computed twice.
    """
    folder = run_folder(spark, "report")
    lines = []
    for label, df in results.items():
        path = f"{folder}/{label.replace(' ', '-')}"
        seen = Observation()
        df.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(path)
        lines.append((label, seen.get["n"], ",".join(df.columns), path, spark.version))
    manifest = spark.createDataFrame(
        lines, "label string, row_count long, columns string, path string, spark_version string"
    )
    manifest.coalesce(1).write.parquet(f"{folder}/manifest")
    return manifest


class VersionedTable:
    """A table whose changes are new folders, numbered by the caller.

    Writing a version again replaces it, so a repeated change has no second effect,
    and readers keep the version they opened. What ``read`` opens is the version last
    switched to: a switch is one new empty file, so it happens wholly or not at all,
    and only a version that was written to its end can be switched to.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def path(self, version: int) -> str:
        return f"{self.folder}/v{version:08d}"

    def _place(self, path: str):
        place = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return place, place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def current(self) -> int | None:
        """The version last switched to."""
        place, files = self._place(f"{self.folder}/switched")
        if not files.exists(place):
            return None
        return max((int(status.getPath().getName()) for status in files.listStatus(place)), default=None)

    def switch(self, version: int, broken: dict[str, DataFrame] | None = None) -> None:
        """Let readers open ``version``, unless it is unfinished or a check finds broken rows."""
        done, files = self._place(f"{self.path(version)}/_SUCCESS")
        if not files.exists(done):
            raise ValueError(f"version {version} was not written to its end")
        for name, rows in (broken or {}).items():
            if not rows.isEmpty():
                raise ValueError(f"version {version} refused: {name}")
        if self.current() is not None and version < self.current():
            raise ValueError(f"version {version} is older than the current one")
        place, files = self._place(f"{self.folder}/switched/{version:08d}")
        files.create(place, True).close()

    def read(self) -> DataFrame:
        """The current version."""
        version = self.current()
        if version is None:
            raise ValueError("no version was switched to")
        return self.spark.read.parquet(self.path(version))

    def remove_before(self, version: int) -> None:
        """Delete the versions below ``version``, which no reader may have open any more."""
        place, files = self._place(self.folder)
        for status in files.listStatus(place):
            name = status.getPath().getName()
            if name.startswith("v") and int(name[1:]) < min(version, self.current() or 0):
                files.delete(status.getPath(), True)

    def write(self, df: DataFrame, version: int) -> DataFrame:
        """Write a version and return it as read back."""
        df.write.mode("overwrite").parquet(self.path(version))
        return self.spark.read.schema(df.schema).parquet(self.path(version))
