"""Where intermediate tables go, and when they go away.

The cluster names a shared folder in ``spark.checkpoint.dir``. Only a session inside one
process gets a folder of its own without that setting, because there driver and
executors share one machine. Everything a session writes lies below one folder of its
application, which is deleted when the process ends; ``scope`` deletes earlier what was
written inside it.
"""

from __future__ import annotations

import atexit
import gc
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, suppress

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_SETTING = "spark.checkpoint.dir"

# Folders made for local sessions without the setting, by application.
_LOCAL: dict[str, str] = {}

# Folders handed out and not yet deleted, in order, with the session to delete them by.
_OPEN: dict[str, SparkSession] = {}


def shared_folder(spark: SparkSession) -> str:
    """The shared folder of this session."""
    named = spark.conf.get(_SETTING, None)
    if named:
        return named.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError(f"set {_SETTING} to a folder all executors can reach")
    application = spark.sparkContext.applicationId
    if application not in _LOCAL:
        _LOCAL[application] = tempfile.mkdtemp(prefix="ledgerlark-")
    return _LOCAL[application]


def run_folder(spark: SparkSession, label: str) -> str:
    """A path nobody else uses, below the shared folder."""
    application = spark.sparkContext.applicationId
    path = f"{shared_folder(spark)}/ledgerlark/{application}/{label}-{uuid.uuid4().hex}"
    _OPEN[path] = spark
    return path


def _delete(path: str) -> None:
    spark = _OPEN.pop(path)
    with suppress(Exception):  # the session may have ended before
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def discard(path: str) -> None:
    """Delete a folder handed out earlier, once nothing reads it any more."""
    if path in _OPEN:
        _delete(path)


@contextmanager
def scope() -> Iterator[None]:
    """Delete at the end what was written inside; results must have been used by then."""
    before = set(_OPEN)
    try:
        yield
    finally:
        for path in [path for path in _OPEN if path not in before]:
            _delete(path)


@atexit.register
def clear() -> None:
    """Delete all that is left."""
    for path in list(_OPEN):
        _delete(path)


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffles and broadcasts that nothing refers to any more.

    Its cleaner learns of them only when the driver collects its garbage, which a loop of
    many small jobs may not cause for long; until then they fill memory and disks.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and read it back.

    Cuts the lineage with a table that outlives lost executors, so values that
    depend on how rows were split over tasks stay the same in every later use.
    """
    spark = df.sparkSession
    path = run_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialize_counted(df: DataFrame, label: str) -> tuple[DataFrame, int]:
    """The same, with the number of rows, counted while they are written."""
    spark, seen = df.sparkSession, Observation()
    path = run_folder(spark, label)
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), seen.get["n"]
