"""Session settings used by the tests and the bench.

On a cluster the session is the caller's own; nothing in the package depends on
these values except the UTC clock for reading timestamps as instants.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


def local_session(cores: str = "8", app: str = "ledgerlark", **extra: str) -> SparkSession:
    """A local session; ``extra`` settings win over the defaults."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    settings = dict(SETTINGS)
    settings["spark.sql.shuffle.partitions"] = cores if cores.isdigit() else "8"
    settings.update(extra)
    for name, value in settings.items():
        builder = builder.config(name, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session
