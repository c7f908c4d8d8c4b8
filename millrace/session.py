"""Session settings shared by the library, the tests and the benchmark."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings that may be changed while a session runs. Adaptive execution sizes the
# shuffles from the bytes written, so the same code serves 60 thousand rows and 100 TB.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(master: str | None = None, app: str = "millrace",
                  partitions: int | None = None, **extra: str) -> SparkSession:
    """Create (or get) a session. On a cluster leave ``master`` and ``partitions`` unset."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in RUNTIME_SETTINGS.items():
        builder = builder.config(key, value)
    if partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    builder = builder.config("spark.ui.showConsoleProgress", "false")
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to a session that somebody else created."""
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark
