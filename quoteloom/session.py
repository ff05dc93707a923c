"""Session settings the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Needed for right results: every timestamp in the data model is a UTC instant, and a repeated
# JSON key keeps its last value.
REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.variant.allowDuplicateKeys": "true",
}

# Needed for large data: AQE re-plans joins from measured sizes, splits skewed join partitions even
# where the split costs a further shuffle, and merges small partitions after each shuffle.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}

# PySpark records the Python call site of every column expression for its error messages; building
# the plans here takes several times as long with it.
PLANNING = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings above to a running session; memory and parallelism stay the cluster's."""
    for key, value in {**REQUIRED, **ADAPTIVE}.items():
        spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "quoteloom", master: str | None = None, **conf: str) -> SparkSession:
    """Create a tuned session. Extra settings are passed with dots as double underscores."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**REQUIRED, **ADAPTIVE, **PLANNING}.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return tune(builder.getOrCreate())
