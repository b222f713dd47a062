"""Session settings the library is written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Everything here is a runtime re-planning or determinism setting. Cluster sizing (executors,
# shuffle partitions, checkpoint folder) belongs to whoever submits the job.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app: str = "tallyfield", master: str | None = None, **conf: str) -> SparkSession:
    """Get or create a session; ``conf`` keys use ``__`` where Spark uses a dot."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    overrides = {key.replace("__", "."): str(value) for key, value in conf.items()}
    for key, value in {**SETTINGS, **overrides}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
