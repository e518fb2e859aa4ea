"""Session settings the package is written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

RECOMMENDED = {
    # Naive timestamps are formatted and compared without zone shifts.
    "spark.sql.session.timeZone": "UTC",
    # Store ids such as 0012 stay strings when they come back from a path.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A skewed join is split even where the split costs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # State of streams on local disk with checkpoints, not in executor memory.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.ui.enabled": "false",
}


def build_session(app_name: str = "billweave", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
