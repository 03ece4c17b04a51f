"""Session settings the jobs are planned for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Runtime settings only, so they can be applied to a session that runs already.
SETTINGS = {
    # Overflow must fail or give NULL where asked for, and products must round once.
    "spark.sql.ansi.enabled": "true",
    "spark.sql.decimalOperations.allowPrecisionLoss": "true",
    "spark.sql.adaptive.enabled": "true",
    # Split skewed join partitions even where that costs one more shuffle: an
    # account, asset or currency may hold a large part of all rows.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A row per account becomes one per account and asset within a stage, so the
    # stage's input is kept small.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    # Streaming state (transaction ids, prices) lives on disk beside the executors.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # Timestamps carry no time zone; comparisons must not depend on one.
    "spark.sql.session.timeZone": "UTC",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings; a value the user has set for the application stays."""
    chosen = spark.sparkContext.getConf()
    for key, value in SETTINGS.items():
        if not chosen.contains(key):
            spark.conf.set(key, value)
    return spark
