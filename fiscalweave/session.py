"""Session settings the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

_RUNTIME = {
    # Re-plan joins on measured sizes, split hot partitions even where that costs one more shuffle.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Hash joins spare the sort of the large side where a shuffled side turns out small per task.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session; safe to call again."""
    for key, value in _RUNTIME.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: str = "*", shuffle_partitions: int = 8,
                  app: str = "fiscalweave") -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    spark = (SparkSession.builder.master(f"local[{cores}]").appName(app)
             .config("spark.ui.enabled", "false")
             .config("spark.driver.memory", "12g")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
             # Recording a Python stack per column expression costs more than planning it.
             .config("spark.python.sql.dataFrameDebugging.enabled", "false")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)
