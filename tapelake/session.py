"""Session settings the jobs rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Runtime settings only, so that they can also be put on a session somebody else built.
RUNTIME_CONF = {
    # Every timestamp rule of the lake is a UTC rule.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A join side is broadcast if Spark's size estimate for it is below this; otherwise both sides are shuffled.
    "spark.sql.autoBroadcastJoinThreshold": str(32 << 20),
    # Hot instruments: split oversized join partitions, also where that costs one more shuffle.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Hot (day, bucket) pairs: split oversized partitions before a write.
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session.

    Broadcast joins are left to the size check of ``spark.sql.autoBroadcastJoinThreshold``; no job of the library forces one.
    """
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(app: str = "tapelake", cores: int | str = 8, shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
