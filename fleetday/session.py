"""A session with the settings the engine is written for. Any other Spark session works too."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # runtime re-planning: partition sizes, skewed join partitions, measured broadcasts
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # keep a skewed join split even where the split needs one more shuffle behind it
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}


def local_session(cpus: int, memory: str = "12g", app: str = "fleetday") -> SparkSession:
    """A single-machine session with as many shuffle partitions as threads."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cpus))
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def cluster_session(app: str = "fleetday", shuffle_partitions: int | None = None) -> SparkSession:
    """A session on the cluster's own master.

    The shuffle partitions, if given, are an upper bound, as AQE joins the small ones: at 100 TB of
    input 20,000 keep one partition of the widest shuffle near 200 MB.
    """
    builder = SparkSession.builder.appName(app)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
