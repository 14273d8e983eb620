"""Session settings the jobs are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# AQE picks broadcast joins from measured sizes, splits skewed join partitions
# and merges small shuffle partitions, so no job here hard-codes those choices.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A shuffled join hashes one side instead of sorting both when every measured
    # partition of that side is below this size; larger ones stay sort-merge.
    # Spark heeds it only if it is not below the advisory partition size.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    # File sizes understate tables whose columns encode well: a 10 MB file can be 150 MB
    # in memory.  Estimating ten times the file keeps such tables out of broadcasts.
    "spark.sql.sources.fileCompressionFactor": "10",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def local_session(cores: int | str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("starmart")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
    )
    for key, value in RECOMMENDED_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
