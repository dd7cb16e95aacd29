"""Session settings the operators are tuned for."""

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where the grouping after the join then needs a shuffle of its own.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.ui.enabled": "false",
}


def local_session(cpus: str | int = "*", **extra: str) -> SparkSession:
    """Single-machine session for tests and benchmarks; shuffle partitions follow the cores."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("territory-analytics")
    partitions = str(cpus) if str(cpus).isdigit() else "8"
    for key, value in {**SETTINGS, "spark.sql.shuffle.partitions": partitions, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
