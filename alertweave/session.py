"""Session settings every operator relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

RUNTIME_CONF = {
    # one time zone on every executor and in every text conversion
    "spark.sql.session.timeZone": "UTC",
    # later map entries win when two maps are concatenated
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # hot join keys are split at run time, even if that costs one more shuffle
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# settings a session takes only when it is built; give them to spark-submit on a cluster
BUILD_CONF = {
    # the Python line of every column in error messages; it slows planning of wide plans
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session that somebody else built."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: int = 8, name: str = "alertweave", **conf: str) -> SparkSession:
    """A local session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in {**RUNTIME_CONF, **BUILD_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder the cluster names; where none is set, one in Spark's own warehouse."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    return named or f"{spark.conf.get('spark.sql.warehouse.dir')}/checkpoints"
