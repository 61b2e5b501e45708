"""Session settings the engine expects, and the factory used by tests, bench and command line."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Settings that change results or plans; everything about resources is left to the cluster.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cpus: int = 8, shuffle_partitions: int = 8, memory: str = "12g", **extra: str) -> SparkSession:
    """A single-machine session; on a cluster take the session that is there."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("chatmill")
    conf = SETTINGS | {
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.driver.memory": memory,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.host": "127.0.0.1",
    }
    spark = builder.config(map=conf | extra).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
