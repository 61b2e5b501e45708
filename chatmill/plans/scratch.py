"""Tables written to the folder that all executors share, so that iterative operators survive a lost executor."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Where that is unset a temporary one is made on a single machine; a cluster must name one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="chatmill-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


class Scratch:
    """Named tables of one run of an operator.

    They are removed when the application ends, since the frame an operator returns may still read them;
    tables an operator no longer needs it drops itself.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/chatmill-{label}-{uuid.uuid4().hex}"
        self.schemas: dict[str, StructType] = {}
        atexit.register(self._remove, self.root)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def save(self, name: str, frame: DataFrame) -> DataFrame:
        frame.write.mode("overwrite").option("compression", "zstd").parquet(self.path(name))
        self.schemas[name] = frame.schema
        return self.read(name)

    def read(self, *names: str) -> DataFrame:
        return self.spark.read.schema(self.schemas[names[0]]).parquet(*[self.path(n) for n in names])

    def drop(self, *names: str) -> None:
        for n in names:
            self._remove(self.path(n))

    def _remove(self, path: str) -> None:
        try:
            jvm = self.spark._jvm
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(target, True)
        except Exception:  # the JVM may have ended before
            pass
