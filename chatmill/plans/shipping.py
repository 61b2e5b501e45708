"""Sends the package to the executors, which needn't have it installed."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession


def ship(spark: SparkSession) -> None:
    """Adds the package as an archive that the driver serves; once for each context."""
    context = spark.sparkContext
    if getattr(context, "_chatmill_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="chatmill-code-"), "chatmill.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.join("chatmill", os.path.relpath(full, root)))
    context.addPyFile(archive)
    context._chatmill_shipped = True
