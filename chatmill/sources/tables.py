"""Parquet tables of a dataset folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def path(folder: str, name: str) -> str:
    return f"{folder.rstrip('/')}/{name}.parquet"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(path(folder, name))
