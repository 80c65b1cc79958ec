"""Parquet tables of one data directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def version(spark: SparkSession, sf_dir: str, name: str) -> tuple[str, int, int]:
    """Place, time of change and size of a table, which tell two states of it apart."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{name}.parquet")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return str(path), fs.getFileStatus(path).getModificationTime(), fs.getContentSummary(path).getLength()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
