"""Session helpers: where lineage may be cut, and settings every plan relies on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder. The cluster names it in spark.checkpoint.dir; only where nothing is
    set and all work is done on one machine (tests, a laptop) is a folder of our own used."""
    have = spark.sparkContext._jsc.sc().getCheckpointDir()
    if have.isDefined():
        return have.get()
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        named = tempfile.mkdtemp(prefix="tallymark-ckpt-")
    spark.sparkContext.setCheckpointDir(named)
    return named


def write_once(df: DataFrame) -> str:
    """The path of df written as a table in the shared checkpoint folder; it is removed when the session ends."""
    spark = df.sparkSession
    at = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{uuid.uuid4().hex}"
    df.write.parquet(at)
    path = spark._jvm.org.apache.hadoop.fs.Path(at)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return at


def materialise(df: DataFrame) -> DataFrame:
    """df written as a table in the shared checkpoint folder and read back: computed once, pruned to the
    columns a reader needs, with sizes the planner knows. For results that several steps use."""
    return df.sparkSession.read.schema(df.schema).parquet(write_once(df))


def spread(df: DataFrame) -> DataFrame:
    """df with at least as many partitions as there are cores, for work in Python that dwarfs the
    reading. A scan that already has them - any large table - is left as it is, without a shuffle."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    run = df._jdf.queryExecution()
    if "AdaptiveSparkPlan" in run.executedPlan().toString():  # after a shuffle; asking would run it
        return df
    return df.repartition(cores) if run.toRdd().getNumPartitions() < cores else df
