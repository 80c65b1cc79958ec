"""Raw record lines as they arrive: a file stream that takes up what is new and stops.

The checkpoint names the files that were taken, so a run after a failure neither loses nor repeats
any; each batch appends parsed rows and rejected rows, and a batch that is run again replaces itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.operators.rowparse import parse_rows, rejected_rows, typed_rows

LINES = T.StructType([T.StructField("raw_id", T.LongType()), T.StructField("file_name", T.StringType()), T.StructField("line_no", T.IntegerType()), T.StructField("line", T.StringType())])


def load_new(spark: SparkSession, source: str, target: str, checkpoint: str, files_per_batch: int = 1000) -> int:
    """Parses the Parquet files of record lines in source that were not taken before; the number of batches."""

    def batch(df: DataFrame, n: int) -> None:
        df.persist()
        try:
            parsed = parse_rows(df)
            typed_rows(parsed).write.mode("overwrite").parquet(f"{target}/rows/batch={n}")
            rejected_rows(parsed).write.mode("overwrite").parquet(f"{target}/rejected/batch={n}")
        finally:
            df.unpersist()

    lines = spark.readStream.schema(LINES).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    q = lines.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return sum(1 for p in q.recentProgress if p.numInputRows)


def arrivals_by_load(declarations: DataFrame, late: str = "1 day", width: str = "1 hour") -> DataFrame:
    """Rows of a declarations stream by load and hour of arrival, closed by a watermark on loaded_at."""
    at = F.col("loaded_at").cast("timestamp")
    return declarations.select(at.alias("at"), "load_no").withWatermark("at", late).groupBy(F.window("at", width), "load_no").agg(F.count(F.lit(1)).alias("n"))
