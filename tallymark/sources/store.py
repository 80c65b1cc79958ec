"""Written datasets: partitioned Parquet, replaced partition by partition; text where it is asked for."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Rows that a JSON document of statistics may have.
STATS_ROWS = 1_000_000


def write_year(df: DataFrame, path: str, year: str, by: tuple[str, ...] = (), codec: str = "zstd") -> None:
    """The rows of a year, in place of all that was written for it. Rows are brought together by the columns that
    part the files; how many tasks write, and how a hot value is split, goes by size (spark.sql.adaptive)."""
    rows = df.drop("year")
    rows = rows.hint("rebalance", *by) if by else rows.hint("rebalance")
    out = rows.write.mode("overwrite").option("compression", codec)
    (out.partitionBy(*by) if by else out).parquet(f"{path}/year={year}")


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    """A dataset that holds something committed (replacing partitions leaves no mark of its own)."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(p) and any(not e.getPath().getName().startswith((".", "_temporary")) for e in fs.listStatus(p))


def first_existing(spark: SparkSession, paths: list[str]) -> str | None:
    return next((p for p in paths if exists(spark, p)), None)


def write_text(df: DataFrame, path: str, gzip: bool = False) -> None:
    """Comma separated text with a header."""
    df.write.mode("overwrite").option("header", True).option("compression", "gzip" if gzip else "none").csv(path)


def write_concordance(df: DataFrame, path: str) -> None:
    """Sorted text, weights with four decimals."""
    cols = [F.format_string("%.4f", F.col("weight")).alias("weight") if c == "weight" else F.col(c) for c in df.columns]
    df.orderBy("from_revision", "from_code", "to_code").select(*cols).coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def stats_document(df: DataFrame) -> list[dict]:
    """Rows of a small statistics table as dictionaries, for a JSON document; a large table is an error."""
    rows = df.limit(STATS_ROWS + 1).collect()
    if len(rows) > STATS_ROWS:
        raise ValueError(f"statistics of more than {STATS_ROWS} rows")
    return [r.asDict(recursive=True) for r in rows]


def merge_documents(old: list[dict], new: list[dict], keys: tuple[str, ...]) -> list[dict]:
    """Statistics of new, and of old where new has none for the keys, in order of the keys."""
    of = lambda d: tuple(d.get(k) for k in keys)
    have = {of(d) for d in new}
    return sorted([*new, *[d for d in old if of(d) not in have]], key=lambda d: str(of(d)))
