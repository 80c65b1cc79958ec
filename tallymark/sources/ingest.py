"""Fetching raw files: a driver-side loop around an injected fetch(code, year, folder)."""

from __future__ import annotations

import os
import time
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.sources.manifest import Manifest
from tallymark.sources.raw import index_files, sweep_corrupt

TRANSIENT = (ConnectionError, TimeoutError, OSError)


def fetch_one(fetch: Callable[[int, str, str], None], code: int, year: str, folder: str, attempts: int = 3, pause: float = 0.1, sleep: Callable[[float], None] = time.sleep) -> bool:
    """True if a valid file is there afterwards. Transient faults are tried again after 1, 2, 4 ... seconds."""
    os.makedirs(folder, exist_ok=True)
    for n in range(attempts):
        try:
            fetch(code, year, folder)
            break
        except TRANSIENT:
            if n + 1 < attempts:
                sleep(2.0**n)
        except Exception:  # noqa: BLE001  a permanent fault of one reporter does not end the run
            break
    sleep(pause)
    sweep_corrupt(folder)
    return code in index_files([folder], year)


def retrieve(spark: SparkSession, fetch, codes: Iterable[int], years: Iterable[str], root: str, manifest: Manifest | None = None, **kw) -> DataFrame:
    """(year, reporterCode, status): cached, downloaded or missing."""
    rows = []
    for year in years:
        folder = os.path.join(root, year)
        have = index_files([folder, root], year)
        for code in codes:
            if code in have:
                rows.append((year, code, "cached"))
                continue
            if manifest:
                manifest.put("in_flight", {"year": year, "reporter": code})
            rows.append((year, code, "downloaded" if fetch_one(fetch, code, year, folder, **kw) else "missing"))
            if manifest:
                manifest.drop("in_flight")
    return spark.createDataFrame(rows, "year string, reporterCode int, status string")


def summary(status: DataFrame) -> DataFrame:
    """(year, expected, cached, downloaded, missing, missing_reporters): the codes of a year are a bounded dimension."""
    n = lambda v: F.count_if(F.col("status") == v).alias(v)
    return status.groupBy("year").agg(F.count(F.lit(1)).alias("expected"), n("cached"), n("downloaded"), n("missing"), F.sort_array(F.collect_list(F.when(F.col("status") == "missing", F.col("reporterCode")))).alias("missing_reporters"))
