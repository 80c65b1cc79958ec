"""Raw declaration files: gzip text, one or more for each reporter and year.

Finding and checking files lists directories on the driver (names only); reading is one lazy scan for
each separator. A gzip file is one task; rows are spread after the filters, not before.
"""

from __future__ import annotations

import gzip
import logging
import os
import re
import zlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.schema import resolve

# Form of a file's name. Reporter and year; the reporter is as short as the pattern allows.
NAME = re.compile(r"CA(\d+?)(\d{4})H\d", re.I)
log = logging.getLogger("tallymark")
MAGIC = b"\x1f\x8b"


@dataclass(frozen=True)
class RawFile:
    path: str
    reporter: int
    year: str
    sep: str
    columns: tuple[str, ...]


def valid_gzip(path: str) -> bool:
    """At least three bytes, the first two gzip's magic."""
    try:
        with open(path, "rb") as f:
            head = f.read(3)
    except OSError:
        return False
    return len(head) == 3 and head[:2] == MAGIC


def sweep_corrupt(folder: str) -> list[str]:
    """Removes files named .gz that are none; their paths."""
    bad = [os.path.join(folder, n) for n in sorted(os.listdir(folder)) if n.endswith(".gz") and not valid_gzip(os.path.join(folder, n))]
    for p in bad:
        os.remove(p)
    return bad


def sniff_sep(header: str) -> str:
    return "\t" if "\t" in header else ","


def _header(path: str) -> str:
    with gzip.open(path, "rt", encoding="utf-8", errors="replace") as f:
        return f.readline().lstrip("﻿").rstrip("\r\n")


def index_files(folders: list[str], year: str, validate: bool = True) -> dict[int, list[str]]:
    """Reporter -> valid files of a year, by one scan of each folder; folders of lower order only add reporters."""
    out: dict[int, list[str]] = {}
    for folder in folders:
        here: dict[int, list[str]] = {}
        if not os.path.isdir(folder):
            continue
        for e in sorted(os.scandir(folder), key=lambda e: e.name):
            m = NAME.search(e.name)
            if m and e.name.lower().endswith(".gz") and m[2] == year and (not validate or valid_gzip(e.path)):
                here.setdefault(int(m[1]), []).append(e.path)
        for r, paths in here.items():
            out.setdefault(r, paths)
    return out


def discover(root: str, year: str, targets: set[int] | None = None, unreadable: list[str] | None = None) -> list[RawFile]:
    """Readable files of a year, in root/<year> or root, by reporter. Files whose header cannot be read are logged and
    put into `unreadable`."""
    found = []
    for reporter, paths in sorted(index_files([os.path.join(root, year), root], year).items()):
        if targets is not None and reporter not in targets:
            continue
        for p in paths:
            try:
                head = _header(p)
            except (OSError, EOFError, zlib.error) as e:
                log.warning("%s cannot be read: %s", p, e)
                if unreadable is not None:
                    unreadable.append(p)
                continue
            sep = sniff_sep(head)
            found.append(RawFile(p, reporter, year, sep, tuple(c.strip().strip('"') for c in head.split(sep))))
    return found


def scan(spark: SparkSession, files: list[RawFile]) -> DataFrame:
    """All rows as text in the canonical columns, with _src_file and _src_pos (order of the file).

    Files with one header are read together; missing columns are null, unreadable bytes replaced."""
    groups: dict[tuple[str, tuple[str, ...]], list[str]] = {}
    for f in files:
        groups.setdefault((f.sep, f.columns), []).append(f.path)
    if not groups:
        raise FileNotFoundError("no raw files")
    out = None
    for (sep, columns), paths in sorted(groups.items()):
        schema = ", ".join(f"`{c}` string" for c in columns)
        df = spark.read.schema(schema).csv(paths, sep=sep, header=True, multiLine=False, mode="PERMISSIVE", enforceSchema=True)
        # A partition reads its files one after the other, so this number rises within a file.
        df = df.withColumns({"_src_file": F.col("_metadata.file_path"), "_src_pos": F.monotonically_increasing_id()})
        df = resolve(df)
        out = df if out is None else out.unionByName(df)
    return out


def with_row_ids(df: DataFrame, name: str = "id") -> DataFrame:
    """A dense id 1..n in the order of (file, position): files are numbered by their sizes, so no sort spans files."""
    from pyspark.sql import Window

    sizes = df.groupBy("_src_file").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select("_src_file", F.coalesce(F.sum("_n").over(Window.orderBy("_src_file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    rank = F.row_number().over(Window.partitionBy("_src_file").orderBy("_src_pos"))
    return df.withColumn("_r", rank).join(before, "_src_file").withColumn(name, (F.col("_r") + F.col("_before")).cast("bigint")).drop("_r", "_before")


def revision_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Tables of a folder by stem: csv, txt and tsv by sniffed separator, xlsx through pandas where it can be read."""
    out = {}
    for name in sorted(os.listdir(folder)):
        stem, ext = os.path.splitext(name)
        path = os.path.join(folder, name)
        if ext.lower() in (".csv", ".txt", ".tsv"):
            with open(path, encoding="utf-8", errors="replace") as f:
                head = f.readline()
            sep = "\t" if "\t" in head else ";" if head.count(";") > head.count(",") else ","
            out[stem] = spark.read.csv(path, sep=sep, header=True, inferSchema=False, ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True)
        elif ext.lower() in (".xlsx", ".xls"):
            try:
                import pandas as pd

                out[stem] = spark.createDataFrame(pd.read_excel(path, dtype=str).astype(object).where(lambda x: x.notna(), None))
            except ImportError as e:
                log.warning("%s is left out: %s", path, e)
    return out
