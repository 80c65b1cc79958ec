"""One canonical row for each side of a matched pair: the lowest id among rows of all transport modes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sides(matched: DataFrame) -> DataFrame:
    """(matched_id, dom_x, dom_m) of rows that carry their pair's id."""
    every = F.coalesce(F.trim(F.col("motCode").cast("string")), F.lit("")) == "0"
    lowest = lambda f: F.min(F.when(every & (F.col("flowCode") == f), F.col("id")))
    return matched.filter("matched_id is not null").groupBy("matched_id").agg(lowest("X").alias("dom_x"), lowest("M").alias("dom_m"))


def dominant(numbered: DataFrame) -> DataFrame:
    """(matched_id, flowCode, dom_id) of numbered groups."""
    sides = F.array(*[F.struct(F.lit(f).alias("flowCode"), F.col(c).alias("dom_id")) for f, c in (("X", "dom_x"), ("M", "dom_m"))])
    return numbered.select("matched_id", F.inline(sides)).filter("dom_id is not null")


def kept_pairs(numbered: DataFrame) -> DataFrame:
    """(matched_id) with a canonical row on both sides."""
    return numbered.filter("dom_x is not null and dom_m is not null").select("matched_id")


def clean(matched: DataFrame, by: tuple[str, ...] = ("matched_id",)) -> DataFrame:
    """Two rows for each pair that has a canonical row on both sides.

    One aggregate carries the whole row of the lowest id for either side, so the declarations are
    shuffled once, already reduced, and joined with nothing."""
    sides = both_rows(matched.filter("matched_id is not null"), matched.columns, by).filter("_x is not null and _m is not null")
    return sides.select(F.explode(F.array("_x", "_m")).alias("_r")).select("_r.*")


def row_of(columns: list[str], flow: str):
    """Aggregate: the row of the lowest id among a side's rows of all transport modes."""
    every = F.coalesce(F.trim(F.col("motCode").cast("string")), F.lit("")) == "0"
    return F.min_by(F.struct(*[F.col(f"`{c}`") for c in columns]), F.when(every & (F.col("flowCode") == flow), F.col("id")))


def both_rows(df: DataFrame, columns: list[str], by: tuple[str, ...]) -> DataFrame:
    return df.groupBy(*by).agg(row_of(columns, "X").alias("_x"), row_of(columns, "M").alias("_m"))


def clean_of_groups(numbered: DataFrame) -> DataFrame:
    """The rows of `clean` from numbered groups that carry _x and _m."""
    kept = numbered.filter("_x is not null and _m is not null").select("matched_id", F.explode(F.array("_x", "_m")).alias("_r"))
    return kept.select("_r.*", "matched_id")


def coverage(numbered: DataFrame) -> DataFrame:
    """(pairs_case_a, pairs_case_b, pairs_case_c, rows_summed, output_pairs) over pairs with a canonical row."""
    x, m = F.col("dom_x").isNotNull(), F.col("dom_m").isNotNull()
    zero = F.lit(0).cast("bigint")
    return numbered.agg(F.count_if(x & m).alias("pairs_case_a"), F.count_if(x != m).alias("pairs_case_b"), zero.alias("pairs_case_c"), zero.alias("rows_summed"), F.count_if(x & m).alias("output_pairs"))


def clean_or_passthrough(matched: DataFrame) -> DataFrame:
    """clean, or the rows as they are where a needed column is missing."""
    return clean(matched) if {"matched_id", "flowCode", "motCode", "id"} <= set(matched.columns) else matched
