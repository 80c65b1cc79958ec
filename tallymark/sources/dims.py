"""Small reference tables, cleaned. They have tens to thousands of rows and do not grow with the
declarations; joins with them are broadcast by the planner, which checks their size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def blank_null(c: str):
    return F.nullif(F.trim(F.col(c).cast("string")), F.lit(""))


def reporters(raw: DataFrame) -> DataFrame:
    """(iso_code, name, full_name, continent, status): rows with a numeric code; blanks are Unknown, a missing full name is the name."""
    code = F.trim(F.col("iso_code").cast("string")).try_cast("int")
    name = F.coalesce(blank_null("name"), F.lit("Unknown"))
    unknown = lambda c: F.coalesce(blank_null(c), F.lit("Unknown"))
    return raw.select(code.alias("iso_code"), name.alias("name"), F.coalesce(blank_null("full_name"), name).alias("full_name"), unknown("continent").alias("continent"), unknown("status").alias("status")).filter("iso_code is not null")


def uplift_factors(raw: DataFrame) -> DataFrame:
    """(motCode, factor)."""
    return raw.select(blank_null("motCode").alias("motCode"), F.col("factor").cast("string").try_cast("double").alias("factor")).filter("motCode is not null and factor is not null")


def conversions(raw: DataFrame) -> DataFrame:
    """(code, dimension, factor_to_base) of convertible units."""
    return raw.select(blank_null("code").alias("code"), blank_null("dimension").alias("dimension"), F.col("factor_to_base").cast("string").try_cast("double").alias("factor_to_base")).filter(
        "code is not null and dimension is not null and factor_to_base > 0"
    )


def entrepots(raw: DataFrame) -> DataFrame:
    """(code)."""
    return raw.select(F.trim(F.col("code").cast("string")).try_cast("int").alias("code")).filter("code is not null").distinct()


def with_names(df: DataFrame, dim: DataFrame, code: str, out: str) -> DataFrame:
    """df with the display name of a code; Unknown if it has none."""
    return df.join(dim.select(F.col("iso_code").alias("_c"), F.col("name").alias("_n")), F.col(code) == F.col("_c"), "left").withColumn(out, F.coalesce("_n", F.lit("Unknown"))).drop("_c", "_n")


def resolve_targets(raw: DataFrame, codes: list[int]) -> tuple[list[int], list[int]]:
    """(known, unknown) of the asked reporter codes."""
    known = {r.iso_code for r in reporters(raw).filter(F.col("iso_code").isin(codes)).select("iso_code").collect()}
    return sorted(known), sorted(set(codes) - known)
