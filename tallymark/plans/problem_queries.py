"""Queries p1 to p6: data-processing problems over the declaration tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.operators import diff, hotdeck, profile, rowparse, skew, unit_text
from tallymark.sources.tables import table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return diff.declaration_diff(table(spark, d, "declarations"), table(spark, d, "decl_mirror"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return skew.heavy_keys(table(spark, d, "declarations"), {"reporterCode": 0.04, "matched_id": 0.01}, "primaryValue").select("field", "key_value")


def p2_totals(spark: SparkSession, d: str) -> DataFrame:
    return skew.per_key_totals(table(spark, d, "declarations"), ["reporterCode", "matched_id"], "primaryValue")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return hotdeck.hot_deck(table(spark, d, "declarations")).select("id", "field")


def p3_filled(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "declarations")
    return hotdeck.filled(t, hotdeck.hot_deck(t)).select("id", "netWgt", "isNetWgtEstimated", "netWgt_filled", "isNetWgtEstimated_filled")


def p3_marks(spark: SparkSession, d: str) -> DataFrame:
    """p3_filled without the fills themselves: the marks, and all values that were there."""
    t = p3_filled(spark, d)
    kept = lambda c: F.when(~F.col(f"{c}_filled"), F.col(c)).alias(c)
    return t.select("id", kept("netWgt"), kept("isNetWgtEstimated"), "netWgt_filled", "isNetWgtEstimated_filled", (F.col("netWgt").isNotNull() & F.col("isNetWgtEstimated").isNotNull()).alias("whole"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return unit_text.converted_units(table(spark, d, "declarations"), table(spark, d, "qty_unit_conversion"))


def p4_base_quantities(spark: SparkSession, d: str) -> DataFrame:
    return unit_text.convert_units(table(spark, d, "declarations"), table(spark, d, "qty_unit_conversion")).drop("factor", "stated_by")


def p4_coded(spark: SparkSession, d: str) -> DataFrame:
    """The part whose unit is given by code."""
    return unit_text.convert_units(table(spark, d, "declarations"), table(spark, d, "qty_unit_conversion")).filter("stated_by = 'code'").select("id", "code", "dimension", "qty_base")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return rowparse.rejected_rows(rowparse.parse_rows(table(spark, d, "raw_lines")))


def p5_rows(spark: SparkSession, d: str) -> DataFrame:
    """The typed rows; other columns as lines of name=value in order of name."""
    rows = rowparse.typed_rows(rowparse.parse_rows(table(spark, d, "raw_lines")))
    lines = F.transform(F.array_sort(F.map_entries("other")), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return rows.withColumn("other", F.array_join(lines, "\n"))


def p5_repairs(spark: SparkSession, d: str) -> DataFrame:
    return rowparse.repairs(rowparse.parse_rows(table(spark, d, "raw_lines")))


def _profile(spark: SparkSession, d: str) -> dict:
    return profile.profile(table(spark, d, "declarations"), table(spark, d, "cif_fob_factor"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return profile.profile_findings(_profile(spark, d))


def p6_discrimination(spark: SparkSession, d: str) -> DataFrame:
    return profile.discrimination(_profile(spark, d))


def p6_values(spark: SparkSession, d: str) -> DataFrame:
    return _profile(spark, d)["values"]


def p6_profile(spark: SparkSession, d: str) -> DataFrame:
    return profile.column_profile(table(spark, d, "declarations"), patterns=profile.declaration_patterns(table(spark, d, "cif_fob_factor")))


QUERIES = {f.__name__: f for f in (p1_found, p2_found, p2_totals, p3_found, p3_filled, p3_marks, p4_found, p4_base_quantities, p4_coded, p5_found, p5_rows, p5_repairs, p6_found, p6_profile, p6_discrimination, p6_values)}
