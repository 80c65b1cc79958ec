"""Scalar functions over codes, flags and units: built-in expressions only."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Spellings of yes and no.
YES = ("1", "true", "yes", "t", "y")
NO = ("0", "false", "no", "f", "n", "")
NARROW_YES = ("true", "1", "t", "yes")
# Revision of each edition year.
VINTAGES = {"1992": "H0", "1996": "H1", "2002": "H2", "2007": "H3", "2012": "H4", "2017": "H5", "2022": "H6"}


def key_text(c: Column) -> Column:
    return F.upper(F.trim(c))


def hs_level(code: Column) -> Column:
    """Level by length; null and blank are Unknown, text keeps the rule of its length."""
    n = F.length(F.trim(code))
    return F.when(n.isNull() | (n == 0), "Unknown").when(n <= 2, "HS2").when(n <= 4, "HS4").otherwise("HS6")


def normalise_code(code: Column) -> Column:
    """Digits padded to 2, 4 or 6 places; anything else null."""
    t = F.trim(code)
    return F.when(t.rlike("^[0-9]{1,2}$"), F.lpad(t, 2, "0")).when(t.rlike("^[0-9]{3,4}$"), F.lpad(t, 4, "0")).when(t.rlike("^[0-9]{5,6}$"), F.lpad(t, 6, "0"))


def tolerant_bool(c: Column) -> Column:
    """True for a spelling of yes, else False, null included."""
    return F.coalesce(F.lower(F.trim(c)).isin(*YES), F.lit(False))


def unknown_bool(c: Column) -> Column:
    """True for text that is a spelling of neither yes nor no."""
    return F.coalesce(~F.lower(F.trim(c)).isin(*YES, *NO), F.lit(False))


def narrow_bool(c: Column) -> Column:
    """The narrower yes of the row filters ("y" is none)."""
    return F.coalesce(F.lower(F.trim(c)).isin(*NARROW_YES), F.lit(False))


def convert_unit(value: Column, same: Column, dim_from: Column, factor_from: Column, dim_to: Column, factor_to: Column) -> Column:
    """value in the other unit: as it is for the same unit, by factors within a dimension, else null."""
    return F.when(same, value).when((dim_from == dim_to) & (factor_to > 0), value * factor_from / factor_to)


def register(spark: SparkSession) -> None:
    """The scalar functions for use in SQL text, as SQL functions (inlined by the optimizer)."""
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION hs_level(c STRING) RETURNS STRING RETURN CASE WHEN c IS NULL OR length(trim(c)) = 0 THEN 'Unknown' WHEN length(trim(c)) <= 2 THEN 'HS2' WHEN length(trim(c)) <= 4 THEN 'HS4' ELSE 'HS6' END")
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION normalise_code(c STRING) RETURNS STRING RETURN CASE WHEN trim(c) RLIKE '^[0-9]{1,2}$' THEN lpad(trim(c), 2, '0') "
        "WHEN trim(c) RLIKE '^[0-9]{3,4}$' THEN lpad(trim(c), 4, '0') WHEN trim(c) RLIKE '^[0-9]{5,6}$' THEN lpad(trim(c), 6, '0') END"
    )
    yes = ", ".join(f"'{w}'" for w in YES)
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION tolerant_bool(c STRING) RETURNS BOOLEAN RETURN coalesce(lower(trim(c)) IN ({yes}), false)")
