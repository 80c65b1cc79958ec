"""Columns of declarations, in their order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Columns that are no text.
_KINDS = {"reporterCode": "int", "partnerCode": "int", "partner2Code": "int", "qty": "double", "altQty": "double", "netWgt": "double", "grossWgt": "double", "CIFValue": "double", "FOBValue": "double", "primaryValue": "double"}
FILTER_ONLY = ("typeCode", "freqCode", "refYear", "classificationSearchCode")
# Names and order of the columns of written declarations.
KEEP = (
    "reporterCode", "flowCode", "partnerCode", "partner2Code", "classificationCode", "isOriginalClassification", "cmdCode", "customsCode", "mosCode", "motCode", "qtyUnitCode", "qty",
    "isQtyEstimated", "altQtyUnitCode", "altQty", "isAltQtyEstimated", "netWgt", "isNetWgtEstimated", "grossWgt", "isGrossWgtEstimated", "CIFValue", "FOBValue", "primaryValue",
    "legacyEstimationFlag", "isReported", "isAggregate",
)
#: Raw files are read as text in all columns; types are given by `typed`.
RAW = T.StructType([T.StructField(c, T.StringType()) for c in (*FILTER_ONLY, *KEEP)])
DECLARATION = T.StructType([T.StructField(c, {"int": T.IntegerType(), "double": T.DoubleType()}.get(_KINDS.get(c), T.StringType())) for c in KEEP])


def kind_of(name: str) -> str:
    return _KINDS.get(name, "string")


def resolve(df: DataFrame, names: tuple[str, ...] = (*FILTER_ONLY, *KEEP)) -> DataFrame:
    """The named columns in their canonical spelling and order; missing ones as null text, others dropped."""
    have = {c.strip().lower(): c for c in df.columns}
    return df.select(*[(F.col(f"`{have[n.lower()]}`") if n.lower() in have else F.lit(None).cast("string")).alias(n) for n in names], *[c for c in df.columns if c.startswith("_src")])


def typed(df: DataFrame) -> DataFrame:
    """Text columns of declarations as their types; unreadable numbers are null, and so is NaN."""
    return without_nan(df.select(*[F.trim(F.col(c)).try_cast(kind_of(c)).alias(c) if kind_of(c) != "string" else F.col(c) for c in df.columns]))


def without_nan(df: DataFrame) -> DataFrame:
    """df with null for NaN in its columns of floating point."""
    return df.withColumns({n: F.when(~F.isnan(F.col(f"`{n}`")), F.col(f"`{n}`")) for n, t in df.dtypes if t in ("double", "float")})


def amount(c: Column) -> Column:
    """Exact decimal of a double, so that sums do not depend on order; null and NaN are null."""
    return F.when(~F.isnan(c), c).try_cast("decimal(24,4)")
