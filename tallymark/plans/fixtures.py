"""A concordance by rule over the codes that the declarations use: the tables have none."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.functions.codes import normalise_code


def revision_edges(declarations: DataFrame) -> DataFrame:
    """Unnormalised edges H3-H4, H4-H5, H5-H6: each code to itself; every seventh also ten higher; some have no way on."""
    codes = declarations.select(normalise_code(F.col("cmdCode")).alias("code")).filter("length(code) = 6").distinct()
    steps = codes.select("code", F.col("code").cast("int").alias("c"), F.explode(F.array(F.lit(3), F.lit(4), F.lit(5))).alias("k")).filter("not (k = 4 and c % 11 = 0)")
    rev = lambda k: F.concat(F.lit("H"), k.cast("string"))
    to = F.array(
        F.struct(F.col("code").alias("to_code"), F.lit(1.0).alias("weight")),
        F.when((F.col("c") % 7 == 0) & (F.col("c") < 999990), F.struct(F.lpad((F.col("c") + 10).cast("string"), 6, "0").alias("to_code"), ((F.col("k") - 2) * 0.5).cast("double").alias("weight"))),
    )
    return steps.select(rev(F.col("k")).alias("from_rev"), F.col("code").alias("from_code"), rev(F.col("k") + 1).alias("to_rev"), F.explode(to).alias("t")).filter("t is not null").select("from_rev", "from_code", "to_rev", "t.to_code", "t.weight")
