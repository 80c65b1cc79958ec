"""Exact quantiles by linear interpolation, without bringing the values together.

Values are counted, the counts are binned by magnitude, and only the bins that hold a wanted rank
are looked at value by value: two small shuffles of counts, whatever the number of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymark.session import materialise

BINS_PER_DOUBLING = 64


def ordered_bin(v: Column, per_doubling: int = BINS_PER_DOUBLING) -> Column:
    """An int that never falls as v rises: by powers of two, negative values by falling size, NaN last."""
    size = F.abs(v)
    mag = F.greatest(F.floor(F.log2(size) * per_doubling), F.lit(-(10**6))) + 2 * 10**6
    return F.when(F.isnan(v), 10**8).when(size == 0, 0).when(v > 0, mag).otherwise(-mag).cast("int")


def exact_quantiles(df: DataFrame, value: str, probs: list[float], by: list[str] | None = None) -> DataFrame:
    """(by..., n, q0, q1, ...): quantiles of non-null, non-NaN values. No values: no row."""
    by = by or []
    v = F.col(value).cast("double") + F.lit(0.0)
    hist = df.select(*by, v.alias("v")).filter("v is not null and not isnan(v)").groupBy(*by, "v").agg(F.count(F.lit(1)).alias("c")).withColumn("bin", ordered_bin(F.col("v")))
    hist = materialise(hist)  # counts of values, read twice
    one = by or [F.lit(1)]
    run, whole = Window.partitionBy(*one).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(*one)
    bins = hist.groupBy(*by, "bin").agg(F.sum("c").alias("in_bin"))
    bins = bins.select(*by, "bin", F.coalesce(F.sum("in_bin").over(run), F.lit(0)).alias("before"), "in_bin", F.sum("in_bin").over(whole).alias("n"))
    ranks = [(F.floor((F.col("n") - 1) * p), F.ceil((F.col("n") - 1) * p)) for p in probs]
    wanted = F.lit(False)
    for pair in ranks:
        for r in pair:
            wanted = wanted | (F.col("before") <= r) & (r < F.col("before") + F.col("in_bin"))
    inner = hist.join(bins.filter(wanted), [*by, "bin"])
    upto = Window.partitionBy(*by, "bin").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    inner = inner.withColumn("at", F.col("before") + F.coalesce(F.sum("c").over(upto), F.lit(0)))
    holds = lambda r: F.max(F.when((F.col("at") <= r) & (r < F.col("at") + F.col("c")), F.col("v")))
    out = inner.groupBy(*by, "n").agg(*[holds(lo).alias(f"_lo{i}") for i, (lo, _) in enumerate(ranks)], *[holds(hi).alias(f"_hi{i}") for i, (_, hi) in enumerate(ranks)])
    frac = [(F.col("n") - 1) * p - F.floor((F.col("n") - 1) * p) for p in probs]
    return out.select(*by, "n", *[(F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * frac[i]).alias(f"q{i}") for i in range(len(probs))])
