"""Per-key results over keys of which a few hold most records.

Algebraic SQL aggregates only: every task keeps a hash table of mergeable key states, spills it by
sort when memory runs out, and ships one compact state per key it has met. A key with a third of all
rows costs its reducer as many states as there are map tasks, not as many rows. No row is sampled,
capped or dropped, and no task ever holds the rows of a key.

Sums are decimal, so they do not depend on the order in which partial states meet.

Defined cases: null keys make a key of their own; null measures count as rows but add nothing, and
those that cannot be summed are counted apart; an empty table gives no rows; columns that are not named are never read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.session import materialise


def per_key_totals(df: DataFrame, keys: list[str], measure: str, scale: int = 6) -> DataFrame:
    """(field, key_value, n, total, unsummed) for each key column in one scan and one shuffle. unsummed: rows whose
    measure is no number that the sum can take - NaN, infinite, 1e24 and more - and which add nothing."""
    m = F.col(measure).cast("double")
    value = F.when(F.abs(m) < 1e24, m).try_cast(f"decimal({24 + scale},{scale})")
    entries = F.array(*[F.struct(F.lit(k).alias("field"), F.col(k).cast("bigint").alias("key_value")) for k in keys])
    return df.select(value.alias("_m"), m.isNotNull().alias("_x"), F.inline(entries)).groupBy("field", "key_value").agg(F.count(F.lit(1)).alias("n"), F.sum("_m").cast("double").alias("total"), F.count_if(F.col("_x") & F.col("_m").isNull()).alias("unsummed"))


def heavy_keys(df: DataFrame, shares: dict[str, float], measure: str) -> DataFrame:
    """(field, key_value, n, total, unsummed, share) of non-null keys that hold at least the given share of
    all rows. The compact totals, a row for each key, are written once, sums included: the rows of one field add
    up to all rows of the table."""
    totals = materialise(per_key_totals(df, list(shares), measure))
    whole = totals.filter(F.col("field") == next(iter(shares))).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    least = F.coalesce(*[F.when(F.col("field") == k, F.lit(s)) for k, s in shares.items()])
    heavy = totals.filter(F.col("key_value").isNotNull() & (F.col("n") >= least * F.lit(whole)))
    return heavy.select("field", "key_value", "n", "total", "unsummed", (F.col("n") / F.lit(whole)).alias("share"))
