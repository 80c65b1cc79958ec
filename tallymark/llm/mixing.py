"""Mixing sources to target weights, by fitting token budgets exactly.

The total is the largest for which no source needs a record more often than it may be used: each
source's budget is its share of that total. A source that fits its budget several times over is
repeated whole; what remains of the budget is a subset-sum problem over the *counts of documents by
exact token length*, a table whose size is the number of different lengths, not of documents:

1. all but the last part of the budget - DEPTH times the median length, 65,536 tokens at least - is
   taken in proportion, each length rounded by a seeded fraction, so the mix keeps the source's length
   distribution;
2. a bounded-knapsack dynamic programme (reachable sums as bits in units of the lengths' common
   divisor, counts split in powers of two) fills that part from all remaining documents as closely as
   any choice of them can. Where that misses the budget, and sums times steps allow, the programme
   fits the whole budget anew, so exactly.

Then each (source, length) gives that many documents, in a seeded hash order. A length that is
shared by very many documents is split by a hash into salts that are ranked apart.

Defined cases: null and unlisted sources are left out; texts without tokens supply nothing and are
left out; a listed source without documents, or with share zero or null, supplies nothing and the
others keep their shares relative to each other; more than SOURCE_ROWS sources are an error; max_repeats null or below one makes a source
unusable; repeated records count each; empty tables give an empty mix and shares of zero.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallymark.llm.tokenise import token_counts
from tallymark.session import materialise

#: Least tokens of a source's budget that are left to the exact programme, and the same in documents of median length.
WINDOW, DEPTH = 65_536, 64
#: Sums times steps up to which the programme fits a whole budget.
WHOLE_STEPS = 2**31
#: Documents of one source and length that are ranked in one task.
RANKED = 50_000
#: Lines of the table of lengths up to which it is broadcast.
LENGTH_ROWS = 500_000
#: Sources that a mix may have; more are an error.
SOURCE_ROWS = 10_000


def _uniform(seed: str, lengths: np.ndarray) -> np.ndarray:
    """Seeded numbers in [0, 1), one for each length."""
    h = [hashlib.blake2b(f"{seed}:{x}".encode(), digest_size=8).digest() for x in lengths.tolist()]
    return np.frombuffer(b"".join(h), "<u8") / 2.0**64


def knapsack(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many of each length, within counts, for the greatest sum up to budget. Exact: reachable sums as bits,
    in units of the lengths' common divisor."""
    take = np.zeros(len(lengths), np.int64)
    usable = (lengths > 0) & (lengths <= budget) & (counts > 0)
    if budget <= 0 or not usable.any():
        return take
    unit = int(np.gcd.reduce(lengths[usable]))
    most = min(budget // unit, int((lengths[usable] // unit * counts[usable]).sum()))
    mask = (1 << (most + 1)) - 1
    reach = 1
    first = np.zeros(most + 1, np.int32)  # the step by which a sum was first reached
    steps: list[tuple[int, int]] = [(0, 0)]  # (length, how many at once)
    for i in np.flatnonzero(usable).tolist():
        w = int(lengths[i]) // unit
        have, part = min(int(counts[i]), most // w), 1
        while have > 0 and not reach >> most & 1:
            part = min(part, have)
            new = (reach << w * part & mask) & ~reach
            if new:
                bits = np.unpackbits(np.frombuffer(new.to_bytes(most // 8 + 1, "little"), np.uint8), bitorder="little")
                first[np.flatnonzero(bits)] = len(steps)
                steps.append((i, part))
                reach |= new
            have -= part
            part *= 2
        if reach >> most & 1:
            break
    at = reach.bit_length() - 1
    while at:
        i, part = steps[first[at]]
        take[i] += part
        at -= int(lengths[i]) // unit * part
    return take


def fit_budget(lengths: np.ndarray, counts: np.ndarray, budget: int, seed: str = "", window: int = WINDOW) -> np.ndarray:
    """How many documents of each length add up to the budget. A budget within the programme's share - `window`
    tokens, DEPTH times the median length, or all that WHOLE_STEPS allow - is met exactly or as near below as any choice of documents can;
    beyond it the proportional take leaves at least that share to the programme."""
    lengths, counts = np.asarray(lengths, np.int64), np.asarray(counts, np.int64)
    whole = int((lengths * counts).sum())
    if budget <= 0 or not whole:
        return np.zeros(len(lengths), np.int64)
    if budget >= whole:
        return counts.copy()
    u = _uniform(seed, lengths)
    order = np.argsort(u, kind="stable")
    middle = int(lengths[np.searchsorted(np.cumsum(counts), counts.sum() / 2)]) if (np.diff(lengths) > 0).all() else int(np.median(lengths))
    take = _fitted(lengths, counts, budget, u, order, max(window, DEPTH * middle))
    if int((lengths * take).sum()) < budget and budget // int(np.gcd.reduce(lengths)) * int(np.ceil(np.log2(counts + 1)).sum()) <= WHOLE_STEPS:
        take = _fitted(lengths, counts, budget, u, order, budget)
    return take


def _fitted(lengths: np.ndarray, counts: np.ndarray, budget: int, u: np.ndarray, order: np.ndarray, low: int) -> np.ndarray:
    """All but `low` tokens of the budget in proportion, the rest by the programme."""
    whole = int((lengths * counts).sum())
    take = np.zeros(len(lengths), np.int64)
    if budget > low:
        take = np.minimum(counts, np.floor(counts * ((budget - low) / whole) + u).astype(np.int64))
        over = int((lengths * take).sum()) - (budget - low)
        for i in order.tolist():  # the rounding took too much
            if over <= 0:
                break
            n = min(int(take[i]), -(-over // int(lengths[i])))
            take[i] -= n
            over -= n * int(lengths[i])
    open_ = budget - int((lengths * take).sum())
    left = counts - take
    # What is left over of the rounding goes in seeded order, while more than twice the programme's share is open.
    for i in order.tolist():
        if open_ <= 2 * low:
            break
        n = min(int(left[i]), (open_ - low) // int(lengths[i]))
        take[i], left[i], open_ = take[i] + n, left[i] - n, open_ - n * int(lengths[i])
    take[order] += knapsack(lengths[order], left[order], open_)
    return take


def _plan(totals: pd.DataFrame, targets: pd.DataFrame) -> pd.DataFrame:
    """(source, budget, full, rest): exact budgets of the usable sources."""
    t = targets.merge(totals, on="source", how="inner")
    t = t[(t.target_share > 0) & (t.max_repeats >= 1) & (t.tokens > 0)].copy()
    if t.empty:
        return t.assign(budget=0, full=0, rest=0)
    total = (t.tokens.astype(float) * t.max_repeats / t.target_share).min()
    t["budget"] = np.minimum(np.rint(t.target_share * total).astype("int64"), t.tokens.astype("int64") * t.max_repeats.astype("int64"))
    t["full"], t["rest"] = t.budget // t.tokens, t.budget % t.tokens
    return t


def mix(documents: DataFrame, targets: DataFrame, seed: int = 8, vocabulary: str | None = None, id_col: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """((doc_id, source, n_tokens, copies) of the records used, (source, target_share, max_repeats, records, tokens_available, records_used, tokens_used, actual_share))."""
    spark = documents.sparkSession
    named = targets.filter(F.col("source").isNotNull()).groupBy("source").agg(F.max("target_share").cast("double").alias("target_share"), F.max("max_repeats").cast("int").alias("max_repeats"))
    wanted = named.limit(SOURCE_ROWS + 1).toPandas()  # a reference table of a few rows
    if len(wanted) > SOURCE_ROWS:
        raise ValueError(f"more than {SOURCE_ROWS} sources")
    names = wanted.source.tolist()
    listed = documents.filter(F.col("source").isin(names)) if names else documents.filter(F.lit(False))
    counted = materialise(token_counts(listed, [F.col(id_col).cast("bigint").alias("doc_id"), "source"], vocabulary=vocabulary)).filter("n_tokens > 0")
    lengths = counted.groupBy("source", "n_tokens").agg(F.count(F.lit(1)).alias("n"))
    totals = lengths.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("n")).alias("tokens"), F.sum("n").alias("records")).toPandas()
    plan = _plan(totals, wanted)
    budget = spark.createDataFrame(plan[["source", "full", "rest"]].astype({"full": "int64", "rest": "int64"}), "source string, full bigint, rest bigint")

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("n_tokens", ignore_index=True)
        pdf["take"] = fit_budget(pdf.n_tokens.to_numpy(), pdf.n.to_numpy(), int(pdf.rest[0]), f"{seed}:{pdf.source[0]}")
        return pdf[["source", "n_tokens", "n", "take", "full"]]

    fitted = materialise(lengths.join(F.broadcast(budget), "source").groupBy("source").applyInPandas(fit, "source string, n_tokens int, n bigint, take bigint, full bigint"))
    fitted = fitted.withColumn("salts", F.ceil(F.col("n") / RANKED).cast("int"))
    small = fitted.limit(LENGTH_ROWS + 1).count() <= LENGTH_ROWS
    order = F.xxhash64("doc_id", F.lit(seed))
    rows = counted.join(F.broadcast(fitted) if small else fitted, ["source", "n_tokens"])
    whole = rows.filter("take = n").select("doc_id", "source", "n_tokens", (F.col("full") + 1).alias("copies"))
    none = rows.filter("take = 0 and full > 0").select("doc_id", "source", "n_tokens", F.col("full").alias("copies"))
    some = rows.filter("take > 0 and take < n").withColumn("salt", F.pmod(F.xxhash64("doc_id", F.lit(seed + 1)), F.col("salts")).cast("int"))
    # Large groups: the number to take goes to the salts in turn.
    key = ["source", "n_tokens"]
    salted = some.filter("salts > 1").groupBy(*key, "salt", "take").agg(F.count(F.lit(1)).alias("c"))
    before = F.coalesce(F.sum("c").over(Window.partitionBy(*key).orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    quota = salted.select(*key, "salt", F.greatest(F.lit(0), F.least(F.col("c"), F.col("take") - before)).alias("quota"))
    some = some.join(quota, [*key, "salt"], "left").withColumn("quota", F.coalesce("quota", "take"))
    rank = F.row_number().over(Window.partitionBy(*key, "salt").orderBy(order, "doc_id"))
    some = some.withColumn("copies", F.col("full") + (rank <= F.col("quota")).cast("bigint")).filter("copies > 0").select("doc_id", "source", "n_tokens", "copies")
    used = whole.unionByName(none).unionByName(some).withColumn("copies", F.col("copies").cast("int"))

    spent = fitted.groupBy("source").agg(
        F.sum(F.col("n_tokens") * (F.col("n") * F.col("full") + F.col("take"))).alias("tokens_used"), F.sum(F.col("n") * F.col("full") + F.col("take")).alias("records_used"), F.max("full").alias("full")
    )
    have = spark.createDataFrame(totals.astype({"tokens": "int64", "records": "int64"}) if len(totals) else pd.DataFrame({"source": [], "tokens": [], "records": []}), "source string, tokens bigint, records bigint")
    shares = named.join(have, "source", "left").join(spent, "source", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint")
    shares = shares.select("source", "target_share", "max_repeats", zero("records").alias("records"), zero("tokens").alias("tokens_available"), zero("records_used").alias("records_used"), zero("tokens_used").alias("tokens_used"))
    grand = F.sum("tokens_used").over(Window.partitionBy(F.lit(1)))  # a row for each source
    shares = shares.withColumn("actual_share", F.when(grand > 0, F.col("tokens_used") / grand).otherwise(0.0))
    return used, shares
