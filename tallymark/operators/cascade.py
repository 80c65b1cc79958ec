"""The ordered row filters: the first reason wins, every row is counted once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.config import FLOWS, Config
from tallymark.functions.codes import hs_level, key_text, narrow_bool, normalise_code
from tallymark.schema import KEEP

ESTIMATES = ("isQtyEstimated", "isAltQtyEstimated", "isNetWgtEstimated", "isGrossWgtEstimated")


def conditions(columns: list[str], cfg: Config) -> list[tuple[str, Column]]:
    """(reason, condition of a bad row) in order; never null. A rule whose column is absent is left out."""
    have = set(columns)
    differs = lambda c, v: ~c.eqNullSafe(F.lit(v))
    false = F.lit(False)
    number = F.trim(F.col("cmdCode")).try_cast("double")
    padded = F.coalesce(normalise_code(F.col("cmdCode")), F.trim("cmdCode"))
    prefixed = F.lit(True)
    if cfg.prefixes:
        prefixed = false
        for p in cfg.prefixes:
            prefixed = prefixed | F.coalesce(padded.startswith(p), false)
    estimated = F.lit(True)
    for c in ESTIMATES:
        if c in have:
            estimated = estimated & narrow_bool(F.col(c))
    rules = [
        ("typeCode", ("typeCode",), lambda: differs(key_text(F.col("typeCode")), "C")),
        ("freqCode", ("freqCode",), lambda: differs(key_text(F.col("freqCode")), "A")),
        ("refYear", ("refYear",), lambda: ~F.coalesce(F.trim(F.col("refYear").cast("string")).isin(*cfg.years), false)),
        ("classificationSearchCode", ("classificationSearchCode",), lambda: differs(key_text(F.col("classificationSearchCode")), "HS")),
        ("partner_zero", ("partnerCode", "partner2Code"), lambda: F.coalesce((F.col("partnerCode") == 0) & (F.col("partner2Code") == 0), false)),
        ("cmdCode", ("cmdCode",), lambda: F.coalesce((number == 0) | F.isnan(number), F.lit(True))),
        ("hs_level", ("cmdCode",), lambda: false if cfg.hs_level == "ALL" else hs_level(F.col("cmdCode")) != cfg.hs_level),
        ("commodity_filter", ("cmdCode",), lambda: ~prefixed),
        ("reporterCode", ("reporterCode",), lambda: F.coalesce(F.col("reporterCode") == 0, F.lit(True))),
        ("flowCode", ("flowCode",), lambda: ~F.coalesce(key_text(F.col("flowCode")).isin(*FLOWS), false)),
        ("self_trade", ("reporterCode", "partnerCode"), lambda: F.coalesce(F.col("reporterCode") == F.col("partnerCode"), false)),
        ("customsCode", ("customsCode",), lambda: differs(key_text(F.col("customsCode")), "C00")),
        ("all_estimated", ESTIMATES, lambda: estimated),
    ]
    return [(reason, make()) for reason, need, make in rules if have.issuperset(need)]


def with_reject_reason(df: DataFrame, cfg: Config) -> DataFrame:
    """df with reject_reason, null for rows that pass all filters."""
    reason = None
    for name, bad in conditions(df.columns, cfg):
        reason = F.when(bad, name) if reason is None else reason.when(bad, name)
    return df.withColumn("reject_reason", reason if reason is not None else F.lit(None).cast("string"))


def survivors(df: DataFrame, cfg: Config) -> DataFrame:
    """Rows that pass, with flow and code normalised for the steps after."""
    return with_reject_reason(df, cfg).filter("reject_reason is null").drop("reject_reason").withColumn("flowCode", key_text(F.col("flowCode")))


def drop_duplicates(df: DataFrame, scope: list[str], row_id: str = "id", keep: tuple[str, ...] = KEEP) -> DataFrame:
    """One row, of the lowest id, for each set of equal kept columns in a scope (a source file); nulls are equal.

    One hash aggregate: copies meet map-side, so a row repeated a billion times is one state a task."""
    cols = [c for c in (*scope, *keep) if c in df.columns]
    cols = list(dict.fromkeys(cols))
    return df.groupBy(*cols).agg(F.min(row_id).alias(row_id))


def duplicate_counts(df: DataFrame, scope: list[str], by: list[str], keep: tuple[str, ...] = KEEP) -> DataFrame:
    """(by..., level, rows, repeats): rows, and rows that repeat another of their scope. by: kept columns, in any form that depends on them alone."""
    cols = list(dict.fromkeys(c for c in (*scope, *keep) if c in df.columns))
    copies = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
    return copies.groupBy(*by, hs_level(F.col("cmdCode")).alias("level")).agg(F.sum("_n").alias("rows"), F.sum(F.col("_n") - 1).alias("repeats"))


def counts(df: DataFrame, cfg: Config, by: list[str]) -> DataFrame:
    """(by..., reason, n): rows kept, and rows dropped for each reason."""
    return with_reject_reason(df, cfg).groupBy(*by, F.coalesce("reject_reason", F.lit("kept")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def level_counts(df: DataFrame, cfg: Config, by: tuple[str, ...] = ()) -> DataFrame:
    """(by..., reason, HS2, HS4, HS6, Unknown)."""
    rows = with_reject_reason(df, cfg).select(*by, F.coalesce("reject_reason", F.lit("kept")).alias("reason"), hs_level(F.col("cmdCode")).alias("level"))
    return rows.groupBy(*by, "reason").agg(*[F.count_if(F.col("level") == x).alias(x) for x in ("HS2", "HS4", "HS6", "Unknown")])


def in_scope(df: DataFrame, targets: DataFrame, code: str = "reporterCode") -> DataFrame:
    """Rows of the reporters in targets (a dimension table)."""
    return df.join(targets.select(F.col("iso_code").alias(code)).distinct(), code, "left_semi")


def missing_reporters(df: DataFrame, targets: DataFrame, code: str = "reporterCode") -> DataFrame:
    """Expected reporters without any row."""
    return targets.select(F.col("iso_code").alias(code)).distinct().join(df.select(code).distinct(), code, "left_anti")
