"""Differences between the two sides of matched pairs, and their diagnostics.

Both sides of a pair are summed by one conditional aggregate; sums are decimal until the last
projection, so they do not depend on the order of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.config import DEFAULT_UPLIFT
from tallymark.functions.codes import convert_unit, hs_level, tolerant_bool
from tallymark.operators.quantiles import exact_quantiles
from tallymark.schema import amount

METRICS = ("netWgt", "primaryValue", "qty", "altQty", "grossWgt")
# Attributes whose two sides are compared.
ATTRIBUTES = ("isOriginalClassification", "customsCode", "mosCode", "motCode", "qtyUnitCode", "isQtyEstimated", "altQtyUnitCode", "isAltQtyEstimated", "isNetWgtEstimated", "isGrossWgtEstimated", "isReported")
# Attributes that are flags.
FLAGS = ("isQtyEstimated", "isAltQtyEstimated", "isNetWgtEstimated", "isGrossWgtEstimated", "isReported", "isAggregate", "isOriginalClassification")
# Names and order of the output columns of a pair.
COLUMNS = (
    "matched_id", "exporterCode", "importerCode", "cmdCode", "hs_level", "qtyUnitCode_X", "qtyUnitCode_M", "qty_X", "qty_M", "qty_M_in_X_unit", "qty_MISINVOICING", "altQtyUnitCode_X",
    "altQtyUnitCode_M", "altQty_X", "altQty_M", "altQty_M_in_X_unit", "altQty_MISINVOICING", "netWgt_X", "netWgt_M", "netWgt_MISINVOICING", "grossWgt_X", "grossWgt_M", "grossWgt_MISINVOICING",
    "primaryValue_X", "primaryValue_X_CIF", "primaryValue_M", "primaryValue_MISINVOICING",
)


def _is(flow: str) -> Column:
    return F.col("flowCode") == flow


def presence(matched: DataFrame) -> DataFrame:
    """(matched_id, has_x, has_m)."""
    return matched.filter("matched_id is not null").groupBy("matched_id").agg(F.bool_or(_is("X")).alias("has_x"), F.bool_or(_is("M")).alias("has_m"))


def with_uplift(df: DataFrame, factors: DataFrame, default: float = DEFAULT_UPLIFT) -> DataFrame:
    """df with uplift, the factor of its transport mode, and value_cif = primaryValue * (1 + uplift)."""
    f = factors.select(F.trim("motCode").alias("_mot"), F.col("factor").cast("decimal(8,4)").alias("_f"))
    joined = df.join(f, F.trim("motCode") == F.col("_mot"), "left").drop("_mot")
    up = F.coalesce("_f", F.lit(default).cast("decimal(8,4)"))
    return joined.withColumn("uplift", up.cast("double")).withColumn("value_cif", (amount(F.col("primaryValue")) * (up + F.lit(1).cast("decimal(8,4)")).cast("decimal(8,4)")).cast("decimal(26,4)")).drop("_f")


def side_sums(uplifted: DataFrame) -> DataFrame:
    """(matched_id, metric_X, metric_M, ..., first non-null unit, reporter and code of each side): one aggregate."""
    first = lambda c, f: F.min_by(c, F.when(_is(f) & F.col(c).isNotNull(), F.col("id")))
    sums = [F.sum(F.when(_is(f), amount(F.col(m)))).alias(f"{m}_{f}") for m in METRICS for f in "XM"]
    return uplifted.filter("matched_id is not null").groupBy("matched_id").agg(
        *sums,
        F.sum(F.when(_is("X"), F.col("value_cif"))).alias("primaryValue_X_CIF"),
        *[first(u, f).alias(f"{u}_{f}") for u in ("qtyUnitCode", "altQtyUnitCode") for f in "XM"],
        first("reporterCode", "X").alias("exporterCode"),
        first("reporterCode", "M").alias("importerCode"),
        first("cmdCode", "X").alias("cmdCode"),
        F.bool_or(_is("X")).alias("has_x"),
        F.bool_or(_is("M")).alias("has_m"),
        F.bool_or(_is("X") & tolerant_bool(F.col("isNetWgtEstimated"))).alias("imputed_x"),
        F.bool_or(_is("M") & tolerant_bool(F.col("isNetWgtEstimated"))).alias("imputed_m"),
    ).filter("has_x and has_m")


def residuals(uplifted: DataFrame, conversion: DataFrame, more: tuple[str, ...] = ()) -> DataFrame:
    """The 27 columns of a pair: sums of both sides, M in the unit of X, and X less M; and more columns of side_sums."""
    s = side_sums(uplifted)
    sums = {*[f"{m}_{f}" for m in METRICS for f in "XM"], "primaryValue_X_CIF"}
    s = s.select(*[F.col(c).cast("double").alias(c) if c in sums else F.col(c) for c in s.columns])
    table = conversion.filter("factor_to_base > 0").select(F.trim("code").alias("u"), F.col("dimension").alias("d"), F.col("factor_to_base").alias("f"))
    derived = {}
    for q in ("qty", "altQty"):
        for f in "XM":
            t = table.select(F.col("u").alias(f"_{q}u{f}"), F.col("d").alias(f"_{q}d{f}"), F.col("f").alias(f"_{q}f{f}"))
            s = s.join(t, F.trim(f"{q}UnitCode_{f}") == F.col(f"_{q}u{f}"), "left")
        same = F.trim(f"{q}UnitCode_X") == F.trim(f"{q}UnitCode_M")
        there = convert_unit(F.col(f"{q}_M"), same, F.col(f"_{q}dM"), F.col(f"_{q}fM"), F.col(f"_{q}dX"), F.col(f"_{q}fX"))
        derived |= {f"{q}_M_in_X_unit": there, f"{q}_MISINVOICING": F.col(f"{q}_X") - there}
    derived |= {f"{w}_MISINVOICING": F.col(f"{w}_X") - F.col(f"{w}_M") for w in ("netWgt", "grossWgt")}
    derived |= {"primaryValue_MISINVOICING": F.col("primaryValue_X_CIF") - F.col("primaryValue_M"), "hs_level": hs_level(F.col("cmdCode"))}
    s = s.withColumns(derived)
    return s.select(*COLUMNS, *more)


def effective_uplift(res: DataFrame) -> DataFrame:
    """(matched_id, effective_uplift): value added by the uplift over the value of X."""
    return res.select("matched_id", F.when(F.col("primaryValue_X") > 0, F.col("primaryValue_X_CIF") / F.col("primaryValue_X") - 1).alias("effective_uplift"))


def uplift_quantiles(res: DataFrame) -> DataFrame:
    """(n, p05, p50, p95) of finite effective uplifts."""
    e = effective_uplift(res).filter("effective_uplift is not null and abs(effective_uplift) < double('Infinity')")
    return exact_quantiles(e, "effective_uplift", [0.05, 0.5, 0.95]).select("n", F.col("q0").alias("p05"), F.col("q1").alias("p50"), F.col("q2").alias("p95"))


def discrepancies(rows: DataFrame, key: tuple[str, ...] = ("matched_id",)) -> DataFrame:
    """(attribute, pairs): pairs whose two sides report different sets of values of an attribute. The key
    of a pair may be its id or the columns it is matched by; a pair with one side only counts nowhere.

    Unpivoted and reduced to distinct values map-side, so no set is ever collected."""
    key = list(key)
    cells = F.array(*[F.struct(F.lit(a).alias("attribute"), (tolerant_bool(F.col(a)).cast("string") if a in FLAGS else F.col(a).cast("string")).alias("value")) for a in ATTRIBUTES])
    values = rows.filter(F.col(key[0]).isNotNull()).select(*key, "flowCode", F.inline(cells)).filter("value is not null")
    values = values.groupBy(*key, "attribute", "value").agg(F.max(_is("X").cast("int")).alias("x"), F.max(_is("M").cast("int")).alias("m"))
    sides = values.groupBy("attribute", *key).agg(F.sum("x").alias("nx"), F.sum("m").alias("nm"), F.count(F.lit(1)).alias("n"))
    return sides.groupBy("attribute").agg(F.count_if((F.col("nx") > 0) & (F.col("nm") > 0) & (F.col("n") > F.least("nx", "nm"))).alias("pairs"))


def with_entrepot(res: DataFrame, entrepots: DataFrame) -> DataFrame:
    """res with is_entrepot_pair: exporter or importer is a hub."""
    codes = entrepots.select(F.col("code").cast("int").alias("_c")).filter("_c is not null").distinct()
    out = res
    for side in ("exporterCode", "importerCode"):
        out = out.join(codes.select(F.col("_c").alias(f"_{side}")), F.col(side) == F.col(f"_{side}"), "left")
    return out.withColumn("is_entrepot_pair", F.col("_exporterCode").isNotNull() | F.col("_importerCode").isNotNull()).drop("_exporterCode", "_importerCode")


def mode_counts(matched: DataFrame, factors: DataFrame) -> DataFrame:
    """(motCode, n, known) of X rows."""
    f = factors.select(F.trim("motCode").alias("motCode")).distinct().withColumn("known", F.lit(True))
    x = matched.filter(_is("X") & F.col("matched_id").isNotNull()).groupBy(F.trim("motCode").alias("motCode")).agg(F.count(F.lit(1)).alias("n"))
    return x.join(f, "motCode", "left").select("motCode", "n", F.coalesce("known", F.lit(False)).alias("known"))


def pair_counters(uplifted: DataFrame, conversion: DataFrame, entrepots: DataFrame) -> DataFrame:
    """One row of counters over pairs: hubs, imputed weights, missing weights, units that differ or were converted."""
    r = with_entrepot(residuals(uplifted, conversion, ("imputed_x", "imputed_m")), entrepots).withColumn("imputed", F.col("imputed_x") | F.col("imputed_m"))
    same = lambda q: F.coalesce(F.trim(f"{q}UnitCode_X") == F.trim(f"{q}UnitCode_M"), F.lit(False))
    count = lambda c: F.count_if(c)
    return r.agg(
        F.count(F.lit(1)).alias("pairs"),
        count(F.col("is_entrepot_pair")).alias("entrepot_pairs"),
        count(F.col("imputed")).alias("imputed_pairs"),
        count(F.col("netWgt_MISINVOICING").isNull()).alias("netwgt_null"),
        count(~same("qty")).alias("qty_unit_mismatch"),
        count(~same("qty") & F.col("qty_M_in_X_unit").isNotNull()).alias("qty_unit_converted"),
        count(~same("altQty")).alias("altqty_unit_mismatch"),
        count(~same("altQty") & F.col("altQty_M_in_X_unit").isNotNull()).alias("altqty_unit_converted"),
    )
