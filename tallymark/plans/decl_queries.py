"""Queries over declarations: one for each operator of the reconciliation."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.config import Config
from tallymark.functions import codes
from tallymark.operators import canonical, cascade, concordance, pairing, residual
from tallymark.plans.declarations import Plan
from tallymark.plans.fixtures import revision_edges
from tallymark.schema import KEEP
from tallymark.session import write_once
from tallymark.sources import dims
from tallymark.sources.tables import table, version

CFG = Config(years=("2021", "2022"), canonical_revision="H6")
QUERIES = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


#: Concordances written in this session, by the version of the declarations their codes come from.
_BUILT: dict[tuple, str] = {}


def plan(spark: SparkSession, d: str, cfg: Config = CFG, built: bool = True) -> Plan:
    """built: take the best codes from the concordance of this session, which is written when first asked for."""
    t = table(spark, d, "declarations")
    names = {"factors": "cif_fob_factor", "conversion": "qty_unit_conversion", "entrepots": "entrepot_reporters", "reporters": "reporter_codes"}

    def tables(n: str) -> DataFrame | None:
        if n == "edges":
            return revision_edges(t)
        if n != "best_codes":
            return table(spark, d, names[n])
        if not built:
            return None
        key = (spark.sparkContext.applicationId, version(spark, d, "declarations"), cfg.canonical_revision)
        if key not in _BUILT:
            p = Plan(t, cfg, lambda x: None if x == "best_codes" else tables(x))
            _BUILT[key] = write_once(concordance.best_targets(p.concordance, cfg.canonical_revision))
        return spark.read.schema("from_revision string, from_code string, to_code string").parquet(_BUILT[key])

    return Plan(t, cfg, tables)


# Scans, projections, filters


@query
def decl_scan(spark, d):
    p = plan(spark, d)
    return p.declarations.groupBy("refYear").agg(F.count(F.lit(1)).alias("n"), F.count("netWgt").alias("with_weight"), F.count_distinct("reporterCode").alias("reporters"))


@query
def decl_reject_reason(spark, d):
    return cascade.with_reject_reason(plan(spark, d).declarations, CFG).select("id", "reject_reason")


@query
def decl_survivors(spark, d):
    return plan(spark, d).survivors.select("id", "reporterCode", "partnerCode", "partner2Code", "flowCode", "cmdCode")


@query
def decl_dedup(spark, d):
    return plan(spark, d).survivors.select("id", "load_no")


#: What tells one shipment from another; rows that agree in it repeat a shipment.
SHIPMENT = ("refYear", "reporterCode", "partnerCode", "partner2Code", "flowCode", "cmdCode")


@query
def decl_dedup_shipment(spark, d):
    return cascade.drop_duplicates(plan(spark, d).passed, [], keep=SHIPMENT).select("id", *SHIPMENT)


@query
def duplicate_counts(spark, d):
    return cascade.duplicate_counts(plan(spark, d).passed, [], ["reporterCode"], SHIPMENT)


@query
def reject_counts(spark, d):
    return cascade.counts(plan(spark, d).declarations, CFG, ["reporterCode"])


@query
def reject_by_hs_level(spark, d):
    return cascade.level_counts(plan(spark, d).declarations, CFG)


@query
def reject_by_reporter_level(spark, d):
    return cascade.level_counts(plan(spark, d).declarations, CFG, ("reporterCode",))


@query
def commodity_prefix(spark, d):
    cfg = Config(years=CFG.years, hs_level="ALL", prefixes=("27", "2709", "01", "64"))
    return cascade.counts(plan(spark, d).declarations, cfg, ["flowCode"])


@query
def filter_key_normalise(spark, d):
    t = plan(spark, d).declarations
    return t.groupBy(*[codes.key_text(F.col(c)).alias(c) for c in ("typeCode", "freqCode", "classificationSearchCode", "customsCode")]).agg(F.count(F.lit(1)).alias("n"))


@query
def scope_semijoin(spark, d):
    p = plan(spark, d)
    targets = p.reporters.filter("continent = 'Ilmora'")
    return cascade.in_scope(p.declarations, targets).groupBy("reporterCode").agg(F.count(F.lit(1)).alias("n"))


@query
def scope_missing_anti(spark, d):
    p = plan(spark, d)
    return cascade.missing_reporters(p.survivors, p.reporters)


@query
def reporters_present(spark, d):
    p = plan(spark, d)
    return dims.with_names(p.survivors.select("reporterCode").distinct(), p.reporters, "reporterCode", "name")


@query
def dim_reporters(spark, d):
    return dims.reporters(table(spark, d, "reporter_codes"))


@query
def dim_uplift(spark, d):
    return dims.uplift_factors(table(spark, d, "cif_fob_factor"))


@query
def dim_units(spark, d):
    return dims.conversions(table(spark, d, "qty_unit_conversion"))


@query
def dim_entrepots(spark, d):
    return dims.entrepots(table(spark, d, "entrepot_reporters"))


# Codes


@query
def hs_level_counts(spark, d):
    t = plan(spark, d).declarations
    return t.groupBy(codes.hs_level(F.col("cmdCode")).alias("hs_level"), codes.key_text(F.col("flowCode")).alias("flowCode")).agg(F.count(F.lit(1)).alias("n"))


@query
def code_pad(spark, d):
    t = plan(spark, d).declarations
    return t.select("cmdCode", codes.normalise_code(F.col("cmdCode")).alias("cmd_norm")).groupBy("cmdCode", "cmd_norm").agg(F.count(F.lit(1)).alias("n"))


@query
def tolerant_bools(spark, d):
    t = plan(spark, d).declarations
    return t.agg(*[f for c in residual.FLAGS for f in (F.count_if(codes.tolerant_bool(F.col(c))).alias(f"{c}_true"), F.count_if(codes.unknown_bool(F.col(c))).alias(f"{c}_unknown"))])


@query
def weight_normalise(spark, d):
    return concordance.normalise_weights(plan(spark, d).edges).withColumn("weight", F.round("weight", 9))


@query
def concordance_compose(spark, d):
    return plan(spark, d).concordance.withColumn("weight", F.round("weight", 9))


@query
def concordance_identity(spark, d):
    return plan(spark, d).concordance.filter("note = 'identity'").groupBy("from_revision").agg(F.count(F.lit(1)).alias("n"))


@query
def concordance_older_target(spark, d):
    """To a revision that is not the newest: codes of newer ones stand for themselves."""
    return plan(spark, d, replace(CFG, canonical_revision="H4")).concordance.withColumn("weight", F.round("weight", 9))


@query
def concordance_argmax(spark, d):
    return plan(spark, d).best_codes


@query
def concordance_apply(spark, d):
    return plan(spark, d).canonical_codes.select("id", "cmd_norm", "canonical_cmd", "concord")


@query
def concordance_diag(spark, d):
    return concordance.diagnostics(plan(spark, d).canonical_codes)


# Pairing


@query
def mirror_direct(spark, d):
    return pairing.matched_groups(plan(spark, d).groups).filter("bucket = 'D'").select("year", "exporter", "importer", "cmd", "n_x", "n_m")


@query
def mirror_triangular(spark, d):
    return pairing.matched_groups(plan(spark, d).groups).filter("bucket = 'T'").select("year", "exporter", "importer", "hub", "cmd", "n_x", "n_m")


@query
def match_ids(spark, d):
    return plan(spark, d).matched.select("id", "matched_id")


@query
def match_unmatched(spark, d):
    return plan(spark, d).paired.filter("matched_id is null").select("id", "flowCode")


@query
def match_diag(spark, d):
    return pairing.diagnostics(plan(spark, d).groups)


@query
def match_by_country(spark, d):
    return pairing.by_country(plan(spark, d).survivors)


@query
def match_totals(spark, d):
    return plan(spark, d).paired.agg(F.count(F.lit(1)).alias("n"), F.count("matched_id").alias("rows_matched"), F.max("matched_id").alias("groups"))


@query
def union_reconstitute(spark, d):
    p = plan(spark, d)
    both = p.matched.select("id", "flowCode").unionByName(p.paired.filter("matched_id is null").select("id", "flowCode"))
    return both.groupBy("flowCode").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first_id"), F.max("id").alias("last_id"))


@query
def row_ids(spark, d):
    return pairing.number(plan(spark, d).survivors.select("id"), "id", "row_no")


# Canonical rows


@query
def dominant_row(spark, d):
    return plan(spark, d).dominant


@query
def kept_pairs(spark, d):
    return canonical.kept_pairs(plan(spark, d).numbered)


@query
def clean_view(spark, d):
    return plan(spark, d).clean.select("matched_id", "id", *[c for c in KEEP if c in ("reporterCode", "flowCode", "cmdCode", "motCode", "qtyUnitCode", "qty", "netWgt", "primaryValue")])


@query
def clean_coverage(spark, d):
    return canonical.coverage(plan(spark, d).numbered)


# Residuals


@query
def pair_presence(spark, d):
    return plan(spark, d).numbered.select("matched_id", (F.col("n_x") > 0).alias("has_x"), (F.col("n_m") > 0).alias("has_m"))


@query
def uplift_rows(spark, d):
    return plan(spark, d).uplifted.select("matched_id", "id", "uplift", F.col("value_cif").cast("double").alias("value_cif"))


@query
def side_sums(spark, d):
    s = residual.side_sums(plan(spark, d).uplifted)
    return s.select("matched_id", *[F.col(c).cast("double").alias(c) for m in residual.METRICS for c in (f"{m}_X", f"{m}_M")], F.col("primaryValue_X_CIF").cast("double").alias("primaryValue_X_CIF"))


@query
def side_first(spark, d):
    """Over all matched rows, where a side has several."""
    p = plan(spark, d)
    up = residual.with_uplift(p.matched, p.factors)
    return residual.side_sums(up).select("matched_id", "qtyUnitCode_X", "qtyUnitCode_M", "altQtyUnitCode_X", "altQtyUnitCode_M", "exporterCode", "importerCode", "cmdCode", "imputed_x", "imputed_m")


@query
def unit_convert(spark, d):
    return plan(spark, d).residuals.select("matched_id", "qtyUnitCode_X", "qtyUnitCode_M", F.round("qty_M_in_X_unit", 6).alias("qty_M_in_X_unit"), F.round("altQty_M_in_X_unit", 6).alias("altQty_M_in_X_unit"))


@query
def residuals(spark, d):
    rounded = ("qty_M_in_X_unit", "qty_MISINVOICING", "altQty_M_in_X_unit", "altQty_MISINVOICING", "netWgt_MISINVOICING", "grossWgt_MISINVOICING", "primaryValue_MISINVOICING")
    return plan(spark, d).residuals.select(*[F.round(c, 6).alias(c) if c in rounded else F.col(c) for c in residual.COLUMNS])


@query
def effective_uplift(spark, d):
    return residual.effective_uplift(plan(spark, d).residuals).withColumn("effective_uplift", F.round("effective_uplift", 9))


@query
def uplift_quantiles(spark, d):
    return residual.uplift_quantiles(plan(spark, d).residuals).select("n", *[F.round(c, 9).alias(c) for c in ("p05", "p50", "p95")])


@query
def discrepancies(spark, d):
    return residual.discrepancies(plan(spark, d).keyed, pairing.KEY)


@query
def entrepot_pairs(spark, d):
    p = plan(spark, d)
    return residual.with_entrepot(p.residuals, p.entrepots).select("matched_id", "is_entrepot_pair")


@query
def mode_counts(spark, d):
    p = plan(spark, d)
    return residual.mode_counts(p.matched, p.factors)


@query
def pair_counters(spark, d):
    p = plan(spark, d)
    return residual.pair_counters(p.uplifted, p.conversion, p.entrepots)
