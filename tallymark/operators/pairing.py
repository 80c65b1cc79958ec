"""Record linkage of the two sides of a shipment.

Each declaration maps to one canonical key (year, bucket, exporter, importer, hub, code); a group is
matched if it holds both flows. That is one hash aggregate over the declarations - no iteration, no
pair is ever materialised - and rows of a hot group are reduced map-side to one state a task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallymark.session import materialise

KEY = ("year", "bucket", "exporter", "importer", "hub", "cmd")
#: Ids of one numbering bucket: a task numbers at most so many groups.
BUCKET_BITS = 20


def with_mirror_key(df: DataFrame, code: str = "canonical_cmd", null_keys_match: bool = True) -> DataFrame:
    """df with the canonical key. direct (D): no second partner; triangular (T): by way of a hub."""
    c = lambda n: F.coalesce(n, F.lit(-1))
    r, p, p2 = c("reporterCode"), c("partnerCode"), c("partner2Code")
    x, direct = F.col("flowCode") == "X", p2 == 0
    out = df.withColumns(
        {
            "year": F.trim(F.col("refYear").cast("string")),
            "bucket": F.when(direct, "D").otherwise("T"),
            "exporter": F.when(x, r).otherwise(p),
            "importer": F.when(x, F.when(direct, p).otherwise(p2)).otherwise(r),
            "hub": F.when(direct, 0).when(x, p).otherwise(p2),
            "cmd": F.col(code),
        }
    ).filter(F.col(code).isNotNull())
    if not null_keys_match:
        out = out.filter("exporter >= 0 and importer >= 0 and hub >= 0")
    return out


def groups(keyed: DataFrame, *more) -> DataFrame:
    """(key, n_x, n_m, first_x, dom_x, dom_m, more...): one row for each group; dom: the lowest id of a side among rows of all transport modes."""
    x = F.col("flowCode") == "X"
    every = F.coalesce(F.trim(F.col("motCode").cast("string")), F.lit("")) == "0" if "motCode" in keyed.columns else F.lit(True)
    lowest = lambda side: F.min(F.when(side & every, F.col("id")))
    return keyed.groupBy(*KEY).agg(F.count_if(x).alias("n_x"), F.count_if(~x).alias("n_m"), F.min(F.when(x, F.col("id"))).alias("first_x"), lowest(x).alias("dom_x"), lowest(~x).alias("dom_m"), *more)


def matched_groups(grouped: DataFrame) -> DataFrame:
    return grouped.filter("n_x > 0 and n_m > 0")


def number(df: DataFrame, order: str, name: str, bits: int = BUCKET_BITS) -> DataFrame:
    """df with a dense number 1..n in the order of a unique bigint column, without a global sort: rows are
    numbered inside buckets of the column's high bits, and the buckets' sizes are added up."""
    b = materialise(df.withColumn("_b", F.shiftright(order, bits)))  # read twice: narrow rows, computed once
    sizes = b.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
    # one row for every 2^20 ids: a million rows for a trillion ids
    before = sizes.select("_b", F.coalesce(F.sum("_n").over(Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    rank = F.row_number().over(Window.partitionBy("_b").orderBy(order))
    return b.withColumn("_r", rank).join(before, "_b").withColumn(name, (F.col("_r") + F.col("_before")).cast("bigint")).drop("_b", "_r", "_before")


def match_ids(keyed: DataFrame) -> DataFrame:
    """(key, matched_id, ...): matched groups numbered 1..G in the order of their first X row."""
    return number(matched_groups(groups(keyed)), "first_x", "matched_id")


def attach(keyed: DataFrame, ids: DataFrame) -> DataFrame:
    """The declarations with matched_id, null for unmatched rows."""
    return keyed.drop("matched_id").join(ids.select(*KEY, "matched_id"), list(KEY), "left")


def pair(keyed: DataFrame) -> DataFrame:
    return attach(keyed, match_ids(keyed))


def diagnostics(grouped: DataFrame) -> DataFrame:
    """(bucket, x_total, x_matched_groups, x_matched_rows, x_no_m, m_total, m_matched_rows)."""
    both = (F.col("n_x") > 0) & (F.col("n_m") > 0)
    return grouped.groupBy("bucket").agg(
        F.sum("n_x").alias("x_total"),
        F.count_if(both).alias("x_matched_groups"),
        F.sum(F.when(both, F.col("n_x")).otherwise(0)).alias("x_matched_rows"),
        F.sum(F.when(F.col("n_m") == 0, F.col("n_x")).otherwise(0)).alias("x_no_m"),
        F.sum("n_m").alias("m_total"),
        F.sum(F.when(both, F.col("n_m")).otherwise(0)).alias("m_matched_rows"),
    )


def by_country(df: DataFrame) -> DataFrame:
    """(reporterCode, total_rows, flow_x, flow_m)."""
    return df.groupBy("reporterCode").agg(F.count(F.lit(1)).alias("total_rows"), F.count_if(F.col("flowCode") == "X").alias("flow_x"), F.count_if(F.col("flowCode") == "M").alias("flow_m"))
