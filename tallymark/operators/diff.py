"""Differences between two copies of a keyed dataset.

Both copies are unpivoted to key-field-value cells that carry a signed count (+1 left, -1 right).
Cells are grouped by (key, field); a cell that does not cancel - its counts do not add up to zero,
or its values lie further apart than the tolerance - is a difference. Keys whose own signed counts
do not cancel exist on one side only.

There is one shuffle. Rows of both sides are first reduced per key (map-side too, so a key that was
delivered very often never gathers in one task); the unpivot and the grouping of cells then run
inside the same hash partitioning.

Defined cases
* several rows of a key on one side: the one of the greatest `order`; without order, or on a tie,
  the one whose values are greatest - never a mixture of two rows;
* null and NaN values: no cell, so null equals null and differs from any value;
* a null key is a key like any other; an empty side makes every key of the other one-sided;
* columns other than key, order and the fields' expressions are never read, so clashing names and
  extra columns do not matter.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class DiffField:
    """A field to compare. tolerance None: exact comparison as bigint, else as double."""

    name: str
    left: Column
    right: Column
    tolerance: float | None = None


#: Slack for the binary representation of decimal values, far below any tolerance in use.
EPS = 1e-9


def parse_grouped_number(c: Column) -> Column:
    """Text to double: a point marks decimals, commas only group digits, blanks around it mean nothing; with a
    blank inside it is no number."""
    outer = r"^[\s\u00a0\u202f]+|[\s\u00a0\u202f]+$"
    return F.regexp_replace(F.regexp_replace(c, outer, ""), ",", "").try_cast("double")


def diff_copies(
    left: DataFrame,
    right: DataFrame,
    key: str,
    fields: list[DiffField],
    left_order: Column | None = None,
    right_order: Column | None = None,
    only_left: str = "only_left",
    only_right: str = "only_right",
) -> DataFrame:
    """(key, difference): one row per key and difference."""
    number = lambda c: F.when(~F.isnan(c.cast("double")), c.cast("double"))

    def side(df: DataFrame, order: Column | None, right_side: bool) -> DataFrame:
        values = []
        for i, f in enumerate(fields):
            c = f.right if right_side else f.left
            values.append((c.cast("bigint") if f.tolerance is None else number(c)).alias(f"v{i}"))
        version = order.cast("timestamp_ntz") if order is not None else F.lit(None).cast("timestamp_ntz")
        return df.select(F.col(key).alias("k"), F.struct(version.alias("o"), *values).alias("row"), F.lit(right_side).alias("r"))

    rows = side(left, left_order, False).unionByName(side(right, right_order, True))
    keys = rows.groupBy("k").agg(
        F.max(F.when(~F.col("r"), F.col("row"))).alias("l"),
        F.max(F.when(F.col("r"), F.col("row"))).alias("r"),
    )

    def cell(i: int, f: DiffField, s: str, sign: int) -> Column:
        v = F.col(f"{s}.v{i}")
        return F.struct(
            F.lit(i).cast("tinyint").alias("f"),
            (v if f.tolerance is not None else F.lit(None)).cast("double").alias("num"),
            (v if f.tolerance is None else F.lit(None)).cast("bigint").alias("exact"),
            F.when(v.isNotNull(), sign).otherwise(0).cast("tinyint").alias("sign"),
        )

    both = F.col("l").isNotNull() & F.col("r").isNotNull()
    presence = F.struct(
        F.lit(-1).cast("tinyint").alias("f"),
        F.lit(None).cast("double").alias("num"),
        F.lit(None).cast("bigint").alias("exact"),
        (F.col("l").isNotNull().cast("tinyint") - F.col("r").isNotNull().cast("tinyint")).cast("tinyint").alias("sign"),
    )
    cells = keys.select(
        "k",
        F.inline(
            F.when(both, F.array(*[cell(i, f, s, g) for i, f in enumerate(fields) for s, g in (("l", 1), ("r", -1))])).otherwise(F.array(presence))
        ),
    )
    net = cells.groupBy("k", "f").agg(
        F.sum("sign").alias("net"),
        F.min("num").alias("lo"),
        F.max("num").alias("hi"),
        F.min("exact").alias("elo"),
        F.max("exact").alias("ehi"),
    )
    tolerance = F.coalesce(*[F.when(F.col("f") == i, F.lit(f.tolerance)) for i, f in enumerate(fields) if f.tolerance is not None], F.lit(0.0))
    cancels = (
        (F.col("net") == 0)
        & F.coalesce((F.col("lo") == F.col("hi")) | (F.col("hi") - F.col("lo") <= tolerance + EPS), F.lit(True))
        & F.col("elo").eqNullSafe(F.col("ehi"))
    )
    name = F.when(F.col("f") == -1, F.when(F.col("net") > 0, only_left).otherwise(only_right))
    for i, f in enumerate(fields):
        name = name.when(F.col("f") == i, f.name)
    return net.filter(~cancels).select(F.col("k").alias(key), name.alias("difference"))


def declaration_diff(declarations: DataFrame, mirror: DataFrame) -> DataFrame:
    """The project's comparison of declarations with their mirrored copy, keyed by id."""
    same = lambda n, t: DiffField(n, F.col(n), F.col(n), t)
    return diff_copies(
        declarations,
        mirror,
        "id",
        [
            same("primaryValue", 0.005),
            same("netWgt", 0.005),
            DiffField("qty", F.col("qty"), parse_grouped_number(F.col("qty")), 0.00005),
            same("matched_id", None),
        ],
        right_order=F.col("synced_at"),
        only_left="only_declarations",
        only_right="only_mirror",
    )
