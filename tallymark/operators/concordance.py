"""Codes across classification revisions: building the weighted concordance and applying it.

An edge table has from_rev, from_code, to_rev, to_code, weight. Code lists have thousands of rows,
whatever the size of the declarations, and are left to the planner's size-checked broadcast.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.config import REVISIONS
from tallymark.functions.codes import VINTAGES, hs_level, normalise_code
from tallymark.session import materialise

#: Edges up to which a concordance is composed in one task.
CODE_ROWS = 1_000_000
EDGE = ("from_rev", "from_code", "to_rev", "to_code")


# Words in the names of columns, by what the column holds.
COLUMN_WORDS = {"from": ("old hs code", "old code", "from", "source"), "to": ("new hs code", "new code", "to", "target"), "weight": ("share", "weight", "ratio", "fraction", "split")}
_EDITION = re.compile(r"hs[\s_-]*(\d{4}|\d{2})(?!\d)", re.I)


def pair_from_name(stem: str) -> tuple[str | None, str | None]:
    """Revisions of a table that is named by two editions, as HS2007_HS2012 or hs07-hs12: the first two that the
    name holds; an edition is known by the last two digits of its year."""
    by_digits = {year[-2:]: revision for year, revision in VINTAGES.items()}
    found = [by_digits.get(year[-2:]) if len(year) == 2 else VINTAGES.get(year) for year in _EDITION.findall(stem)]
    return (found[0], found[1]) if len(found) >= 2 else (None, None)


def _fit(column: str, revision: str | None, kind: str) -> int:
    """How well a column's name says that it holds codes of a revision (from, to) or weights; 0: not at all."""
    name = " ".join(re.sub(r"[\s_-]+", " ", column.lower()).split())
    year = next((y for y, r in VINTAGES.items() if r == revision), "")
    of_revision = revision is not None and (name == revision.lower() or any(f"hs{gap}{y}" in name for y in (year, year[2:]) for gap in ("", " ")))
    word = max((2 + (w == name) for w in COLUMN_WORDS[kind] if re.search(rf"\b{w}\b", name)), default=0)
    if kind == "weight":
        return word
    shared = any(re.search(rf"\b{w}\b", name) for w in COLUMN_WORDS["weight"])  # the share of an edition is no code
    return 0 if shared else 4 * of_revision + word


def edges_from_table(df: DataFrame, from_rev: str, to_rev: str) -> DataFrame | None:
    """Edges of one revision table with whatever column names; None if its columns are not found. The best
    pair of different columns is taken, on a tie the leftmost; without weights every edge weighs one."""
    best, pair = 0, None
    for a in df.columns:
        for b in df.columns:
            x, y = _fit(a, from_rev, "from"), _fit(b, to_rev, "to")
            if a != b and x and y and x + y > best:
                best, pair = x + y, (a, b)
    if pair is None:
        return None
    rest = [c for c in df.columns if c not in pair and _fit(c, None, "weight")]
    w = max(rest, key=lambda c: _fit(c, None, "weight"), default=None)
    weight = F.coalesce(F.trim(F.col(f"`{w}`")).try_cast("double"), F.lit(1.0)) if w else F.lit(1.0)
    text = lambda c: F.nullif(F.trim(F.col(f"`{c}`").cast("string")), F.lit(""))
    return df.select(F.lit(from_rev).alias("from_rev"), text(pair[0]).alias("from_code"), F.lit(to_rev).alias("to_rev"), text(pair[1]).alias("to_code"), weight.alias("weight")).filter("from_code is not null and to_code is not null")


def normalise_weights(edges: DataFrame) -> DataFrame:
    """Weights of each from-code add up to one; a sum of zero counts as one."""
    key = ["from_rev", "from_code", "to_rev"]
    whole = edges.groupBy(*key).agg(F.sum("weight").alias("whole"))
    return edges.join(whole, key).select(*EDGE, (F.col("weight") / F.when(F.col("whole") == 0, 1.0).otherwise(F.col("whole"))).alias("weight"))


def compose(edges: DataFrame, target: str) -> DataFrame:
    """(from_revision, from_code, to_revision, to_code, weight, note): weights multiplied along paths of
    adjacent revisions and summed over them; at most six hops, each a join on the code. Codes that do not
    reach the target, the target's own codes and those of newer revisions stand for themselves."""
    at = REVISIONS.index(target)
    one = edges.limit(CODE_ROWS + 1).count() <= CODE_ROWS  # code lists of that size: in one partition none of the steps has to shuffle
    together = lambda df: df.coalesce(1) if one else df
    edges = together(edges)
    codes = edges.select(F.col("from_rev").alias("rev"), F.col("from_code").alias("code")).unionByName(edges.select(F.col("to_rev").alias("rev"), F.col("to_code").alias("code"))).distinct()
    codes = together(materialise(codes))  # a few thousand codes, read for each hop
    older = codes.filter(F.col("rev").isin(*REVISIONS[:at])) if at else codes.filter(F.lit(False))
    done = None
    steps = {(r[0], r[1]) for r in edges.select("from_rev", "to_rev").distinct().filter(F.col("from_rev").isin(*REVISIONS) & F.col("to_rev").isin(*REVISIONS)).collect()}  # at most 49
    for hop in range(at):  # codes of every older revision move up together
        if (REVISIONS[hop], REVISIONS[hop + 1]) not in steps:
            done = None  # no table for this step: nothing passes it
            continue
        front = codes.filter(F.col("rev") == REVISIONS[hop]).select(F.col("rev").alias("from_revision"), F.col("code").alias("from_code"), F.col("code").alias("here"), F.lit(1.0).alias("weight"))
        front = front if done is None else done.unionByName(front)
        step = edges.filter((F.col("from_rev") == REVISIONS[hop]) & (F.col("to_rev") == REVISIONS[hop + 1])).select(F.col("from_code").alias("here"), F.col("to_code").alias("next"), F.col("weight").alias("w"))
        done = front.join(step, "here").groupBy("from_revision", "from_code", F.col("next").alias("here")).agg(F.sum(F.col("weight") * F.col("w")).alias("weight"))
    out = ("from_revision", "from_code", "to_revision", "to_code", "weight", "note")
    own = lambda df: df.select(F.col("rev").alias("from_revision"), F.col("code").alias("from_code"), F.lit(target).alias("to_revision"), F.col("code").alias("to_code"), F.lit(1.0).alias("weight"), F.lit("identity").alias("note"))
    same = own(codes.filter(F.col("rev").isin(*REVISIONS[at:])))
    if done is None:
        return same.select(*out)
    done = together(materialise(done))
    reached = done.select(F.col("from_revision").alias("rev"), F.col("from_code").alias("code")).distinct()
    composed = done.select("from_revision", "from_code", F.lit(target).alias("to_revision"), F.col("here").alias("to_code"), "weight", F.lit("").alias("note"))
    return composed.unionByName(own(older.join(reached, ["rev", "code"], "left_anti"))).unionByName(same).select(*out)


def build(tables: dict[str, DataFrame], target: str) -> DataFrame:
    """The concordance of named revision tables; several tables of a pair add up. No usable table: ValueError."""
    edges = None
    for stem, df in tables.items():
        a, b = pair_from_name(stem)
        e = edges_from_table(df, a, b) if a and b else None
        if e is not None:
            e = normalise_weights(e)
            edges = e if edges is None else edges.unionByName(e)
    if edges is None:
        raise ValueError("no usable revision table")
    return compose(edges, target)


def read_built(spark: SparkSession, path: str, target: str) -> DataFrame:
    """(from_revision, from_code, to_code) of a built concordance, as the `concordance` command writes it (text) or
    as Parquet: codes are normalised, mappings to other revisions are left out, the heaviest stays."""
    files = spark.read.format("binaryFile").load(path).select("path").limit(1).first()
    text = files is None or not files[0].endswith(".parquet")
    df = spark.read.csv(path, header=True) if text else spark.read.parquet(path)
    code = lambda c: normalise_code(F.col(c).cast("string"))
    rows = df.select(F.upper(F.trim("from_revision")).alias("from_revision"), code("from_code").alias("from_code"), F.upper(F.trim("to_revision")).alias("to_revision"), code("to_code").alias("to_code"), F.coalesce(F.col("weight").cast("string").try_cast("double"), F.lit(1.0)).alias("weight"))
    return best_targets(rows.filter("from_code is not null and to_code is not null"), target)


def best_targets(concordance: DataFrame, target: str) -> DataFrame:
    """(from_revision, from_code, to_code): the heaviest mapping to the target, by weights of nine decimals, so
    that the order in which paths were summed decides nothing; ties go to the lower code."""
    heaviest = F.struct((-F.round("weight", 9)).alias("w"), "to_code")
    return concordance.filter(F.col("to_revision") == target).groupBy("from_revision", "from_code").agg(F.min(heaviest).alias("b")).select("from_revision", "from_code", "b.to_code")


def canonicalise(df: DataFrame, best: DataFrame, target: str) -> DataFrame:
    """df with cmd_norm, canonical_cmd and concord: applied, unmapped or none. Short codes and codes of the
    target revision pass through."""
    rows = df.withColumn("cmd_norm", normalise_code(F.col("cmdCode")))
    scope = (F.length("cmd_norm") == 6) & ~F.col("classificationCode").eqNullSafe(F.lit(target))
    hit = best.select(F.col("from_revision").alias("classificationCode"), F.col("from_code").alias("cmd_norm"), F.col("to_code").alias("_to"))
    return rows.join(hit, ["classificationCode", "cmd_norm"], "left").select(
        *[F.col(c) for c in rows.columns],
        F.when(scope, F.coalesce("_to", "cmd_norm")).otherwise(F.col("cmd_norm")).alias("canonical_cmd"),
        F.when(~F.coalesce(scope, F.lit(False)), "none").when(F.col("_to").isNull(), "unmapped").otherwise("applied").alias("concord"),
    )


def diagnostics(canonical: DataFrame) -> DataFrame:
    """(level, in_scope, rewritten, unmapped, dropped_unnormalisable)."""
    return canonical.groupBy(hs_level(F.col("cmdCode")).alias("level")).agg(
        F.count_if(F.col("concord") != "none").alias("in_scope"),
        F.count_if((F.col("concord") == "applied") & (F.col("canonical_cmd") != F.col("cmd_norm"))).alias("rewritten"),
        F.count_if(F.col("concord") == "unmapped").alias("unmapped"),
        F.count_if(F.col("cmd_norm").isNull()).alias("dropped_unnormalisable"),
    )
