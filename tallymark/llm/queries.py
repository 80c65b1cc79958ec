"""Queries p7 to p9 over the corpus of source files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallymark.llm.mixing import mix
from tallymark.llm.residue import find_residue
from tallymark.llm.tokenise import token_ids
from tallymark.sources.tables import table


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    return token_ids(table(spark, d, "documents"), ["doc_id"])


def p8_mix(spark: SparkSession, d: str) -> DataFrame:
    return mix(table(spark, d, "documents"), table(spark, d, "source_targets"))[0]


def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    return mix(table(spark, d, "documents"), table(spark, d, "source_targets"))[1]


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return find_residue(table(spark, d, "documents"))


def p9_kept(spark: SparkSession, d: str) -> DataFrame:
    """The documents without residue."""
    t = table(spark, d, "documents")
    return t.join(find_residue(t).distinct(), "doc_id", "left_anti").select("doc_id", "lang", "source", "n_chars")


QUERIES = {f.__name__: f for f in (p7_ids, p8_mix, p8_shares, p9_found, p9_kept)}
#: None of these can be put in SQL: they are tested against a reference encoder, exact sums and planted cases.
SQL: dict[str, str] = {}
