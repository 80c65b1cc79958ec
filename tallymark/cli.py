"""Command line: `run` the phases over years, or build a `concordance` from revision tables."""

from __future__ import annotations

import argparse
import importlib
import logging
import sys

from pyspark.sql import SparkSession

from tallymark.config import PHASES, REVISIONS, Config

log = logging.getLogger("tallymark")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tallymark")
    sub = p.add_subparsers(dest="command", required=True)
    run = sub.add_parser("run", help="aggregate, match and residual over years")
    run.add_argument("--root", required=True, help="folder of raw/, the datasets and the manifest")
    run.add_argument("--dims", required=True, help="folder of the dimension tables in Parquet")
    run.add_argument("--years", nargs="+", required=True)
    run.add_argument("--phases", nargs="+", default=list(PHASES[1:]))
    run.add_argument("--reporters", nargs="*", type=int)
    run.add_argument("--level", default="HS6")
    run.add_argument("--prefixes", nargs="*", default=[])
    run.add_argument("--concordance", help="a concordance as the concordance command writes it, or in Parquet")
    run.add_argument("--target", default=Config.canonical_revision, choices=REVISIONS)
    run.add_argument("--fetch", help="module:function that brings a raw file, for the retrieval phase")
    conc = sub.add_parser("concordance", help="build the weighted concordance")
    conc.add_argument("--src", required=True)
    conc.add_argument("--target", default=Config.canonical_revision, choices=REVISIONS)
    conc.add_argument("--output", required=True)
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    """0: done, 1: a phase failed, 2: nothing to work on (the output is left as it was), 130: interrupted."""
    a = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("tallymark").getOrCreate()
    try:
        return _concordance(a, spark) if a.command == "concordance" else _run(a, spark)
    except KeyboardInterrupt:
        spark.sparkContext.cancelAllJobs()
        return 130
    except Exception:
        log.exception("%s failed", a.command)
        return 1


def _concordance(a: argparse.Namespace, spark: SparkSession) -> int:
    from tallymark.operators.concordance import build
    from tallymark.sources.raw import revision_tables
    from tallymark.sources.store import write_concordance

    try:
        built = build(revision_tables(spark, a.src), a.target)
    except (ValueError, FileNotFoundError) as e:
        log.error("%s", e)
        return 2
    write_concordance(built, a.output)
    return 0


def _run(a: argparse.Namespace, spark: SparkSession) -> int:
    from tallymark.operators.concordance import read_built
    from tallymark.plans.pipeline import Pipeline, ordered_phases
    from tallymark.sources import dims
    from tallymark.sources.tables import table

    phases = ordered_phases(a.phases)
    tables = {"factors": "cif_fob_factor", "conversion": "qty_unit_conversion", "entrepots": "entrepot_reporters", "reporters": "reporter_codes"}
    dimensions = {k: table(spark, a.dims, n) for k, n in tables.items()}
    targets = None
    if a.reporters:
        known, unknown = dims.resolve_targets(dimensions["reporters"], a.reporters)
        if unknown:
            log.warning("unknown reporters: %s", unknown)
        if not known:
            return 2
        targets = tuple(known)
    cfg = Config(years=tuple(a.years), hs_level=a.level, prefixes=tuple(a.prefixes), reporters=targets, canonical_revision=a.target)
    best = read_built(spark, a.concordance, a.target) if a.concordance else None
    fetch = None
    if a.fetch:
        module, _, name = a.fetch.partition(":")
        fetch = getattr(importlib.import_module(module), name)
    done = Pipeline(spark, a.root, cfg, dimensions, best_codes=best, fetch=fetch).run(phases)
    for step, ran in done.items():
        log.info("%s %s", step, "done" if ran else "fresh or without input")
    return 0


if __name__ == "__main__":
    logging.basicConfig(level=logging.INFO)
    sys.exit(main())
