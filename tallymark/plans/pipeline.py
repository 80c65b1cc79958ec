"""Phases over years: retrieval, aggregate, match, residual; each writes a dataset and is skipped while it is fresh.

A step is fresh if it was made under the same settings from the same inputs: files by name, size, time
of change and digest; earlier steps by what they were made from; dimension tables and the concordance
by a digest of their rows."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable
from dataclasses import replace
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.config import PHASES, Config
from tallymark.functions.codes import hs_level
from tallymark.operators import canonical, cascade, pairing, residual
from tallymark.plans.declarations import Plan
from tallymark.schema import KEEP, typed
from tallymark.sources import dims, ingest, raw, store
from tallymark.sources.manifest import Manifest, fingerprint, read_json, table_digest, write_json


def ordered_phases(phases: Iterable[str]) -> list[str]:
    """Known phases in their order; an unknown one is an error."""
    want = list(phases)
    if bad := [p for p in want if p not in PHASES]:
        raise ValueError(f"unknown phases: {bad}")
    return [p for p in PHASES if p in want]


class Pipeline:
    """edges: weighted edges of revisions; best_codes: a built concordance's (from_revision, from_code, to_code).
    fetch(code, year, folder) brings a raw file, for the retrieval phase."""

    def __init__(
        self, spark: SparkSession, root: str, cfg: Config, dimensions: dict[str, DataFrame], edges: DataFrame | None = None, best_codes: DataFrame | None = None, fetch: Callable[[int, str, str], None] | None = None
    ):
        self.spark, self.root, self.cfg, self.edges, self.best_codes, self.fetch = spark, root, cfg, edges, best_codes, fetch
        self.dims = dimensions
        self.manifest = Manifest(os.path.join(root, "manifest.json"))

    def path(self, phase: str) -> str:
        return os.path.join(self.root, phase)

    def _stats(self, name: str, document, keys: tuple[str, ...] = ()) -> None:
        """Writes a document of statistics; lists that keys tell apart keep older entries that the new ones lack."""
        path = os.path.join(self.root, "stats", f"{name}.json")
        old = read_json(path) if keys else {}
        write_json(path, {k: store.merge_documents(old.get(k, []), v, keys) if keys and isinstance(v, list) else v for k, v in document.items()})

    def _step(self, key: str, inputs, write) -> bool:
        """Runs write unless its result is fresh; True if it ran."""
        if self.manifest.fresh(key, self.cfg.digest(), inputs):
            return False
        write()
        self.manifest.put(key, {"digest": self.cfg.digest(), "inputs": inputs})
        return True

    @cached_property
    def codes_digest(self) -> list[str]:
        return [table_digest(self.edges), table_digest(self.best_codes)]

    @cached_property
    def dims_digest(self) -> list[str]:
        return [table_digest(self.dims[k]) for k in ("factors", "conversion", "entrepots")]

    def retrieval(self, year: str) -> bool:
        if self.fetch is None:
            raise ValueError("the retrieval phase needs a fetch function")
        codes = self.cfg.reporters or sorted(r[0] for r in dims.reporters(self.dims["reporters"]).select("iso_code").distinct().collect())  # a dimension of some hundred codes
        status = ingest.retrieve(self.spark, self.fetch, codes, [year], os.path.join(self.root, "raw"), self.manifest)
        self._stats(f"retrieval_{year}", {"summary": store.stats_document(ingest.summary(status)), "reporters": store.stats_document(status)})
        return True

    def aggregate(self, year: str) -> bool:
        unreadable: list[str] = []
        files = raw.discover(os.path.join(self.root, "raw"), year, set(self.cfg.reporters) if self.cfg.reporters else None, unreadable)
        cfg = replace(self.cfg, years=(year,))

        def write() -> None:
            rows = typed(raw.scan(self.spark, files))
            kept = cascade.survivors(raw.with_row_ids(rows), cfg)
            scope = ["_src_file", "refYear"]
            store.write_year(cascade.drop_duplicates(kept, scope).drop("_src_file"), self.path("aggregate"), year, ("reporterCode",))
            self._stats(
                f"aggregate_{year}",
                {
                    "counts": store.stats_document(cascade.counts(rows, cfg, ["reporterCode"])),
                    "levels": store.stats_document(cascade.level_counts(rows, cfg, ("reporterCode",))),
                    "duplicates": store.stats_document(cascade.duplicate_counts(kept, scope, ["reporterCode"])),
                    "unreadable": {"files": [os.path.basename(p) for p in unreadable]},
                },
                ("reporterCode", "reason", "level"),
            )

        return bool(files) and self._step(f"aggregate/{year}", fingerprint([f.path for f in files]), write)

    def plan(self, year: str) -> Plan:
        decl = store.read(self.spark, self.path("aggregate")).filter(F.col("year") == year).drop("year")
        for c, v in (("typeCode", "C"), ("freqCode", "A"), ("classificationSearchCode", "HS")):  # settled by the first phase
            decl = decl.withColumn(c, F.lit(v))
        tables = {**self.dims, "edges": self.edges, "best_codes": self.best_codes}
        return Plan(decl, replace(self.cfg, years=(year,)), tables.get, repeats=True)

    def match(self, year: str) -> bool:
        def write() -> None:
            p = self.plan(year)
            kept = [c for c in KEEP if c in p.paired.columns]
            at = kept.index("cmdCode") + 1
            out = p.paired.select("id", "matched_id", *kept[:at], hs_level(F.col("cmdCode")).alias("hs_level"), *kept[at:], F.col("matched_id").isNotNull().cast("int").alias("is_matched"))
            store.write_year(out, self.path("match"), year, ("is_matched",))
            written = store.read(self.spark, self.path("match")).filter(F.col("year") == year)
            matched = written.filter("is_matched = 1").drop("is_matched")
            store.write_year(canonical.clean_or_passthrough(matched), self.path("clean"), year)
            self._stats(f"match_{year}", {"per_country": store.stats_document(pairing.by_country(written)), "clean": store.stats_document(canonical.coverage(canonical.sides(matched)))}, ())

        return self._step(f"match/{year}", [self.manifest.entries.get(f"aggregate/{year}"), *self.codes_digest], write)

    def residual_input(self, year: str) -> DataFrame:
        """The canonical rows of a year, else its matched rows, whichever was written."""
        found = store.first_existing(self.spark, [f"{self.path('clean')}/year={year}", f"{self.path('match')}/year={year}/is_matched=1"])
        if found is None:
            raise FileNotFoundError(f"nothing was matched for {year}")
        return store.read(self.spark, found)

    def residual(self, year: str) -> bool:
        def write() -> None:
            clean = self.residual_input(year)
            factors, conversion = dims.uplift_factors(self.dims["factors"]), dims.conversions(self.dims["conversion"])
            up = residual.with_uplift(clean, factors, self.cfg.default_uplift)
            store.write_year(residual.residuals(up, conversion), self.path("residual"), year)
            written = store.read(self.spark, f"{self.path('residual')}/year={year}")
            self._stats(
                f"residual_{year}",
                {
                    "counts": store.stats_document(residual.pair_counters(up, conversion, dims.entrepots(self.dims["entrepots"]))),
                    "discrepancies": store.stats_document(residual.discrepancies(clean)),
                    "uplift": store.stats_document(residual.uplift_quantiles(written)),
                    "x_rows_by_motcode": store.stats_document(residual.mode_counts(clean, factors)),
                },
            )

        return self._step(f"residual/{year}", [self.manifest.entries.get(f"match/{year}"), *self.dims_digest], write)

    def run(self, phases: Iterable[str] = PHASES[1:]) -> dict[str, bool]:
        """Phase/year -> whether it ran, year by year."""
        self.manifest.sweep()
        return {f"{p}/{y}": getattr(self, p)(y) for y in self.cfg.years for p in ordered_phases(phases)}
